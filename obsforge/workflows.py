"""User-level compositions: prepare, train, evaluate, score, the full run, the initial load and the daily step.

A home folder holds all tables: prepared, split, state/version=N, versions, log, metrics, scores, pool, feed, deployments.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsforge.functions.columns import numeric_columns, row_fingerprint
from obsforge.operators import clean, encode, feed, metrics, model, outliers, pool, runlog, split, validate
from obsforge.operators.pool import Pool
from obsforge.operators.profile import split_by_kind
from obsforge.plans.ranks import few_valued
from obsforge.schema import (
    AUTOMATIC, COMPLETED, DROPPED, FAILED, FOREST, KEYS, LABEL, LABELS, MANUAL, NOT_FENCED, PREPARATION_ERROR, PREPARATION_STATUS,
    PROMOTION, PROMOTION_ERROR, SEED, STARTED, TEST_SIZE, TRAINING_SHARE,
)
from obsforge.session import compiled_methods, cut_lineage, new_path, removed, spread
from obsforge.sources import tables

MODEL_NAME = "daily_label"
UNLABELLED = "__unlabelled"
UNJUDGED = "model string, version string, run_id string, evaluated double, metric double, promoted boolean, promotion string"
# Days of the pool that a daily step reads at least.
POOL_DAYS = 30


@dataclass
class Prepared:
    df: DataFrame
    intermediate: str
    modes: DataFrame
    codes: DataFrame
    fences: DataFrame
    facts: dict[str, Any]
    # Columns of few distinct values.
    few: Sequence[str] = ()


def prepare(raw: DataFrame, fence_mode: str = "clip", dropped: Sequence[str] = DROPPED, approx: bool = False) -> Prepared:
    """Map labels, fill modes, encode text, drop unlabelled rows, fence outliers, drop columns - in that order.

    Modes and codes see all rows, fences only the labelled ones. Columns that are dropped at the end are never encoded or
    fenced, which leaves the result as it is and spares their scans. One scan yields modes, codes and counters; the
    encoded table is written once, and the fences read it column by column. The result reads that table: once it is written
    elsewhere, `removed(spark, prepared.intermediate)` frees the space.
    """
    spark, mapped = raw.sparkSession, clean.binary_map(raw, LABELS)
    text, _ = split_by_kind(mapped)
    used = [c for c in text if c not in dropped]
    unlabelled = F.lit(False)
    if set(LABELS) <= set(mapped.columns):
        unlabelled = F.col(LABELS[0]).isNull() | F.col(LABELS[1]).isNull()
    marked = mapped.withColumn(UNLABELLED, F.when(unlabelled, "1").otherwise("0"))
    counts = cut_lineage(clean.value_counts(marked, [*used, UNLABELLED]))
    rows = {r["value"]: r["n"] for r in counts.where(F.col("column") == UNLABELLED).collect()}
    if not rows:
        raise ValueError("no rows to prepare")
    values = counts.where(F.col("column") != UNLABELLED)
    modes = spark.createDataFrame(clean.modes_of(values).collect(), "column string, mode string")
    codes = cut_lineage(encode.codes_of(values, counts.count()))
    filled = values.where(F.col("value").isNull()).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    coded = encode.apply_codes(clean.fill_mode(spread(mapped), modes), codes, used) if used else spread(mapped)
    path = new_path(spark, "encoded")
    clean.drop_columns(clean.drop_unlabelled(coded, LABELS), dropped).write.parquet(path)
    slim = spark.read.parquet(path)
    few = [] if approx else few_valued(slim, numeric_columns(slim, [LABEL]))
    fences = outliers.fit_fences(slim, [c for c in slim.columns if c not in NOT_FENCED], approx=approx, known_few=few)
    done = outliers.apply_fences(slim, fences, fence_mode)
    total, gone = sum(rows.values()), rows.get("1", 0)
    facts = {
        "data_preparation.initial_shape": f"({total}, {len(raw.columns)})",
        "data_preparation.final_shape": f"({total - gone}, {len(done.columns)})",
        "data_preparation.missing_values_removed": filled,
        "data_preparation.rows_dropped": gone,
    }
    return Prepared(done, path, modes, codes, fences, facts, few)


class Home:
    """Paths and tables of one installation below a shared folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        compiled_methods(spark)

    def at(self, name: str) -> str:
        return f"{self.path}/{name}"

    def log(self, run_id: str, items: Sequence[tuple[str, str, Any]], step: str) -> None:
        """Facts of one step; a repeated step replaces its own facts."""
        facts = runlog.facts(self.spark, run_id, items)
        facts.coalesce(1).write.mode("overwrite").parquet(f"{self.at('log')}/about=run/part={run_id}-{step}")

    def log_predictions(self, facts: DataFrame, name: str) -> None:
        """Facts of scored rows, apart from those of the runs: there are many more of them."""
        facts.write.mode("overwrite").parquet(f"{self.at('log')}/about=prediction/part={name}")

    def run_log(self, about: str | None = None) -> DataFrame:
        log = self.spark.read.parquet(self.at("log"))
        return (log if about is None else log.where(F.col("about") == about)).drop("part", "about")

    def versions(self) -> DataFrame | None:
        return feed.read_or_none(self.spark, self.at("versions"))

    def add_version(self, version: int, run_id: str) -> None:
        row = self.spark.createDataFrame([(MODEL_NAME, str(version), run_id)], "model string, version string, run_id string")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.at('versions')}/v={version}")

    def state_path(self, version: int) -> str:
        return f"{self.at('state')}/version={version}"

    def promoted(self) -> DataFrame:
        """Versions with their metric (evaluated, else tested, else 0), whether each was promoted, and the text recorded about it.

        Reads only the accuracy facts of the versions' own runs.
        """
        known = self.versions().drop("v")
        wanted = self.run_log("run").where("kind = 'metric' AND key IN ('eval_accuracy', 'test_accuracy')")
        numbers = runlog.current(wanted.join(known.select("run_id").distinct(), "run_id", "left_semi"))
        metric = numbers.groupBy("run_id").agg(
            F.max(F.when(F.col("key") == "eval_accuracy", F.col("num"))).alias("evaluated"),
            F.max(F.when(F.col("key") == "test_accuracy", F.col("num"))).alias("tested"),
        )
        judged = runlog.promote(known.join(metric, "run_id", "left").withColumn("metric", runlog.metric_or_fallback("evaluated", "tested")), keep_best=True)
        return runlog.with_promotion_text(judged)

    def champion(self) -> int:
        row = runlog.champions(self.promoted()).where(F.col("model") == MODEL_NAME).first()
        if row is None:
            raise ValueError("no champion yet: train and evaluate first")
        return row["champion"]


def _prepared(home: Home, raw: DataFrame, run_id: str, fence_mode: str) -> Prepared:
    """Prepare; a failure is logged with its message, and raised."""
    try:
        return prepare(raw, fence_mode)
    except Exception as error:
        home.log(run_id, [("tag", PREPARATION_STATUS, FAILED), ("tag", PREPARATION_ERROR, str(error))], "fail-preparation")
        raise


def extract(home: Home, raw: DataFrame, run_id: str, fence_mode: str = "clip") -> Prepared:
    """Prepare alone: write the prepared table and log its counters, or its failure."""
    prepared = _prepared(home, raw, run_id, fence_mode)
    tables.write_snapshot(prepared.df, home.at("prepared"))
    home.log(run_id, [("tag", k, v) for k, v in prepared.facts.items()], "extract")
    removed(home.spark, prepared.intermediate)
    return replace(prepared, df=home.spark.read.parquet(home.at("prepared")))


def train(home: Home, raw: DataFrame, run_id: str, version: int, fence_mode: str = "clip", test_size: float = TEST_SIZE,
          seed: int = SEED, params: Mapping[str, Any] = FOREST, key: Sequence[str] | None = None) -> DataFrame:
    """Prepare, split, fit and measure one model version; returns its metrics document."""
    spark = home.spark
    prepared = _prepared(home, raw, run_id, fence_mode)
    features = [c for c in prepared.df.columns if c != LABEL]
    xy = clean.features_and_label(prepared.df, LABEL, features)
    tables.write_split(split.stratified(xy, LABEL, key, test_size, seed), home.at("split"))
    removed(spark, prepared.intermediate)
    training = tables.read_split(spark, home.at("split"), "train")
    test = tables.read_split(spark, home.at("split"), "test")
    positive = F.coalesce(F.avg((F.col(LABEL) == 1).cast("double")), F.lit(0.0)).alias("__ratio")
    nulls = training.agg(positive, *[F.count_if(F.col(c).isNull()).alias(c) for c in features]).first()
    ratio, flagged = nulls["__ratio"], [c for c in features if nulls[c]]
    # Fencing adds two values to a column at most, and the training rows are a part of the rows.
    medians = clean.fit_median(training, features, prepared.few)
    scaler = cut_lineage(encode.fit_scaler(training, features))
    state = model.ScoringState(
        features, flagged, prepared.modes, prepared.codes, prepared.fences, medians, scaler, fence_mode
    )
    # The vectors are written once; fitting reads the training rows of them, scoring all.
    vectors = new_path(spark, "vectors")
    both = spark.read.parquet(home.at("split"))
    tables.write_split(model.finish_features(both, state).select("split", LABEL, "features"), vectors)
    ready = spark.read.parquet(vectors)
    state.model = model.fit_forest(ready.where("split = 'train'"), params=params)
    scored = model.predict(ready, state.model)
    tables.write_snapshot(scored.select("split", LABEL, "prediction", "probability"), home.at("scores"))
    removed(spark, vectors)
    measured = cut_lineage(
        metrics.summary_text(metrics.report(spark.read.parquet(home.at("scores")), LABEL, "prediction", "probability", ["split"]))
    )
    by_split = {r["split"]: r for r in measured.collect()}
    top = model.importances(spark, state.model, state.vector)
    state.save(home.state_path(version))
    home.add_version(version, run_id)
    names = ("accuracy", "precision", "recall", "f1", "roc_auc")
    size = {s: r["tp"] + r["fp"] + r["fn"] + r["tn"] for s, r in by_split.items()}
    items = [("tag", k, v) for k, v in prepared.facts.items()]
    items += [("param", "features_count", len(features)), ("param", "test_size", test_size), ("param", "random_state", seed)]
    items += [("param", k, v) for k, v in params.items()]
    items += [("metric", f"{s}_samples", size.get(s, 0)) for s in ("train", "test")]
    items += [("metric", "train_positive_class_ratio", ratio)]
    items += [("metric", f"train_{m}", by_split["train"][m]) for m in names if by_split["train"][m] is not None]
    leading = top.collect()
    items += [("metric", f"importance_{r['feature']}", r["importance"]) for r in leading]
    tested = by_split.get("test")
    items += [
        ("tag", "model_type", "RandomForest"),
        ("tag", "top_feature", leading[0]["feature"] if leading else "None"),
        ("tag", "top_feature_importance", f"{leading[0]['importance']:.4f}" if leading else "0"),
        ("tag", "training_samples", size.get("train", 0)),
        ("tag", "test_samples", size.get("test", 0)),
        ("tag", "pipeline_status", COMPLETED),
    ]
    if tested is not None:
        items += [
            ("tag", "f1_score", f"{tested['f1']:.4f}"),
            ("tag", "accuracy", f"{tested['accuracy']:.4f}"),
            ("tag", "performance_summary", tested["performance_summary"]),
        ]
    home.log(run_id, items, "train")
    document = tables.metrics_document(measured.where("split = 'train'"), measured.where("split = 'test'"), top)
    tables.write_metrics(document, home.at("metrics"), run_id, "train")
    return tables.read_metrics(spark, home.at("metrics")).where((F.col("run_id") == run_id) & (F.col("step") == "train"))


def evaluate(home: Home, run_id: str, version: int) -> DataFrame:
    """Accuracy of a stored version on the stored test rows, logged; returns the versions with their promotion.

    If the promotion fails, its error is logged beside the completed evaluation, and the version alone is returned, unjudged.
    """
    spark = home.spark
    state = model.ScoringState.load(spark, home.state_path(version))
    test = tables.read_split(spark, home.at("split"), "test")
    scored = model.predict(model.finish_features(test, state).select(LABEL, "features"), state.model)
    measured = cut_lineage(metrics.threshold_metrics(metrics.confusion(scored, LABEL)).select(F.col("accuracy").alias("accuracy_score")))
    accuracy = measured.first()[0]
    home.log(run_id, [("metric", "eval_accuracy", accuracy), ("tag", "evaluation_status", COMPLETED)], "evaluate")
    tables.write_metrics(measured, home.at("metrics"), run_id, "evaluate")
    try:
        judged = cut_lineage(home.promoted())
        own = judged.where(F.col("version") == str(version)).first()
        items = [("tag", PROMOTION, own["promotion"]), ("metric", "promotion_accuracy", accuracy)]
        items += [("metric", "champion_accuracy", own["best"])] if own["best"] is not None else []
    except Exception as error:
        home.log(run_id, [("tag", PROMOTION_ERROR, str(error))], "promote")
        row = (MODEL_NAME, str(version), run_id, accuracy, accuracy)
        return spark.createDataFrame([(*row, None, None)], UNJUDGED)
    home.log(run_id, items, "promote")
    return judged.drop("best")


def score(home: Home, rows: DataFrame, keep: Sequence[str] = KEYS, rules: Sequence[validate.Rule] | None = None) -> tuple[DataFrame, DataFrame]:
    """(scored rows, rejected rows) with the champion; rows that break a rule are rejected, not lost."""
    version = home.champion()
    state = model.ScoringState.load(home.spark, home.state_path(version))
    rules = validate.observation_rules() if rules is None else rules
    valid, rejects = validate.check(tables.with_defaults(spread(rows)), rules)
    return model.score(valid, state, keep, version=version), rejects


def score_requests(home: Home, rows: DataFrame, ids: Sequence[str], batch: str) -> tuple[DataFrame, DataFrame]:
    """Manual requests as one step: check, reject or score, and log each scored one as a child run under the deployment.

    `ids` identify a request. Places and directions are given as codes, RainToday as 0 or 1; fields beyond the request's own are
    an error. Returns (scored rows, rejected rows with their errors). Scoring or logging a batch again changes nothing.
    """
    spark = home.spark
    rules = validate.request_rules()
    fields = list(dict.fromkeys(r.column for r in rules))
    validate.require_no_extra(rows.drop(*ids), fields)
    valid, rejects = validate.check(spread(rows), rules)
    parent, version = deployment(home)
    state = model.ScoringState.load(spark, home.state_path(version))
    numbers = valid.select(*ids, *[F.col(c).cast("double").alias(c) for c in fields])
    scored = cut_lineage(model.score_prepared(tables.with_defaults(numbers), state, [*ids, *fields], version=version))
    home.log_predictions(runlog.prediction_facts(scored, parent, ids, fields, MANUAL, runlog.now()), f"requests-{batch}")
    return scored.select(*ids, "prediction", "probability", "prediction_label", "model_version"), rejects


def run_all(home: Home, raw: DataFrame, run_id: str, version: int, **options: Any) -> DataFrame:
    """Start, train (which prepares), evaluate, complete; a failure is logged for its step and the run, and raised."""
    home.log(run_id, [("tag", "workflow_status", STARTED), ("tag", "workflow_type", "full")], "start")
    steps = (
        ("train", "pipeline_status", "error_message", lambda: train(home, raw, run_id, version, **options)),
        ("evaluate", "evaluation_status", "evaluation_error", lambda: evaluate(home, run_id, version)),
    )
    for step, status, message, action in steps:
        home.log(run_id, [("tag", f"step_{step}_start_time", runlog.now().isoformat()), ("tag", "current_step", step)], f"begin-{step}")
        try:
            result = action()
        except Exception as error:
            home.log(run_id, [("tag", status, FAILED), ("tag", message, str(error))], f"fail-{step}")
            home.log(run_id, [("tag", "workflow_status", FAILED), ("tag", "workflow_error", str(error))], "end")
            raise
    home.log(run_id, [("tag", "workflow_status", COMPLETED)], "end")
    return result


def initial_load(home: Home, raw: DataFrame, date: str = "Date", ties: Sequence[str] = ("Location",), fraction: float = TRAINING_SHARE) -> DataFrame:
    """Split the history by date into the training table and the pool; returns the row counts."""
    halves = split.chronological(raw, date, ties, fraction)
    tables.write_split(halves, home.at("history"))
    return split.split_counts(home.spark.read.parquet(home.at("history")))


def history(home: Home, part: str) -> DataFrame:
    return tables.read_split(home.spark, home.at("history"), part)


def prediction_pool(home: Home, keys: Sequence[str] = KEYS) -> Pool:
    """The pool that `daily` takes from; its first rows are the prediction part of the history."""
    pool = Pool(home.spark, home.at("pool"), keys, POOL_DAYS)
    if pool.records() is None:
        pool.append(history(home, "prediction"), 0)
    return pool


def add_observations(home: Home, rows: DataFrame, append_id: int, keys: Sequence[str] = KEYS) -> None:
    """Rows that arrive after the initial load, at any place of the order; `append_id` is 1 or more, and repeating it changes nothing."""
    if append_id < 1:
        raise ValueError("append 0 is the initial load")
    prediction_pool(home, keys).append(rows, append_id)


def training_rows(home: Home) -> DataFrame:
    """Initial training rows plus everything the feed has consumed."""
    return feed.training_view(history(home, "training"), feed.committed(home.spark, home.at("feed")))


def deployment(home: Home) -> tuple[str, int]:
    """Run id and version under which predictions are logged; created on first use."""
    spark = home.spark
    wanted = runlog.deployed_version(home.versions().drop("v"), home.promoted())
    existing = feed.read_or_none(spark, home.at("deployments"))
    fresh = cut_lineage(runlog.missing_deployments(wanted, existing).where(F.col("model") == MODEL_NAME))
    row = fresh.first()
    if row is not None:
        fresh.coalesce(1).write.mode("overwrite").parquet(f"{home.at('deployments')}/v={row['version']}")
        home.log(row["run_id"], [("tag", "model_deployment", "True"), ("tag", "model_version", row["version"]),
                                 ("tag", "pipeline_type", "deployment")], "deploy")
        return row["run_id"], row["version"]
    kept = existing.drop("v").join(wanted, ["model", "version"], "left_semi").where(F.col("model") == MODEL_NAME).first()
    return kept["run_id"], kept["version"]


def daily(home: Home, batch_id: int, n: int = 1, keys: Sequence[str] = KEYS, rules: Sequence[validate.Rule] = ()) -> DataFrame:
    """Fingerprint, take the next `n` rows, refuse stale ones, score them and log each prediction under the deployment.

    Observed rows are scored as they are; with `rules`, rows that break one are logged as failed and kept as rejects.
    """
    spark = home.spark
    waiting = prediction_pool(home, keys)
    names = waiting.schema().names
    consumed = feed.committed(spark, home.at("feed"))
    last = None if consumed is None else consumed.where(F.col("batch_id") < batch_id).agg(F.max("batch_id")).first()[0]
    previous = None if last is None else consumed.where(F.col("batch_id") == last).select(*names)
    before = feed.batch_fingerprint(previous)
    rows = pool.consume(waiting, home.at("feed"), batch_id, n)
    after = feed.batch_fingerprint(rows)
    if not feed.check_fresh(before, after):
        raise ValueError("the published rows did not change since the last batch")
    unlabelled, _ = feed.published(rows, LABEL, keys)
    parent, version = deployment(home)
    state = model.ScoringState.load(spark, home.state_path(version))
    valid, rejects = validate.check(tables.with_defaults(unlabelled), rules)
    inputs = [c for c in unlabelled.columns if c not in keys]
    scored = cut_lineage(model.score(valid, state, [*keys, *inputs], version=version))
    logged = scored
    if rules:
        rejects.write.mode("overwrite").parquet(f"{home.at('rejects')}/batch_id={batch_id}")
        failed = rejects.select(*keys, *inputs, F.lit(version).cast("long").alias("model_version"), F.array_join(validate.ERRORS, ", ").alias("error"))
        logged = scored.unionByName(failed, allowMissingColumns=True)
    # Rows of equal keys are told apart by their content.
    logged = logged.withColumn("__content", row_fingerprint(inputs))
    facts = runlog.prediction_facts(logged, parent, [*keys, "__content"], [*keys, *inputs], AUTOMATIC, runlog.now(), after)
    home.log_predictions(facts, f"daily-{batch_id}")
    return scored.select(*keys, "prediction", "probability", "prediction_label", "model_version")
