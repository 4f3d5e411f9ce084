"""Run log as a long table, and champion selection over model versions.

Facts: run_id, parent_run_id, kind (tag / param / metric), key, value (text), num, ts.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsforge.functions.columns import seconds_between
from obsforge.plans.ordered import neighbours, running_before
from obsforge.schema import COMPLETED, ENDPOINTS, FAILED, FIRST_CHAMPION, NOT_PROMOTED, PROMOTED

FACTS = "run_id string, parent_run_id string, kind string, key string, value string, num double, ts timestamp"


def now() -> datetime:
    return datetime.now(timezone.utc)


def facts(
    spark: SparkSession, run_id: str, items: Iterable[tuple[str, str, Any]], ts: datetime | None = None, parent: str | None = None
) -> DataFrame:
    """Facts of one run from (kind, key, value) items; metrics are numbers, the rest is text."""
    at, rows = ts or now(), []
    for kind, key, value in items:
        text = None if kind == "metric" or value is None else str(value)
        rows.append((run_id, parent, kind, key, text, float(value) if kind == "metric" else None, at))
    return spark.createDataFrame(rows, FACTS)


def current(log: DataFrame, order: Sequence[str] = ("ts",)) -> DataFrame:
    """Last write per (run, kind, key). A run may hold most of the log: rows are combined before the shuffle."""
    position = F.struct(*[F.col(c) for c in order])
    last = F.max_by(F.struct("value", "num", *order), position)
    return (
        log.groupBy("run_id", "kind", "key")
        .agg(last.alias("__last"))
        .select("run_id", "kind", "key", "__last.value", "__last.num", F.col("__last")[order[0]].alias(order[0]))
    )


def search(log: DataFrame, tags: Mapping[str, str], limit: int | None = None) -> DataFrame:
    """Runs whose current tags equal all the given ones; one pass over the tags, no join."""
    latest = current(log.where((F.col("kind") == "tag") & F.col("key").isin(*tags)))
    matches = [F.max(((F.col("key") == k) & (F.col("value") == v)).cast("int")).alias(f"t{i}") for i, (k, v) in enumerate(tags.items())]
    runs = latest.groupBy("run_id").agg(*matches)
    for i in range(len(tags)):
        runs = runs.where(F.col(f"t{i}") == 1)
    runs = runs.select("run_id")
    return runs if limit is None else runs.orderBy("run_id").limit(limit)


def status(log: DataFrame, key: str = "workflow_status", order: Sequence[str] = ("ts",)) -> DataFrame:
    """Per run: last status, first and last time seen."""
    position = F.struct(*[F.col(c) for c in order])
    is_status = F.col("key") == key
    return log.groupBy("run_id").agg(
        F.max_by(F.when(is_status, F.col("value")), F.when(is_status, position)).alias("status"),
        F.min("ts").alias("started"),
        F.max("ts").alias("ended"),
    )


def step_durations(
    steps: DataFrame,
    run: str = "run_id",
    ts: str = "ts",
    ties: Sequence[str] = (),
    rows: int | None = None,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Add `seconds`: time from the step's start to the start of the next step of the run; null for the last."""
    rows = steps.count() if rows is None else rows
    near = neighbours(steps, [ts, *ties], {"__next": F.col(ts)}, [run], following=True, rows=rows, rows_per_bucket=rows_per_bucket)
    return near.withColumn("seconds", seconds_between(F.col("__next"), F.col(ts))).drop("__next")


def version_number(column: str) -> Column:
    return F.col(column).cast("string").cast("bigint")


def latest_version(versions: DataFrame, model: str = "model", version: str = "version") -> DataFrame:
    """Largest version per model, compared as numbers."""
    return versions.groupBy(model).agg(F.max(version_number(version)).alias("version"))


def metric_or_fallback(evaluated: str, tested: str) -> Column:
    return F.coalesce(F.col(evaluated), F.col(tested), F.lit(0.0))


def promote(
    versions: DataFrame,
    model: str = "model",
    version: str = "version",
    metric: str = "metric",
    rows: int | None = None,
    rows_per_bucket: int | None = None,
    keep_best: bool = False,
) -> DataFrame:
    """Add `promoted`: the first version always, a later one iff its metric is at least the champion's at that time.

    The champion's metric is the running maximum, so no sequential pass is needed. A missing metric counts as 0.
    With `keep_best`, `best` holds the champion's metric before the version, null for the first.
    """
    rows = versions.count() if rows is None else rows
    scored = versions.withColumns({"__v": version_number(version), "__m": F.coalesce(F.col(metric).cast("double"), F.lit(0.0))})
    placed = running_before(scored, ["__v"], maxima={"__best": F.col("__m")}, group=[model], rows=rows, rows_per_bucket=rows_per_bucket)
    judged = placed.withColumn("promoted", F.col("__best").isNull() | (F.col("__m") >= F.col("__best"))).drop("__v", "__m")
    return judged.withColumnRenamed("__best", "best") if keep_best else judged.drop("__best")


def champions(promoted: DataFrame, model: str = "model", version: str = "version") -> DataFrame:
    """Current champion per model: the last promoted version."""
    return promoted.where("promoted").groupBy(model).agg(F.max(version_number(version)).alias("champion"))


def deployed_version(versions: DataFrame, promoted: DataFrame | None = None) -> DataFrame:
    """Champion per model, or the latest version where there is no champion."""
    latest = latest_version(versions)
    if promoted is None:
        return latest
    best = champions(promoted)
    return latest.join(best, "model", "left").select("model", F.coalesce("champion", "version").alias("version"))


def missing_deployments(wanted: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Deployments to insert: (model, version, run_id) not yet in `existing`; the id follows from the pair, so a repeat inserts nothing."""
    fresh = wanted if existing is None else wanted.join(existing.select("model", "version"), ["model", "version"], "left_anti")
    identity = F.md5(F.concat_ws("|", F.col("model").cast("string"), F.col("version").cast("string")))
    return fresh.select("model", "version", identity.alias("run_id"))


def prediction_facts(
    scored: DataFrame, parent_run_id: str | Column, ids: Sequence[str], inputs: Sequence[str], kind_of_run: str, ts: datetime, data_hash: str | None = None
) -> DataFrame:
    """One child run per scored row, in one pass: its inputs as params, class and probability as metrics, the rest as tags.

    The child id is derived from the parent and the row's keys, so logging a batch twice gives the same runs. A row that carries
    an `error` text is logged as failed, with that text, and without class and probability.
    """
    parent = F.lit(parent_run_id).cast("string")
    run = F.md5(F.concat_ws("|", parent, *[F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in ids]))
    none_text, none_num = F.lit(None).cast("string"), F.lit(None).cast("double")
    failed = F.col("error").isNotNull() if "error" in scored.columns else F.lit(False)
    tag = lambda key, value: _fact("tag", key, value, none_num)
    items = [_fact("param", c, F.coalesce(F.col(c).cast("string"), F.lit("NA")), none_num) for c in inputs]
    items += [
        tag("pipeline_type", F.lit(kind_of_run)),
        tag("prediction_date", F.lit(ts.strftime("%Y%m%d_%H%M%S"))),
        tag("model_version", F.col("model_version").cast("string")),
        tag("prediction_status", F.when(failed, FAILED).otherwise(COMPLETED)),
    ]
    items += [tag("endpoint", F.lit(ENDPOINTS[kind_of_run]))] if kind_of_run in ENDPOINTS else []
    items += [tag("data_hash", F.lit(data_hash))] if data_hash is not None else []
    items += [F.when(failed, tag("error_message", F.col("error")))] if "error" in scored.columns else []
    items += [
        F.when(~failed, fact)
        for fact in (
            _fact("metric", "prediction_result", none_text, F.col("prediction").cast("double")),
            _fact("metric", "prediction_probability", none_text, F.col("probability")),
            tag("prediction_label", F.col("prediction_label")),
        )
    ]
    # The id is taken once per row, before it has many facts; facts that do not apply are null and go afterwards.
    named = scored.withColumn("__run", run)
    logged = named.select(F.col("__run").alias("run_id"), parent.alias("parent_run_id"), F.inline(F.array(*items)), F.lit(ts).cast("timestamp").alias("ts"))
    return logged.where(F.col("key").isNotNull())


def with_promotion_text(promoted: DataFrame, metric: str = "metric", best: str = "best") -> DataFrame:
    """What is recorded about each version's promotion; `best` is the champion's metric before it, null without a champion."""
    new, old = F.coalesce(F.col(metric), F.lit(0.0)), F.col(best)
    text = F.format_string(PROMOTED.replace("{new:.4f}", "%.4f").replace("{old:.4f}", "%.4f"), new, old)
    return promoted.withColumn("promotion", F.when(old.isNull(), FIRST_CHAMPION).when(new >= old, text).otherwise(NOT_PROMOTED))


def _fact(kind: str, key: str, value: Column, num: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), F.lit(key).alias("key"), value.alias("value"), num.alias("num"))


def roll_up(log: DataFrame) -> DataFrame:
    """Per parent run: child runs, positive predictions and mean probability."""
    metric = F.col("kind") == "metric"
    children = log.where(F.col("parent_run_id").isNotNull())
    return children.groupBy("parent_run_id").agg(
        F.count_if(metric & (F.col("key") == "prediction_result")).alias("n_predictions"),
        F.sum(F.when(metric & (F.col("key") == "prediction_result"), F.col("num"))).cast("long").alias("n_positive"),
        F.avg(F.when(metric & (F.col("key") == "prediction_probability"), F.col("num"))).alias("mean_probability"),
    )
