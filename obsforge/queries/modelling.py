"""Forest fit and score, state, metrics document, and the composed workflows over observation rows."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Window
from pyspark.sql import functions as F

from obsforge import workflows
from obsforge.operators import metrics, model, runlog
from obsforge.queries.base import OBSERVATIONS, observations, query, rounded, table
from obsforge.schema import LABEL
from obsforge.session import cut_lineage, new_path, written
from obsforge.sources import tables

def vectors(spark, sf_dir):
    """Embeddings with a one-against-rest label."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        (F.col("label") < 5).cast("double").alias("target"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
    )


def forest(spark, sf_dir):
    return model.fit_forest(vectors(spark, sf_dir), "target")


def names(fitted):
    return [f"e{i}" for i in range(fitted.numFeatures)]


def trained_home(spark, sf_dir) -> workflows.Home:
    """Initial load, training, evaluation and promotion on all observation rows, in a home of its own."""
    home = workflows.Home(spark, new_path(spark, "home"))
    workflows.initial_load(home, observations(spark, sf_dir))
    workflows.run_all(home, workflows.training_rows(home), "run-1", 1)
    return home


# The tests of the forest need no value of the model: they state what must hold for any forest on these rows.
EMBEDDED = "SELECT vec_id, CAST(label < 5 AS DOUBLE) AS target, len(embedding) AS width FROM embeddings"


def consistent():
    """Whether class, probability and their relation are as they must be."""
    p = F.col("probability")
    return F.coalesce((p >= 0) & (p <= 1) & (F.col("prediction") == (p > 0.5).cast("int")), F.lit(False))


@query(
    "M1_forest_fit",
    f"""SELECT CAST(max(width) AS BIGINT) AS n_features, CAST(0 AS BIGINT) AS n_negative, CAST(1 AS DOUBLE) AS total,
    CAST(max(width) AS BIGINT) AS n_names, TRUE AS informed FROM ({EMBEDDED})""",
)
def m1(spark, sf_dir):
    """One importance per component, none negative, summing to 1."""
    fitted = forest(spark, sf_dir)
    shares = model.importances(spark, fitted, names(fitted), None)
    return shares.agg(
        F.count("*").alias("n_features"),
        F.count_if(F.col("importance") < 0).alias("n_negative"),
        F.round(F.sum("importance"), 9).alias("total"),
        F.countDistinct("feature").alias("n_names"),
        (F.max("importance") > 1 / F.count("*")).alias("informed"),
    )


@query("M2_batch_predict", f"SELECT vec_id, target, TRUE AS consistent FROM ({EMBEDDED})")
def m2(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    return model.predict(rows, forest(spark, sf_dir)).select("vec_id", "target", consistent().alias("consistent"))


@query("M2_training_accuracy", f"SELECT count(*) AS n, CAST(sum(target) AS BIGINT) AS n_positive, TRUE AS better_than_majority FROM ({EMBEDDED})")
def m2_accuracy(spark, sf_dir):
    rows = model.predict(vectors(spark, sf_dir), forest(spark, sf_dir))
    share = F.avg("target")
    right = F.avg((F.col("prediction") == F.col("target")).cast("double"))
    return rows.agg(F.count("*").alias("n"), F.sum("target").cast("long").alias("n_positive"), (right > F.greatest(share, 1 - share)).alias("better_than_majority"))


@query("M3_top_features", "SELECT CAST(range AS INTEGER) AS position, TRUE AS ordered, TRUE AS component FROM range(1, 6)")
def m3(spark, sf_dir):
    """Ranks 1 to 5 of largest importance, each a component of the vector."""
    fitted = forest(spark, sf_dir)
    top = model.importances(spark, fitted, names(fitted), 5)
    before = F.lag("importance").over(Window.orderBy("position"))
    return top.select(
        "position", F.coalesce(before >= F.col("importance"), F.lit(True)).alias("ordered"), F.col("feature").isin(names(fitted)).alias("component")
    )


OBSERVED = f"WITH obs AS ({OBSERVATIONS})"


@query("M4_end_to_end_score", f'{OBSERVED} SELECT Date AS "Date", Location AS "Location", count(*) AS n, count(*) AS n_consistent FROM obs GROUP BY ALL')
def m4(spark, sf_dir):
    """Every raw row is scored once under its keys, by stored state only."""
    scored, _ = workflows.score(trained_home(spark, sf_dir), observations(spark, sf_dir).drop(LABEL))
    label = F.col("prediction_label") == F.when(F.col("prediction") == 1, "Yes").otherwise("No")
    return scored.groupBy("Date", "Location").agg(F.count("*").alias("n"), F.count_if(consistent() & label & (F.col("model_version") == 1)).alias("n_consistent"))


@query(
    "S6_metrics_document",
    f"""SELECT 'run-1' AS run_id, 'train' AS step, count(*) AS n, 5 AS n_features, TRUE AS in_range, TRUE AS same_f1, TRUE AS share_known FROM ({EMBEDDED})""",
)
def s6(spark, sf_dir):
    """The document that is read back holds what was measured."""
    fitted = forest(spark, sf_dir)
    scored = model.predict(vectors(spark, sf_dir), fitted)
    report = cut_lineage(metrics.report(scored, "target", "prediction", "probability"))
    path = new_path(spark, "metrics")
    document = tables.metrics_document(report, report, model.importances(spark, fitted, names(fitted)))
    tables.write_metrics(document, path, "run-1", "train")
    measured = report.first()
    read = tables.read_metrics(spark, path)
    shares = F.from_json(F.to_json("top_features"), "map<string,double>")
    parts = [F.col(c) for c in ("train.accuracy", "train.f1", "test.accuracy", "test.precision", "test.recall", "test.f1", "test.roc_auc")]
    inside = reduce(lambda a, b: a & b, [c.between(0, 1) for c in parts])
    return read.select(
        "run_id", "step",
        F.lit(measured["tp"] + measured["fp"] + measured["fn"] + measured["tn"]).alias("n"),
        F.size(shares).alias("n_features"),
        inside.alias("in_range"),
        ((F.abs(F.col("test.f1") - measured["f1"]) < 1e-9) & (F.col("train.f1") == F.col("test.f1"))).alias("same_f1"),
        (F.aggregate(F.map_values(shares), F.lit(0.0), lambda a, x: a + x) <= 1 + 1e-9).alias("share_known"),
    )


@query("S7_state_save_load", f'{OBSERVED} SELECT Date AS "Date", Location AS "Location", count(*) AS n, count(*) AS n_same FROM obs GROUP BY ALL')
def s7(spark, sf_dir):
    """A stored and loaded scoring state gives every row the probability that the state in memory gives it."""
    rows = observations(spark, sf_dir)
    home = workflows.Home(spark, new_path(spark, "home"))
    workflows.train(home, rows, "run-1", 1, params={"numTrees": 3, "maxDepth": 4, "seed": 42})
    state = model.ScoringState.load(spark, home.state_path(1))
    again = model.ScoringState.load(spark, state.save(new_path(spark, "state")))
    marked = written(rows.drop(LABEL).withColumn("__id", F.monotonically_increasing_id()), "rows")
    one, two = (model.score(marked, s, ["Date", "Location", "__id"]).select("__id", "Date", "Location", F.col("probability").alias(n)) for s, n in ((state, "p"), (again, "q")))
    return one.join(two.select("__id", "q"), "__id").groupBy("Date", "Location").agg(F.count("*").alias("n"), F.count_if(F.col("p") == F.col("q")).alias("n_same"))


_PREPARED_SQL = f"""
WITH obs AS ({OBSERVATIONS}),
m AS (SELECT
  (SELECT WindGustDir FROM obs WHERE WindGustDir IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mg,
  (SELECT WindDir9am FROM obs WHERE WindDir9am IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS m9,
  (SELECT WindDir3pm FROM obs WHERE WindDir3pm IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS m3),
filled AS (SELECT obs.* REPLACE (coalesce(WindGustDir, mg) AS WindGustDir, coalesce(WindDir9am, m9) AS WindDir9am,
  coalesce(WindDir3pm, m3) AS WindDir3pm, CASE RainToday WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS RainToday,
  CASE RainTomorrow WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS RainTomorrow) FROM obs, m),
coded AS (SELECT * REPLACE (CAST(dense_rank() OVER (ORDER BY Location) - 1 AS BIGINT) AS Location,
  CAST(dense_rank() OVER (ORDER BY WindGustDir) - 1 AS DOUBLE) AS WindGustDir,
  CAST(dense_rank() OVER (ORDER BY WindDir9am) - 1 AS DOUBLE) AS WindDir9am,
  CAST(dense_rank() OVER (ORDER BY WindDir3pm) - 1 AS DOUBLE) AS WindDir3pm) FROM filled),
kept AS (SELECT * EXCLUDE (Date, Temp3pm, Pressure9am, Temp9am, Rainfall) FROM coded WHERE RainToday IS NOT NULL AND RainTomorrow IS NOT NULL),
"""
_FENCED = [
    "MinTemp", "MaxTemp", "Evaporation", "Sunshine", "WindGustDir", "WindGustSpeed", "WindDir9am", "WindDir3pm", "WindSpeed9am",
    "WindSpeed3pm", "Humidity9am", "Humidity3pm", "Pressure3pm", "Cloud9am", "Cloud3pm",
]
_PREPARED_SQL += "f AS (SELECT " + ", ".join(
    f"""quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS l_{c},
    quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS u_{c}"""
    for c in _FENCED
) + " FROM kept)\n"


def _prepared_sql(value):
    columns = ", ".join(f"""round(CASE WHEN {c} IS NOT NULL THEN {value.format(c=c)} END, 6) + 0 AS "{c}" """ for c in _FENCED)
    return _PREPARED_SQL + f'SELECT "Location", CAST("RainToday" AS INTEGER) AS "RainToday", CAST("RainTomorrow" AS INTEGER) AS "RainTomorrow", {columns} FROM kept, f'


@query("W1_prepare", _prepared_sql("greatest(l_{c}, least(u_{c}, {c}))"))
def w1(spark, sf_dir):
    return rounded(workflows.prepare(observations(spark, sf_dir)).df)


@query("W1_prepare_collapsed", _prepared_sql("l_{c}"))
def w1_collapsed(spark, sf_dir):
    return rounded(workflows.prepare(observations(spark, sf_dir), fence_mode="collapse").df)


def _trained_sql(source: str) -> str:
    """What training must log, from the rows it sees."""
    return f"""{OBSERVED}, rows AS ({source}),
    c AS (SELECT count(*) AS n, count(*) FILTER (RainToday IS NULL OR RainTomorrow IS NULL) AS gone,
      count(*) FILTER (RainToday IS NOT NULL AND RainTomorrow = 'Yes') AS yes,
      count(*) FILTER (WindGustDir IS NULL) + count(*) FILTER (WindDir9am IS NULL) + count(*) FILTER (WindDir3pm IS NULL) AS filled FROM rows),
    t AS (SELECT *, n - gone AS kept, n - gone - CAST(ceil(CAST(0.2 AS DOUBLE) * (n - gone)) AS BIGINT) AS training FROM c),
    q AS (SELECT *, yes * training / kept AS exact_yes, (kept - yes) * training / kept AS exact_no FROM t),
    s AS (SELECT *, CAST(floor(exact_yes) AS BIGINT) + CASE WHEN training > floor(exact_yes) + floor(exact_no)
      AND exact_yes - floor(exact_yes) > exact_no - floor(exact_no) THEN 1 ELSE 0 END AS training_yes FROM q)
    """


@query(
    "W2_train",
    _trained_sql("SELECT * FROM obs")
    + """SELECT 'run-1' AS run_id, concat('(', n, ', 23)') AS initial_shape, concat('(', kept, ', 18)') AS final_shape, CAST(gone AS VARCHAR) AS rows_dropped,
    CAST(filled AS VARCHAR) AS missing_filled, CAST(training AS DOUBLE) AS train_samples, CAST(kept - training AS DOUBLE) AS test_samples,
    round(training_yes / training, 9) AS positive_ratio, 'COMPLETED' AS status, TRUE AS better_than_majority FROM s""",
)
def w2(spark, sf_dir):
    """What training logs about its rows, and whether the model beats the commoner class on them."""
    home = workflows.Home(spark, new_path(spark, "home"))
    workflows.train(home, observations(spark, sf_dir), "run-1", 1)
    return _logged(home)


def _logged(home):
    latest = runlog.current(home.run_log("run"))
    text = lambda key: F.max(F.when(F.col("key") == key, F.col("value")))
    number = lambda key: F.max(F.when(F.col("key") == key, F.col("num")))
    ratio = number("train_positive_class_ratio")
    return latest.groupBy("run_id").agg(
        text("data_preparation.initial_shape").alias("initial_shape"),
        text("data_preparation.final_shape").alias("final_shape"),
        text("data_preparation.rows_dropped").alias("rows_dropped"),
        text("data_preparation.missing_values_removed").alias("missing_filled"),
        number("train_samples").alias("train_samples"),
        number("test_samples").alias("test_samples"),
        F.round(ratio, 9).alias("positive_ratio"),
        text("pipeline_status").alias("status"),
        (number("train_accuracy") >= F.greatest(ratio, 1 - ratio) - 1e-9).alias("better_than_majority"),
    )


HISTORY = """SELECT * FROM (SELECT *, row_number() OVER (ORDER BY Date NULLS FIRST, Location NULLS FIRST) AS rn, count(*) OVER () AS total FROM obs)"""


@query(
    "W3_evaluate",
    "SELECT 'daily_label' AS model, '1' AS version, TRUE AS promoted, 'First model assigned as champion' AS promotion, TRUE AS same_metric, TRUE AS recorded",
)
def w3(spark, sf_dir):
    """The first version is promoted, its metric is the accuracy on the stored test rows, and the decision is in the log."""
    home = trained_home(spark, sf_dir)
    judged = workflows.evaluate(home, "run-1", 1)
    test = spark.read.parquet(home.at("scores")).where("split = 'test'")
    accuracy = test.agg(F.avg((F.col(LABEL) == F.col("prediction")).cast("double"))).first()[0]
    logged = runlog.search(home.run_log("run"), {"model_promotion": "First model assigned as champion"}).count()
    return judged.select("model", "version", "promoted", "promotion", (F.abs(F.col("metric") - accuracy) < 1e-9).alias("same_metric"), F.lit(logged == 1).alias("recorded"))


@query("W4_score", f"{OBSERVED} SELECT count(*) AS n_scored, CAST(0 AS BIGINT) AS n_rejected, count(*) AS n_consistent FROM obs")
def w4(spark, sf_dir):
    scored, rejects = workflows.score(trained_home(spark, sf_dir), observations(spark, sf_dir).drop(LABEL))
    counts = scored.agg(F.count("*").alias("n_scored"), F.count_if(consistent()).alias("n_consistent"))
    return counts.withColumn("n_rejected", rejects.agg(F.count("*")).scalar())


# Manual requests derived from line items: codes instead of names, some out of range, some without a field.
REQUESTS = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linenumber AS "Location", l_quantity - 10 AS "MinTemp", l_quantity - 10 + round(l_tax * 100) AS "MaxTemp",
  l_quantity * 7 AS "WindGustDir", l_quantity AS "WindGustSpeed", CAST(l_linenumber * 10 AS DOUBLE) AS "WindDir9am", CAST(l_linenumber * 20 AS DOUBLE) AS "WindDir3pm",
  l_quantity AS "WindSpeed9am", l_quantity + 1 AS "WindSpeed3pm", l_quantity * 2 AS "Humidity9am", l_quantity * 2.5 AS "Humidity3pm",
  CAST(1000 + l_linenumber AS DOUBLE) AS "Pressure3pm", CAST(l_linenumber AS DOUBLE) AS "Cloud9am", round(l_tax * 100) AS "Cloud3pm",
  CASE WHEN l_linenumber = 6 THEN NULL WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS "RainToday" FROM lineitem"""


@query(
    "W4_manual_requests",
    f"""WITH r AS ({REQUESTS}) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, concat_ws(',', CASE WHEN "RainToday" IS NULL THEN 'RainToday:required' END,
    CASE WHEN "Humidity3pm" > 100 THEN 'Humidity3pm:range' END) AS errors,
    "RainToday" IS NOT NULL AND "Humidity3pm" <= 100 AS scored FROM r""",
)
def w4_requests(spark, sf_dir):
    """Requests are scored or rejected with all their errors."""
    home, ids = trained_home(spark, sf_dir), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rows = spark.sql(REQUESTS.replace("FROM lineitem", "FROM {lineitem}").replace('"', "`"), lineitem=table(spark, sf_dir, "lineitem"))
    scored, rejects = workflows.score_requests(home, rows, ids, "all")
    good = scored.select(*ids, F.lit("").alias("errors"), consistent().alias("scored"))
    return good.unionByName(rejects.select(*ids, F.array_join("errors", ",").alias("errors"), F.lit(False).alias("scored")))


@query(
    "W1_extract",
    f"""{OBSERVED} SELECT 'run-0' AS run_id, concat('(', count(*), ', 23)') AS initial_shape,
    concat('(', count(*) FILTER (RainToday IS NOT NULL AND RainTomorrow IS NOT NULL), ', 18)') AS final_shape,
    CAST(count(*) FILTER (RainToday IS NULL OR RainTomorrow IS NULL) AS VARCHAR) AS rows_dropped,
    count(*) FILTER (RainToday IS NOT NULL AND RainTomorrow IS NOT NULL) AS n_prepared FROM obs""",
)
def w1_extract(spark, sf_dir):
    """Preparation alone: its counters in the log, its rows in the prepared table."""
    home = workflows.Home(spark, new_path(spark, "home"))
    prepared = workflows.extract(home, observations(spark, sf_dir), "run-0")
    facts = runlog.current(home.run_log("run"))
    text = lambda key: F.max(F.when(F.col("key") == f"data_preparation.{key}", F.col("value"))).alias(key)
    logged = facts.groupBy("run_id").agg(text("initial_shape"), text("final_shape"), text("rows_dropped"))
    return logged.withColumn("n_prepared", prepared.df.agg(F.count("*")).scalar())


@query("W5_full_workflow", _trained_sql(f"{HISTORY} WHERE rn <= CAST(floor(total * (CAST(2 AS DOUBLE) / 3)) AS BIGINT)") + "SELECT 'run-1' AS run_id, 'COMPLETED' AS status, concat('(', n, ', 23)') AS initial_shape, 2 AS n_steps FROM s")
def w5(spark, sf_dir):
    """Load, prepare, train, evaluate and promote, as the log tells it."""
    log = trained_home(spark, sf_dir).run_log("run")
    started = F.col("key").startswith("step_") & F.col("key").endswith("_start_time")
    shapes = log.groupBy("run_id").agg(F.max(F.when(F.col("key") == "data_preparation.initial_shape", F.col("value"))).alias("initial_shape"), F.count_if(started).cast("int").alias("n_steps"))
    return runlog.status(log).select("run_id", "status").join(shapes, "run_id")


@query(
    "W6_initial_load",
    """WITH n AS (SELECT count(*) AS n, CAST(floor(count(*) * (CAST(2 AS DOUBLE) / 3)) AS BIGINT) AS t FROM lineitem)
    SELECT 'training' AS split, t AS n_rows FROM n UNION ALL SELECT 'prediction', n - t FROM n""",
)
def w6(spark, sf_dir):
    return workflows.initial_load(workflows.Home(spark, new_path(spark, "home")), observations(spark, sf_dir))


@query(
    "W7_daily",
    f"""{OBSERVED} SELECT "Date" AS "Date", "Location" AS "Location", TRUE AS consistent FROM ({HISTORY})
    WHERE rn > CAST(floor(total * (CAST(2 AS DOUBLE) / 3)) AS BIGINT) AND rn <= CAST(floor(total * (CAST(2 AS DOUBLE) / 3)) AS BIGINT) + 10""",
)
def w7(spark, sf_dir):
    """Two days of five rows each: the ten rows that follow the training rows."""
    home = trained_home(spark, sf_dir)
    first = workflows.daily(home, 0, 5)
    return workflows.daily(home, 1, 5).unionByName(first).select("Date", "Location", consistent().alias("consistent"))


@query(
    "W7_daily_log",
    "SELECT CAST(10 AS BIGINT) AS n_runs, CAST(10 AS BIGINT) AS n_completed, CAST(2 AS BIGINT) AS n_hashes, CAST(10 AS BIGINT) AS n_predictions FROM (SELECT count(*) FROM lineitem)",
)
def w7_log(spark, sf_dir):
    """Each scored row is a child run with its status, and each batch has its fingerprint."""
    home = trained_home(spark, sf_dir)
    for day in (0, 1):
        workflows.daily(home, day, 5)
    tag = lambda key: F.when(F.col("key") == key, F.col("value"))
    return home.run_log("prediction").agg(
        F.countDistinct("run_id").alias("n_runs"),
        F.count_if(tag("prediction_status") == "COMPLETED").alias("n_completed"),
        F.countDistinct(tag("data_hash")).alias("n_hashes"),
        F.count_if(F.col("key") == "prediction_result").alias("n_predictions"),
    )
