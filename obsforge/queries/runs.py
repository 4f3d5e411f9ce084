"""Run log and champion selection."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from obsforge.operators import runlog
from obsforge.queries.base import query, rounded, table


def event_log(spark, sf_dir):
    """Users as runs, event types as keys, event values as what was logged."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("run"), F.col("user_id")).alias("run_id"),
        F.lit("metric").alias("kind"),
        F.col("event_type").alias("key"),
        F.lit(None).cast("string").alias("value"),
        F.col("value").alias("num"),
        "ts",
        "event_id",
    )


@query(
    "P10_tag_search",
    """WITH t AS (SELECT user_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
      row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events),
    p AS (SELECT user_id, max(CASE WHEN event_type = 'click' THEN CASE WHEN k < 50 THEN 'low' ELSE 'high' END END) AS a,
      max(CASE WHEN event_type = 'view' THEN CASE WHEN k < 50 THEN 'low' ELSE 'high' END END) AS b FROM t WHERE rn = 1 GROUP BY user_id)
    SELECT concat('run', user_id) AS run_id FROM p WHERE a = 'low' AND b = 'high'""",
)
def p10(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("bigint")
    log = table(spark, sf_dir, "events").select(
        F.concat(F.lit("run"), F.col("user_id")).alias("run_id"),
        F.lit("tag").alias("kind"),
        F.col("event_type").alias("key"),
        F.when(k < 50, "low").otherwise("high").alias("value"),
        F.lit(None).cast("double").alias("num"),
        F.struct("ts", "event_id").alias("ts"),
    )
    return runlog.search(log, {"click": "low", "view": "high"})


@query(
    "R1_current_facts",
    """SELECT concat('run', user_id) AS run_id, event_type AS key, value AS num, ts FROM (SELECT *,
    row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def r1(spark, sf_dir):
    return runlog.current(event_log(spark, sf_dir), ["ts", "event_id"]).select("run_id", "key", "num", "ts")


@query(
    "R2_run_status",
    """SELECT concat('run', user_id) AS run_id, arg_max(event_type, ts) AS status, min(ts) AS started, max(ts) AS ended FROM events GROUP BY user_id""",
)
def r2(spark, sf_dir):
    log = event_log(spark, sf_dir).withColumns({"value": F.col("key"), "key": F.lit("workflow_status")})
    return runlog.status(log, order=["ts", "event_id"])


@query(
    "R2_step_durations",
    """SELECT event_id, round(CAST(epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) - epoch_us(ts) AS DOUBLE) / 1000000, 6) AS seconds
    FROM events""",
)
def r2_steps(spark, sf_dir):
    steps = event_log(spark, sf_dir).select("run_id", "ts", "event_id")
    return rounded(runlog.step_durations(steps, ties=["event_id"]).select("event_id", "seconds"))


def order_versions(spark, sf_dir):
    """Customers as models, orders as their versions, prices as the metric."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("model"), F.col("o_orderkey").cast("string").alias("version"), F.col("o_totalprice").alias("metric")
    )


@query("R3_latest_version", "SELECT o_custkey AS model, max(o_orderkey) AS version FROM orders GROUP BY o_custkey")
def r3(spark, sf_dir):
    return runlog.latest_version(order_versions(spark, sf_dir))


PROMOTED = """SELECT o_custkey AS model, o_orderkey AS version, coalesce(o_totalprice >= max(o_totalprice)
  OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), TRUE) AS promoted FROM orders"""


@query("R4_promotion", f"SELECT model, CAST(version AS VARCHAR) AS version, promoted FROM ({PROMOTED})")
def r4(spark, sf_dir):
    return runlog.promote(order_versions(spark, sf_dir)).select("model", "version", "promoted")


@query("R4_champion", f"SELECT model, max(version) AS champion FROM ({PROMOTED}) WHERE promoted GROUP BY model")
def r4_champion(spark, sf_dir):
    return runlog.champions(runlog.promote(order_versions(spark, sf_dir)))


@query(
    "R5_metric_fallback",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_totalprice WHEN 'O' THEN o_totalprice / 2 ELSE CAST(0 AS DOUBLE) END AS metric FROM orders""",
)
def r5(spark, sf_dir):
    numbers = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("eval_accuracy"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") / 2).alias("test_accuracy"),
    )
    return numbers.select("o_orderkey", runlog.metric_or_fallback("eval_accuracy", "test_accuracy").alias("metric"))


@query(
    "R6_deployments",
    f"""WITH c AS (SELECT model, max(version) AS version FROM ({PROMOTED}) WHERE promoted GROUP BY model),
    l AS (SELECT o_custkey AS model, max(o_orderkey) AS version FROM orders GROUP BY o_custkey)
    SELECT model, version, md5(concat_ws('|', model, version)) AS run_id FROM c
    WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.model = c.model AND l.version = c.version)""",
)
def r6(spark, sf_dir):
    versions = order_versions(spark, sf_dir)
    existing = runlog.deployed_version(versions)
    return runlog.missing_deployments(runlog.deployed_version(versions, runlog.promote(versions)), existing)


@query(
    "R7_prediction_log",
    """SELECT CAST(o_orderkey AS VARCHAR) AS parent_run_id, count(*) AS n_predictions,
    CAST(sum(CASE WHEN l_quantity >= 25 THEN 1 ELSE 0 END) AS BIGINT) AS n_positive, round(avg(l_quantity / 50), 6) AS mean_probability
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
)
def r7(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    lines = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    scored = lines.select(
        "o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_orderpriority", "l_quantity",
        (F.col("l_quantity") >= 25).cast("int").alias("prediction"),
        (F.col("l_quantity") / 50).alias("probability"),
        F.when(F.col("l_quantity") >= 25, "Yes").otherwise("No").alias("prediction_label"),
        F.lit(1).alias("model_version"),
    )
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    ids, inputs = ["l_linenumber", "l_partkey", "l_suppkey"], ["o_orderpriority", "l_quantity"]
    facts = runlog.prediction_facts(scored, F.col("o_orderkey"), ids, inputs, "prediction", at)
    return rounded(runlog.roll_up(facts))
