"""Classification metrics and curves."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsforge.operators import metrics
from obsforge.queries.base import SCORED, query, rounded, scored, table

CELLS = f"""WITH s AS ({SCORED}),
c AS (SELECT CAST(sum(label * prediction) AS DOUBLE) AS tp, CAST(sum((1 - label) * prediction) AS DOUBLE) AS fp,
  CAST(sum(label * (1 - prediction)) AS DOUBLE) AS fn, CAST(sum((1 - label) * (1 - prediction)) AS DOUBLE) AS tn FROM s)
"""


def _threshold(spark, sf_dir, name):
    return rounded(metrics.threshold_metrics(metrics.confusion(scored(spark, sf_dir))).select(name))


@query("L1_accuracy", CELLS + "SELECT round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy FROM c")
def l1(spark, sf_dir):
    return _threshold(spark, sf_dir, "accuracy")


@query("L2_precision", CELLS + 'SELECT round(tp / (tp + fp), 6) AS "precision" FROM c')
def l2(spark, sf_dir):
    return _threshold(spark, sf_dir, "precision")


@query("L3_recall", CELLS + "SELECT round(tp / (tp + fn), 6) AS recall FROM c")
def l3(spark, sf_dir):
    return _threshold(spark, sf_dir, "recall")


@query(
    "L4_f1",
    CELLS + "SELECT round(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)), 6) AS f1 FROM c",
)
def l4(spark, sf_dir):
    return _threshold(spark, sf_dir, "f1")


# Running counts over the distinct scores, highest first.
CURVE = f"""WITH s AS ({SCORED}),
g AS (SELECT score, CAST(sum(label) AS DOUBLE) AS pos, CAST(sum(1 - label) AS DOUBLE) AS neg FROM s GROUP BY score),
c AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
  sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM g)
"""


@query("L5_roc_auc", CURVE + "SELECT round(sum(neg * (tp - pos / 2)) / (max(p) * max(n)), 6) AS roc_auc FROM c")
def l5(spark, sf_dir):
    return rounded(metrics.ranking_metrics(scored(spark, sf_dir)).select("roc_auc"))


@query(
    "L6_confusion_matrix",
    f"""SELECT l.v AS label, p.v AS prediction, count(s.score) AS n
    FROM (SELECT 0 AS v UNION ALL SELECT 1) l CROSS JOIN (SELECT 0 AS v UNION ALL SELECT 1) p
    LEFT JOIN ({SCORED}) s ON s.label = l.v AND s.prediction = p.v GROUP BY 1, 2""",
)
def l6(spark, sf_dir):
    return metrics.confusion_cells(scored(spark, sf_dir))


@query("L7_average_precision", CURVE + "SELECT round(sum(pos * tp / (tp + fp)) / max(p), 6) AS average_precision FROM c")
def l7(spark, sf_dir):
    return rounded(metrics.ranking_metrics(scored(spark, sf_dir)).select("average_precision"))



def _bounded(points):
    """The infinite threshold of the start point as 9, so that engines need not agree on infinity."""
    return rounded(points.withColumn("threshold", F.when(F.col("threshold") < float("inf"), F.col("threshold")).otherwise(F.lit(9.0))))


@query(
    "L8_roc_curve",
    CURVE
    + """SELECT round(score, 6) AS threshold, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM c
    UNION ALL SELECT CAST(9 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)""",
)
def l8(spark, sf_dir):
    return _bounded(metrics.roc_curve(scored(spark, sf_dir)))


@query(
    "L8_roc_curve_without_collinear",
    CURVE
    + """, b AS (SELECT *, lead(pos) OVER (ORDER BY score DESC) AS np, lead(neg) OVER (ORDER BY score DESC) AS nn FROM c)
    SELECT round(score, 6) AS threshold, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM b
    WHERE np IS NULL OR np <> pos OR nn <> neg
    UNION ALL SELECT CAST(9 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)""",
)
def l8_short(spark, sf_dir):
    return _bounded(metrics.roc_curve(scored(spark, sf_dir), drop_collinear=True))


@query(
    "L9_pr_curve",
    CURVE
    + """SELECT round(score, 6) AS threshold, round(tp / (tp + fp), 6) AS "precision", round(tp / p, 6) AS recall FROM c
    UNION ALL SELECT NULL, CAST(1 AS DOUBLE), CAST(0 AS DOUBLE)""",
)
def l9(spark, sf_dir):
    return rounded(metrics.pr_curve(scored(spark, sf_dir)))


@query(
    "L9_pr_area",
    CURVE
    + """, d AS (SELECT *, tp / (tp + fp) AS pr, coalesce(lag(tp / (tp + fp)) OVER (ORDER BY score DESC), 1) AS before FROM c)
    SELECT round(sum(pos * (pr + before) / 2) / max(p), 6) AS pr_auc FROM d""",
)
def l9_area(spark, sf_dir):
    return rounded(metrics.ranking_metrics(scored(spark, sf_dir)).select("pr_auc"))


@query(
    "L10_residual_histogram",
    f"""WITH r AS (SELECT CAST(label AS DOUBLE) - score AS r FROM ({SCORED})),
    m AS (SELECT min(r) AS low, max(r) AS high, (max(r) - min(r)) / 30 AS width FROM r),
    h AS (SELECT CAST(e.bin AS INTEGER) AS bin, count(*) AS n FROM r, m, range(1, 31) e(bin)
      WHERE r >= low + (e.bin - 1) * width AND (e.bin = 30 OR r < low + e.bin * width) GROUP BY 1)
    SELECT CAST(e.bin AS INTEGER) AS bin, round(low + (e.bin - 1) * width, 6) + 0 AS low, round(low + e.bin * width, 6) + 0 AS high,
    coalesce(h.n, 0) AS n FROM range(1, 31) e(bin) CROSS JOIN m LEFT JOIN h ON h.bin = e.bin""",
)
def l10(spark, sf_dir):
    return rounded(metrics.residual_histogram(scored(spark, sf_dir)))


SUMMARY = """'F1: ' || printf('%.4f', 2 * tp / (2 * tp + fp + fn)) || ', Accuracy: ' || printf('%.4f', (tp + tn) / (tp + fp + fn + tn))
  || ', Precision: ' || printf('%.4f', tp / (tp + fp)) || ', Recall: ' || printf('%.4f', tp / (tp + fn)) || ', ROC-AUC: ' || printf('%.4f', auc)"""


@query(
    "L11_summary_text",
    CURVE
    + """, k AS (SELECT CAST(sum(label * prediction) AS DOUBLE) AS tp, CAST(sum((1 - label) * prediction) AS DOUBLE) AS fp,
    CAST(sum(label * (1 - prediction)) AS DOUBLE) AS fn, CAST(sum((1 - label) * (1 - prediction)) AS DOUBLE) AS tn FROM s),
    a AS (SELECT sum(neg * (tp - pos / 2)) / (max(p) * max(n)) AS auc FROM c) SELECT """
    + SUMMARY
    + " AS performance_summary FROM k, a",
)
def l11(spark, sf_dir):
    return metrics.summary_text(metrics.report(scored(spark, sf_dir))).select("performance_summary")


TWO_MODELS = """SELECT 'quantity' AS model, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
  CASE WHEN l_quantity / 50 >= 0.5 THEN 1 ELSE 0 END AS prediction, l_quantity / 50 AS score FROM lineitem
UNION ALL SELECT 'price', CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END,
  CASE WHEN l_extendedprice / 105000 >= 0.5 THEN 1 ELSE 0 END, l_extendedprice / 105000 FROM lineitem"""


@query(
    "M5_model_comparison",
    f"""WITH s AS ({TWO_MODELS}),
    k AS (SELECT model, sum(label * prediction) AS tp, sum((1 - label) * prediction) AS fp, sum(label * (1 - prediction)) AS fn,
      sum((1 - label) * (1 - prediction)) AS tn FROM s GROUP BY model),
    g AS (SELECT model, score, CAST(sum(label) AS DOUBLE) AS pos, CAST(sum(1 - label) AS DOUBLE) AS neg FROM s GROUP BY model, score),
    c AS (SELECT model, pos, neg, sum(pos) OVER (PARTITION BY model ORDER BY score DESC) AS tp,
      sum(neg) OVER (PARTITION BY model ORDER BY score DESC) AS fp FROM g),
    a AS (SELECT model, sum(neg * (tp - pos / 2)) / (sum(pos) * sum(neg)) AS roc_auc,
      sum(pos * tp / (tp + fp)) / sum(pos) AS average_precision FROM c GROUP BY model)
    SELECT model, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn,
      round(CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn), 6) AS accuracy, round(CAST(tp AS DOUBLE) / (tp + fp), 6) AS "precision",
      round(CAST(tp AS DOUBLE) / (tp + fn), 6) AS recall, round(CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn), 6) AS f1,
      round(roc_auc, 6) AS roc_auc, round(average_precision, 6) AS average_precision
    FROM k JOIN a USING (model)""",
)
def m5(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    scores = F.array(
        *[
            F.struct(F.lit(name).alias("model"), (F.col(column) / limit).alias("score"))
            for name, column, limit in (("quantity", "l_quantity", 50.0), ("price", "l_extendedprice", 105000.0))
        ]
    )
    label = (F.col("l_returnflag") == "R").cast("int").alias("label")
    rows = lines.select(label, F.inline(scores)).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    return rounded(metrics.report(rows, group=["model"]).drop("pr_auc"))
