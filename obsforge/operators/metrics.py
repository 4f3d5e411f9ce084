"""Classification metrics and curves as aggregates over (label, prediction, score).

Everything starts from counts per distinct score, combined before the shuffle and kept; curves are running totals over those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsforge.functions.columns import ratio
from obsforge.plans.ordered import neighbours, running_before
from obsforge.session import cut_lineage


CELLS = ["tp", "fp", "fn", "tn"]
THRESHOLD = ["accuracy", "precision", "recall", "f1"]
RANKING = ["roc_auc", "average_precision", "pr_auc"]


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction", group: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn per group, from one aggregate."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    counts = [
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"),
    ]
    return df.groupBy(*group).agg(*counts) if group else df.agg(*counts)


def confusion_cells(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """The four cells as rows, zero cells included."""
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    packed = F.array(
        *[F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"), F.col(c).alias("n")) for a, b, c in cells]
    )
    return confusion(df, label, prediction).select(F.inline(packed))


def accuracy_of(tp: Column, fp: Column, fn: Column, tn: Column) -> Column:
    return ratio(tp + tn, tp + fp + fn + tn)


def threshold_metrics(counts: DataFrame) -> DataFrame:
    """accuracy, precision, recall, f1 from a confusion table; 0 where undefined."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns(
        {
            "accuracy": accuracy_of(tp, fp, fn, tn),
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "f1": ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def score_counts(
    df: DataFrame, label: str = "label", score: str = "score", group: Sequence[str] = (), prediction: str | None = None
) -> DataFrame:
    """Positives and negatives per distinct score; with `prediction` also how many of each were predicted positive."""
    y = F.col(label) == 1
    counts = [F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")]
    if prediction is not None:
        p = F.col(prediction) == 1
        counts += [F.count_if(y & p).alias("hits"), F.count_if(~y & p).alias("alarms")]
    return df.groupBy(*group, F.col(score).alias("score")).agg(*counts)


def _descending(counts: DataFrame, group: Sequence[str], rows: int, rows_per_bucket: int | None) -> DataFrame:
    """Counts with tp0 / fp0, the positives and negatives of all higher scores."""
    keyed = counts.withColumn("__rank", -F.col("score"))
    return running_before(
        keyed, ["__rank"], {"tp0": F.col("pos"), "fp0": F.col("neg")}, group=group, rows=rows, rows_per_bucket=rows_per_bucket
    )


def _with_totals(curve: DataFrame, counts: DataFrame) -> DataFrame:
    """Add P and N, all positives and negatives."""
    totals = counts.agg(F.struct(F.sum("pos").alias("P"), F.sum("neg").alias("N"))).scalar()
    return curve.withColumn("__totals", totals).select("*", "__totals.P", "__totals.N")


def distinct_scores(df: DataFrame, score: str = "score", group: Sequence[str] = ()) -> int:
    """Sketch of the number of (group, score) pairs; decides how many tasks share the ordering."""
    keys = [F.col(c) for c in (*group, score)]
    return int(df.agg(F.approx_count_distinct(F.struct(*keys) if group else keys[0])).first()[0] * 1.2) + 1


def ranking_metrics(
    df: DataFrame,
    label: str = "label",
    score: str = "score",
    group: Sequence[str] = (),
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """roc_auc (ties count half), average_precision (step-wise) and pr_auc (trapezoids), one row per group.

    A group with one class only has no ROC area: roc_auc is null there.
    """
    counts = cut_lineage(score_counts(df, label, score, group))
    curve = _descending(counts, group, counts.count(), rows_per_bucket)
    sums = _area_sums()
    total = curve.groupBy(*group).agg(*sums) if group else curve.agg(*sums)
    return total.select(*group, *_areas())


def _area_sums() -> list[Column]:
    tp0, fp0, pos, neg = (F.col(c).cast("double") for c in ("tp0", "fp0", "pos", "neg"))
    tp, seen = tp0 + pos, tp0 + pos + fp0 + neg
    before = F.when(tp0 + fp0 == 0, F.lit(1.0)).otherwise(ratio(tp0, tp0 + fp0))
    return [
        F.sum(neg * (tp0 + pos / 2)).alias("area"),
        F.sum(pos * ratio(tp, seen)).alias("steps"),
        F.sum(pos * (ratio(tp, seen) + before) / 2).alias("trapezoids"),
        F.sum("pos").alias("P"),
        F.sum("neg").alias("N"),
    ]


def _areas() -> list[Column]:
    return [
        F.try_divide(F.col("area"), F.col("P").cast("double") * F.col("N")).alias("roc_auc"),
        ratio(F.col("steps"), F.col("P")).alias("average_precision"),
        ratio(F.col("trapezoids"), F.col("P")).alias("pr_auc"),
    ]


def roc_curve(
    df: DataFrame,
    label: str = "label",
    score: str = "score",
    drop_collinear: bool = False,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, from the start point (infinity, 0, 0) on.

    `drop_collinear` leaves out inner points that lie on the line through their neighbours.
    """
    counts = cut_lineage(score_counts(df, label, score))
    estimate = counts.count()
    curve = _descending(counts, [], estimate, rows_per_bucket)
    start = F.lit(float("inf"))
    if drop_collinear:
        curve = neighbours(
            curve, ["__rank"], {"next_pos": F.col("pos"), "next_neg": F.col("neg")}, following=True,
            rows=estimate, rows_per_bucket=rows_per_bucket,
        )
        bends = F.col("next_pos").isNull() | (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
        curve = curve.where(bends)
    points = _with_totals(curve, counts).select(
        F.col("score").cast("double").alias("threshold"),
        ratio(F.col("fp0") + F.col("neg"), F.col("N")).alias("fpr"),
        ratio(F.col("tp0") + F.col("pos"), F.col("P")).alias("tpr"),
    )
    first = df.sparkSession.range(1).select(start.alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(first)


def pr_curve(df: DataFrame, label: str = "label", score: str = "score", rows_per_bucket: int | None = None) -> DataFrame:
    """(threshold, precision, recall) per distinct score, plus the end point (null, 1, 0)."""
    counts = cut_lineage(score_counts(df, label, score))
    curve = _descending(counts, [], counts.count(), rows_per_bucket)
    tp, seen = F.col("tp0") + F.col("pos"), F.col("tp0") + F.col("pos") + F.col("fp0") + F.col("neg")
    points = _with_totals(curve, counts).select(
        F.col("score").cast("double").alias("threshold"),
        ratio(tp, seen).alias("precision"),
        F.when(F.col("P") == 0, F.lit(1.0)).otherwise(ratio(tp, F.col("P"))).alias("recall"),
    )
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)


def residual_histogram(df: DataFrame, label: str = "label", score: str = "score", bins: int = 30) -> DataFrame:
    """Counts of label - score in equal bins from the smallest to the largest residual; the last bin is closed."""
    residual = df.select((F.col(label).cast("double") - F.col(score).cast("double")).alias("r"))
    span = residual.agg(F.min("r").alias("low"), F.max("r").alias("high")).first()
    if span["low"] is None:
        return df.sparkSession.createDataFrame([], "bin int, low double, high double, n long")
    low, high = span["low"], span["high"]
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    # Dividing can land one bin off at an edge, so the guess is checked against the edges themselves.
    guess = F.least(F.floor((F.col("r") - low) / width), F.lit(bins - 1))
    down = (F.col("r") < F.lit(low) + guess * F.lit(width)).cast("int")
    up = ((F.col("r") >= F.lit(low) + (guess + 1) * F.lit(width)) & (guess < bins - 1)).cast("int")
    counted = residual.groupBy((guess + 1 - down + up).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    edges = every.select(
        "bin",
        (F.lit(low) + (F.col("bin") - 1) * F.lit(width)).alias("low"),
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("high"),
    )
    return edges.join(counted, "bin", "left").select("bin", "low", "high", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def report(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    score: str = "score",
    group: Sequence[str] = (),
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """All scalar metrics per group: counts, accuracy, precision, recall, f1, roc_auc, average_precision, pr_auc."""
    counts = score_counts(df, label, score, group, prediction)
    curve = _descending(counts, group, distinct_scores(df, score, group), rows_per_bucket)
    sums = [*_area_sums(), F.sum("hits").alias("tp"), F.sum("alarms").alias("fp")]
    total = curve.groupBy(*group).agg(*sums) if group else curve.agg(*sums)
    cells = ["tp", "fp", (F.col("P") - F.col("tp")).alias("fn"), (F.col("N") - F.col("fp")).alias("tn")]
    out = threshold_metrics(total.select(*group, *cells, *_areas()))
    return out.select(*group, *CELLS, *THRESHOLD, *RANKING)


def summary_text(metrics: DataFrame, name: str = "performance_summary") -> DataFrame:
    text = F.format_string(
        "F1: %.4f, Accuracy: %.4f, Precision: %.4f, Recall: %.4f, ROC-AUC: %.4f",
        "f1", "accuracy", "precision", "recall", "roc_auc",
    )
    return metrics.withColumn(name, text)
