"""Running values and neighbours over an ordered table without a single-partition window.

A table larger than `ROWS_PER_BUCKET` is range-partitioned into buckets first. Each bucket is processed by its own task;
what crosses a bucket border is carried over through one small row per (group, bucket). A group that holds a third of
all rows is therefore spread over as many tasks as any other stretch of the order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsforge.session import cut_lineage

ROWS_PER_BUCKET = 1_000_000
BUCKET = "__bucket"


def bucketed(df: DataFrame, order: Sequence[str], rows: int, rows_per_bucket: int | None = None) -> tuple[DataFrame, bool]:
    """Add a bucket number that grows with the order; `rows` is an estimate of the table size.

    The ranges come from Spark's range partitioner. The result is checkpointed, so a recomputed task can never see
    other borders than the rest of the job.
    """
    size = rows_per_bucket or ROWS_PER_BUCKET
    if rows <= size:
        return df.withColumn(BUCKET, F.lit(0)), False
    ranged = df.repartitionByRange(-(-rows // size), *[F.col(c) for c in order])
    return cut_lineage(ranged.withColumn(BUCKET, F.spark_partition_id())), True


def running_before(
    df: DataFrame,
    order: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    maxima: Mapping[str, Column] | None = None,
    group: Sequence[str] = (),
    rows: int = 0,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """For each row: sums (0 at the start) and maxima (null at the start) over the rows that precede it in its group.

    `order` must identify the rows of a group.
    """
    sums, maxima, group = dict(sums or {}), dict(maxima or {}), list(group)
    parts, split = bucketed(df, order if not group else [*order, *group], rows, rows_per_bucket)
    inner = Window.partitionBy(*group, BUCKET).orderBy(*order)
    earlier = inner.rowsBetween(Window.unboundedPreceding, -1)
    keep = [F.col(c) for c in df.columns]
    within = parts.select(
        *keep,
        BUCKET,
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(name) for name, c in sums.items()],
        *[F.max(c).over(earlier).alias(name) for name, c in maxima.items()],
    )
    if not split:
        return within.drop(BUCKET)
    totals = parts.groupBy(*group, BUCKET).agg(
        *[F.sum(c).alias(f"__{name}") for name, c in sums.items()],
        *[F.max(c).alias(f"__{name}") for name, c in maxima.items()],
    )
    outer = Window.partitionBy(*(group or [F.lit(0)])).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *group,
        BUCKET,
        *[F.coalesce(F.sum(f"__{name}").over(outer), F.lit(0)).alias(f"__{name}") for name in sums],
        *[F.max(f"__{name}").over(outer).alias(f"__{name}") for name in maxima],
    )
    joined = _null_safe_join(within, carried, [*group, BUCKET])
    return joined.select(
        *keep,
        *[(F.col(name) + F.col(f"__{name}")).alias(name) for name in sums],
        *[F.greatest(F.col(name), F.col(f"__{name}")).alias(name) for name in maxima],
    )


def neighbours(
    df: DataFrame,
    order: Sequence[str],
    columns: Mapping[str, Column],
    group: Sequence[str] = (),
    following: bool = False,
    rows: int = 0,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Values of the previous (or following) row of the same group; null at the edge."""
    group = list(group)
    parts, split = bucketed(df, order if not group else [*order, *group], rows, rows_per_bucket)
    ordering = [F.col(c).desc() if following else F.col(c).asc() for c in order]
    inner = Window.partitionBy(*group, BUCKET).orderBy(*ordering)
    packed = F.struct(*[c.alias(name) for name, c in columns.items()])
    keep = [F.col(c) for c in df.columns]
    within = parts.select(*keep, BUCKET, F.lag(packed).over(inner).alias("__near"))
    if split:
        position = F.struct(*[F.col(c) for c in order])
        pick = F.min_by if following else F.max_by
        edges = parts.groupBy(*group, BUCKET).agg(pick(packed, position).alias("__edge"))
        direction = F.col(BUCKET).desc() if following else F.col(BUCKET).asc()
        outer = Window.partitionBy(*(group or [F.lit(0)])).orderBy(direction)
        carried = edges.select(*group, BUCKET, F.lag("__edge").over(outer).alias("__edge"))
        joined = _null_safe_join(within, carried, [*group, BUCKET])
        within = joined.withColumn("__near", F.coalesce("__near", "__edge"))
    return within.select(*keep, *[F.col("__near")[name].alias(name) for name in columns])


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = right.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    condition = None
    for key in keys:
        term = left[key].eqNullSafe(renamed[f"__k_{key}"])
        condition = term if condition is None else condition & term
    return left.join(renamed, condition, "left").drop(*[f"__k_{k}" for k in keys])
