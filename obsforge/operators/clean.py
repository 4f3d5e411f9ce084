"""Cleaning: label flags, mode and median fill, missing indicators, row and cell counters, projections."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsforge.functions.columns import flag, label_text, no_nan
from obsforge.operators.profile import _long
from obsforge.plans.ranks import exact_quantiles


def binary_map(
    df: DataFrame, columns: Sequence[str], yes: str = "Yes", no: str = "No", passthrough: bool = False
) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: flag(F.col(c), yes, no, passthrough) for c in present})


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*columns)


def drop_unlabelled(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Rows with a null label go, but only where all label columns exist."""
    return df.na.drop(subset=list(labels)) if set(labels) <= set(df.columns) else df


def features_and_label(df: DataFrame, label: str, features: Sequence[str] | None = None) -> DataFrame:
    names = list(features or [c for c in df.columns if c != label])
    return df.select(*[F.col(c).cast("double").alias(c) for c in names], F.col(label))


def align(df: DataFrame, order: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the columns of `order`; absent ones are null, others go unless named in `keep`."""
    absent = F.lit(None).cast("double")
    return df.select(*keep, *[(F.col(c) if c in df.columns else absent).alias(c) for c in order])


def first_rows(df: DataFrame, order: Sequence[str], n: int = 1) -> DataFrame:
    return df.orderBy(*order).limit(n)


def with_label_text(df: DataFrame, column: str, name: str = "prediction_label") -> DataFrame:
    return df.withColumn(name, label_text(F.col(column)))


def key_values(df: DataFrame, ids: Sequence[str], columns: Sequence[str] | None = None, null_text: str = "NA") -> DataFrame:
    """One (key, text value) row per column, as run parameters are logged."""
    names = [c for c in columns or df.columns if c not in ids]
    texts = df.select(*ids, *[F.coalesce(F.col(c).cast("string"), F.lit(null_text)).alias(c) for c in names])
    return texts.unpivot(list(ids), names, "key", "value")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) over all columns in one scan; counted before the shuffle, so a hot value costs nothing."""
    pairs = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    )
    return pairs.groupBy("column", "value").agg(F.count("*").alias("n"))


def modes_of(counts: DataFrame) -> DataFrame:
    """Most frequent non-null value per column, the smallest on ties; null where a column has no value."""
    ordering = F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("n"), F.col("value").alias("value")))
    return counts.groupBy("column").agg(F.min_by("value", ordering).alias("mode"))


def fit_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return modes_of(value_counts(df, columns))


def fill_mode(df: DataFrame, modes: DataFrame) -> DataFrame:
    """Fill from a (column, mode) table: one row per column, so it is read as literals."""
    fills = {r["column"]: r["mode"] for r in modes.collect()}
    empty = sorted(c for c, value in fills.items() if value is None)
    if empty:
        raise ValueError(f"no value to fill with in: {', '.join(empty)}")
    return _fill(df, fills)


def fit_median(df: DataFrame, columns: Sequence[str], known_few: Sequence[str] = ()) -> DataFrame:
    found = exact_quantiles(df, columns, [0.5], known_few=known_few)
    return df.sparkSession.createDataFrame([(c, found[(c, 0.5)]) for c in columns], "column string, median double")


def fill_median(df: DataFrame, medians: DataFrame) -> DataFrame:
    """A column without any value gets 0.0, so that no null is left for the model."""
    return _fill(df, {r["column"]: 0.0 if r["median"] is None else r["median"] for r in medians.collect()})


def _fill(df: DataFrame, fills: Mapping[str, Any]) -> DataFrame:
    present = {c: v for c, v in fills.items() if c in df.columns}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in present.items()}) if present else df


def missing_flags(df: DataFrame, columns: Sequence[str], suffix: str = "_missing") -> DataFrame:
    return df.withColumns({f"{c}{suffix}": F.col(c).isNull().cast("double") for c in columns})


def without_nan(df: DataFrame) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if f.dataType.simpleString() in ("double", "float")]
    return df.withColumns({c: no_nan(F.col(c)) for c in doubles}) if doubles else df


def null_cells(df: DataFrame) -> DataFrame:
    """Null cells of the whole table and its rows, in one scan."""
    cells = F.lit(0)
    for c in df.columns:
        cells = cells + F.col(c).isNull().cast("long")
    return df.agg(F.coalesce(F.sum(cells), F.lit(0)).cast("long").alias("null_cells"), F.count("*").alias("n_rows"))


def stage_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and null cells after each stage, in the order given."""
    out = None
    for i, (name, df) in enumerate(stages.items()):
        row = null_cells(df).select(F.lit(i).alias("position"), F.lit(name).alias("stage"), "n_rows", "null_cells")
        out = row if out is None else out.unionByName(row)
    return out
