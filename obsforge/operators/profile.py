"""Profiling: shape, distinct values, missing cells, class shares, correlation, collinearity, quantile summary."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsforge.functions.columns import is_text, no_nan, numeric_columns
from obsforge.plans.ranks import exact_quantiles


def _long(wide: DataFrame, rows: Sequence[dict[str, Column]]) -> DataFrame:
    """One output row per entry from a one-row aggregate."""
    packed = F.array(*[F.struct(*[c.alias(name) for name, c in row.items()]) for row in rows])
    return wide.select(F.inline(packed))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).select("n_rows", F.lit(len(df.columns)).cast("long").alias("n_columns"))


def column_kinds(df: DataFrame) -> DataFrame:
    """Position, name and kind (categorical for text, else continuous) of every column; schema only, no scan."""
    rows = [
        (i, f.name, "categorical" if is_text(f.dataType) else "continuous") for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(rows, "position int, column string, kind string")


def split_by_kind(df: DataFrame) -> tuple[list[str], list[str]]:
    categorical = [f.name for f in df.schema.fields if is_text(f.dataType)]
    return categorical, [c for c in df.columns if c not in categorical]


def distinct_counts(df: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct values per column; null counts as one value.

    The exact form is expanded by Catalyst to (column, value) pairs that are de-duplicated across the cluster; `approx`
    replaces it by one sketch per column in a single scan.
    """
    counter = F.approx_count_distinct if approx else F.count_distinct
    wide = df.agg(
        *[counter(F.col(c)).alias(f"d{i}") for i, c in enumerate(df.columns)],
        *[F.max(F.col(c).isNull().cast("long")).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    rows = [
        {"column": F.lit(c), "n_distinct": F.col(f"d{i}") + F.coalesce(F.col(f"n{i}"), F.lit(0))}
        for i, c in enumerate(df.columns)
    ]
    return _long(wide, rows)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def missing_profile(df: DataFrame) -> DataFrame:
    """Per column: missing cells, their share of the rows in percent, and the type."""
    wide = df.agg(
        F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)]
    )
    rows = [
        {
            "column": F.lit(f.name),
            "missing": F.col(f"m{i}"),
            "percent": F.try_divide(F.col(f"m{i}") * 100.0, F.col("n").cast("double")),
            "dtype": F.lit(f.dataType.simpleString()),
        }
        for i, f in enumerate(df.schema.fields)
    ]
    return _long(wide, rows)


def null_patterns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Which columns are null together: a 0/1 text per row pattern and its number of rows."""
    bits = [F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns or df.columns]
    return df.groupBy(F.concat(*bits).alias("pattern")).agg(F.count("*").alias("n"))


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows and share per class, nulls left out."""
    counted = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.select(label, "n", (F.col("n") / total).alias("share"))


def _gram(columns: int):
    """Moments (i, j, n, sx, sy, sxx, syy, sxy) of all pairs i < j over the rows of a task where both are known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, columns, columns))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns], axis=1)
            known = ~np.isnan(x)
            x, k = np.where(known, x, 0.0), known.astype(np.float64)
            total += np.stack([k.T @ k, x.T @ k, k.T @ x, (x * x).T @ k, k.T @ (x * x), x.T @ x])
        i, j = np.triu_indices(columns, 1)
        arrays = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), *(pa.array(t[i, j]) for t in total)]
        yield pa.RecordBatch.from_arrays(arrays, ["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"])

    return run


def pair_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(i, j, corr) of every pair of columns, pairwise complete: one matrix product per batch, summed across the cluster.

    Values are shifted by their column's mean, or by its only value, before they are squared. The plan has the same size for two
    columns and for thousands. corr is null where a column is constant over the rows of the pair.
    """
    clean = df.select(*[no_nan(F.col(c).cast("double")).alias(f"c{i}") for i, c in enumerate(columns)])
    known = clean.agg(*[F.struct(F.min(c).alias("low"), F.max(c).alias("high"), F.avg(c).alias("mean")).alias(c) for c in clean.columns]).first()
    shift = {c: (known[c]["low"] if known[c]["low"] == known[c]["high"] else known[c]["mean"]) or 0.0 for c in clean.columns}
    shifted = clean.select(*[(F.col(c) - shift[c]).alias(c) for c in clean.columns])
    parts = shifted.mapInArrow(_gram(len(columns)), "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double")
    whole = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])

    def spread(squares: str, sums: str) -> Column:
        left = F.col(squares) - F.try_divide(F.col(sums) * F.col(sums), F.col("n"))
        return F.when(left > 1e-13 * F.col(squares), left)

    together = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), F.col("n"))
    return whole.select("i", "j", (together / F.sqrt(spread("sxx", "sx") * spread("syy", "sy"))).alias("corr"))


def correlation(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair below the diagonal, pairwise complete."""
    columns = list(columns or numeric_columns(df))
    names = F.array(*[F.lit(c) for c in columns]) if columns else F.array().cast("array<string>")
    if len(columns) < 2:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, corr double")
    return pair_moments(df, columns).select(F.get(names, F.col("j")).alias("column_a"), F.get(names, F.col("i")).alias("column_b"), "corr")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Correlation matrix over the rows complete in all columns; only one number per pair reaches the driver."""
    columns = list(columns)
    matrix = np.eye(len(columns))
    if len(columns) < 2:
        return matrix
    complete = df.select(*[no_nan(F.col(c).cast("double")).alias(c) for c in columns]).na.drop()
    for r in pair_moments(complete, columns).toLocalIterator():
        matrix[r["i"], r["j"]] = matrix[r["j"], r["i"]] = math.nan if r["corr"] is None else r["corr"]
    return matrix


def _inflation(matrix: np.ndarray) -> list[float]:
    """Diagonal of the inverse; infinite for a column that the others determine, null-like for a constant one."""
    usable = [i for i in range(len(matrix)) if not np.isnan(np.delete(matrix[i], i)).all() or len(matrix) == 1]
    out = [math.nan] * len(matrix)
    for i in usable:
        others = [j for j in usable if j != i]
        if not others:
            out[i] = 1.0
            continue
        coefficients, *_ = np.linalg.lstsq(matrix[np.ix_(others, others)], matrix[others, i], rcond=1e-12)
        unexplained = 1.0 - float(matrix[others, i] @ coefficients)
        out[i] = math.inf if unexplained < 1e-10 else 1.0 / unexplained
    return out


def vif(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Variance inflation factor of each column against all others with an intercept."""
    values = _inflation(correlation_matrix(df, columns))
    rows = [(c, None if math.isnan(v) else v) for c, v in zip(columns, values)]
    return df.sparkSession.createDataFrame(rows, "feature string, vif double")


def vif_eliminate(df: DataFrame, columns: Sequence[str], limit: float = 10.0) -> DataFrame:
    """Drop the column with the highest factor until all are at most `limit`; one scan in total.

    Output: one row per column with its step of removal (null when kept) and the factor at that step.
    """
    remaining, matrix, rows, step = list(columns), correlation_matrix(df, columns), [], 0
    while True:
        values = _inflation(matrix)
        ranked = [(-math.inf if math.isnan(v) else v, -i) for i, v in enumerate(values)]
        if not ranked or max(ranked)[0] <= limit:
            break
        step += 1
        worst = -max(ranked)[1]
        rows.append((remaining.pop(worst), step, float(values[worst])))
        matrix = np.delete(np.delete(matrix, worst, 0), worst, 1)
    rows += [(c, None, None if math.isnan(v) else float(v)) for c, v in zip(remaining, values)]
    return df.sparkSession.createDataFrame(rows, "feature string, dropped_at int, vif double")


# Letter values of a boxen plot: median, fourths, eighths, sixteenths.
LETTER_PROBS = [0.0625, 0.125, 0.25, 0.5, 0.75, 0.875, 0.9375]


def quantile_summary(df: DataFrame, columns: Sequence[str], probs: Sequence[float] = LETTER_PROBS) -> DataFrame:
    found = exact_quantiles(df, columns, probs)
    rows = [(c, float(p), found[(c, p)]) for c in columns for p in probs]
    return df.sparkSession.createDataFrame(rows, "column string, prob double, value double")
