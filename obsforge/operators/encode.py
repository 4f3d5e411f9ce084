"""Label codes, standardisation and vector assembly, each with state kept as a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from obsforge.functions.columns import no_nan
from obsforge.operators.clean import value_counts
from obsforge.operators.profile import _long
from obsforge.plans.ordered import running_before

BROADCAST_CODES = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
HOT_PARTS = 1000  # a value with more than one in so many rows is hot; there are fewer such values than this
SPREAD = 1 << 16


def codes_of(values: DataFrame, rows: int, rows_per_bucket: int | None = None) -> DataFrame:
    """(column, value) pairs -> (column, value, code): position of the value among the sorted values of its column."""
    pairs = values.where(F.col("value").isNotNull()).select("column", "value")
    ranked = running_before(
        pairs, ["value"], sums={"code": F.lit(1)}, group=["column"], rows=rows, rows_per_bucket=rows_per_bucket
    )
    return ranked.select("column", "value", F.col("code").cast("long").alias("code"))


def distinct_estimate(df: DataFrame, columns: Sequence[str]) -> int:
    """Upper bound, within the sketch's error, on the number of (column, value) pairs."""
    row = df.agg(*[F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(columns)]).first()
    return int(sum(row) * 1.2) + len(columns)


def fit_codes(df: DataFrame, columns: Sequence[str], rows_per_bucket: int | None = None) -> DataFrame:
    return codes_of(value_counts(df, columns), distinct_estimate(df, columns), rows_per_bucket)


def _looked_up(df: DataFrame, key: Column, table: DataFrame, small: bool) -> DataFrame:
    """df with `__found`, the table's (`__key`, `__found`) entry for the key as text, or null; every row once.

    A small table is broadcast. Beyond that rows are shuffled by their key, but not all of one key to one task: hot keys are
    counted and looked up in a broadcast of fewer than HOT_PARTS rows, and those rows, like rows without a key, are dealt evenly.
    A hot key longer than BROADCAST_BYTES / HOT_PARTS bytes stays in the shuffle.
    """
    keyed = df.withColumn("__row_key", key.cast("string"))
    if small:
        return keyed.join(F.broadcast(table), F.col("__row_key") == F.col("__key"), "left").drop("__row_key", "__key")
    counts = keyed.groupBy("__row_key").agg(F.count("*").alias("n"))
    rows = keyed.count()
    hot = counts.where((F.col("n") * HOT_PARTS > rows) & (F.octet_length("__row_key") <= BROADCAST_BYTES // HOT_PARTS))
    found = hot.join(table, F.col("__row_key") == F.col("__key"), "left").select("__row_key", "__found").collect()
    kind = table.schema["__found"].dataType.simpleString()
    known = df.sparkSession.createDataFrame([tuple(r) for r in found], f"__hot string, __hot_found {kind}")
    marked = keyed.join(F.broadcast(known), F.col("__row_key") == F.col("__hot"), "left")
    aside = F.col("__hot").isNotNull() | F.col("__row_key").isNull()
    dealt = F.concat(F.lit("row "), F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).cast("string"))
    marked = marked.withColumn("__aside", aside).withColumn("__row_key", F.when(aside, dealt).otherwise(F.col("__row_key")))
    joined = marked.join(table.hint("merge"), F.col("__row_key") == F.col("__key"), "left")
    entry = F.when(F.col("__aside"), F.col("__hot_found")).otherwise(F.col("__found"))
    return joined.withColumn("__found", entry).drop("__row_key", "__key", "__hot", "__hot_found", "__aside")


def _small(size: Row | None, broadcast_rows: int) -> bool:
    return size is None or (size["n"] <= broadcast_rows and size["bytes"] <= BROADCAST_BYTES)


def _sizes(codes: DataFrame) -> dict[str, Row]:
    """Per column: entries, bytes and the largest code."""
    sizes = codes.groupBy("column").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("value") + 48).alias("bytes"), F.max("code").alias("top")
    )
    return {r["column"]: r for r in sizes.collect()}


def apply_codes(
    df: DataFrame, codes: DataFrame, columns: Sequence[str], unseen: str = "error", broadcast_rows: int = BROADCAST_CODES
) -> DataFrame:
    """Replace text by its code; nulls stay null.

    `unseen` values: "error" fails the job, "null" gives null, "keep" gives the next free code of the column. A column's
    code table is broadcast only after its row count and bytes were checked; a larger one is joined by a shuffle that hot
    values and nulls do not take part in by their key.
    """
    sizes, names, out = _sizes(codes), df.columns, df
    for c in columns:
        size = sizes.get(c)
        table = codes.where(F.col("column") == c).select(F.col("value").alias("__key"), F.col("code").alias("__found"))
        spare = F.lit(None).cast("long")
        if unseen == "keep":
            spare = F.lit(0 if size is None else size["top"] + 1).cast("long")
        elif unseen == "error":
            spare = F.raise_error(F.concat(F.lit(f"unseen value in {c}: "), F.col(c).cast("string"))).cast("long")
        elif unseen != "null":
            raise ValueError(f"unseen must be error, null or keep, not {unseen}")
        code = F.when(F.col("__found").isNotNull(), F.col("__found")).when(F.col(c).isNotNull(), spare)
        out = _looked_up(out, F.col(c), table, _small(size, broadcast_rows)).withColumn(c, code).drop("__found")
    return out.select(*names)


def decode(df: DataFrame, codes: DataFrame, columns: Sequence[str], broadcast_rows: int = BROADCAST_CODES) -> DataFrame:
    """Codes back to text; an unknown code gives null. Large code tables are joined as in `apply_codes`."""
    sizes, names, out = _sizes(codes), df.columns, df
    for c in columns:
        table = codes.where(F.col("column") == c).select(
            F.col("code").cast("string").alias("__key"), F.col("value").alias("__found")
        )
        whole = F.col(c).try_cast("long")
        key = F.when(whole == F.col(c), whole)
        found = _looked_up(out, key, table, _small(sizes.get(c), broadcast_rows))
        out = found.withColumn(c, F.col("__found")).drop("__found")
    return out.select(*names)


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mean, std): population deviation, nulls skipped, 1 in place of a zero deviation."""
    values = [no_nan(F.col(c).cast("double")) for c in columns]
    wide = df.agg(
        *[F.avg(v).alias(f"m{i}") for i, v in enumerate(values)],
        *[F.stddev_pop(v).alias(f"s{i}") for i, v in enumerate(values)],
    )
    rows = [
        {
            "column": F.lit(c),
            "mean": F.col(f"m{i}"),
            "std": F.when(F.col(f"s{i}") == 0.0, F.lit(1.0)).otherwise(F.col(f"s{i}")),
        }
        for i, c in enumerate(columns)
    ]
    return _long(wide, rows)


def apply_scaler(df: DataFrame, scaler: DataFrame) -> DataFrame:
    """Standardised columns; the state has one row per column and is applied as literals, a narrow projection."""
    state = {r["column"]: r for r in scaler.collect() if r["column"] in df.columns}
    return df.withColumns(
        {c: (F.col(c).cast("double") - F.lit(s["mean"])) / F.lit(s["std"]) for c, s in state.items() if s["mean"] is not None}
    )


def assemble(df: DataFrame, order: Sequence[str], output: str = "features") -> DataFrame:
    """Feature vector in the given order; a null left over fails the job."""
    return VectorAssembler(inputCols=list(order), outputCol=output, handleInvalid="error").transform(df)
