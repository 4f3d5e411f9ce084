"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.VarcharType, T.CharType))


def is_number(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skipped = set(exclude)
    return [f.name for f in df.schema.fields if is_number(f.dataType) and f.name not in skipped]


def no_nan(column: Column) -> Column:
    """NaN becomes null, so aggregates skip it."""
    return F.nanvl(column, F.lit(None).cast("double"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def flag(column: Column, yes: str, no: str, passthrough: bool = False) -> Column:
    """1 for `yes`, 0 for `no`, null for the rest; `passthrough` also accepts numbers or text 0 and 1."""
    text = column.cast("string")
    mapped = F.when(text == yes, F.lit(1)).when(text == no, F.lit(0))
    if passthrough:
        number = text.try_cast("double")
        mapped = mapped.when(number == 1.0, F.lit(1)).when(number == 0.0, F.lit(0))
    return mapped


def seconds_between(later: Column, earlier: Column) -> Column:
    """Seconds with microseconds; free of time zone rules for timestamps with and without a zone."""
    gap = later - earlier
    parts = [(F.lit("DAY"), 86400), (F.lit("HOUR"), 3600), (F.lit("MINUTE"), 60), (F.lit("SECOND"), 1)]
    total = F.lit(0).cast("decimal(20,6)")
    for unit, length in parts:
        total = total + F.extract(unit, gap) * F.lit(length)
    return total.cast("double")


def label_text(column: Column) -> Column:
    return F.when(column == 1, F.lit("Yes")).otherwise(F.lit("No"))


def text_fingerprint(columns: Sequence[str], null_text: str = "NA", separator: str = "|") -> Column:
    """md5 over the text form of the columns, in the order given."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(null_text)) for c in columns]
    return F.md5(F.concat_ws(separator, *parts))


def row_fingerprint(columns: Sequence[str]) -> Column:
    """md5 over the JSON form with sorted names; nulls are kept so they count as content."""
    packed = F.struct(*[F.col(c) for c in sorted(columns)])
    return F.md5(F.to_json(packed, {"ignoreNullFields": "false"}))


def content_hash(seed: int, columns: Sequence[str]) -> Column:
    """Hex text in random order over whole rows; fast, and the places of nulls count as content."""
    gaps = F.concat(*[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns])
    return F.lpad(F.lower(F.hex(F.xxhash64(F.lit(seed), gaps, *[F.col(c) for c in columns]))), 16, "0")


def key_hash(seed: int, columns: Sequence[str]) -> Column:
    """Hex text whose order is a random permutation of the keys, the same on every run and engine."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in columns]))
