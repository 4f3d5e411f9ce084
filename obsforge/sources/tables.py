"""Readers and writers: CSV histories, snapshots, idempotent appends, records, split data, metrics documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from pathlib import PurePosixPath
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsforge.functions.columns import no_nan
from obsforge.operators.feed import read_or_none
from obsforge.schema import NULL_TOKENS, RAW, RECORD_DEFAULTS
from obsforge.session import unsorted_folders
from obsforge.sources.headers import MALFORMED, read_lines, read_whole_files, resolved

# Quotes inside a quoted cell are doubled.
CSV = {"header": True, "escape": '"'}



def read_history(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW,
    null_tokens: Sequence[str] = NULL_TOKENS,
    strict: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """CSV files with a header line -> typed columns. Each file is read by its own header, in any order of columns, with or without
    quotes. A missing file is an error, and so is a header with other names than the schema's; the error names the file.

    Cells in `null_tokens` are null. A line with too many or too few cells, an open quote, or a cell that does not fit its type
    fails the job. With `strict=False` such lines are left out, except that a cell that does not fit is null; `read_rejects`
    returns all of them. Cells with line breaks need `multi_line`, which reads each file in one task.
    """
    texts = _lines(spark, path, schema, multi_line)
    names = [f.name for f in schema.fields]
    if strict:
        fail = F.raise_error(F.concat(F.lit("malformed line: "), F.col(MALFORMED)))
        texts = texts.withColumns({n: F.when(F.col(MALFORMED).isNull(), F.col(n)).otherwise(fail.cast("string")) for n in names})
    else:
        texts = texts.where(F.col(MALFORMED).isNull())
    return typed(texts.drop(MALFORMED), schema, null_tokens, strict)


def read_rejects(
    spark: SparkSession, path: str, schema: T.StructType = RAW, null_tokens: Sequence[str] = NULL_TOKENS, multi_line: bool = False
) -> DataFrame:
    """(line, reason): lines whose cells do not match the header (`cells`) or do not fit the types (`type`), with their text."""
    texts = _lines(spark, path, schema, multi_line)
    names = [f.name for f in schema.fields]
    named = typed(texts, schema, null_tokens, False).columns
    kept = F.when(F.col(MALFORMED).isNull(), F.struct(*[F.col(n) for n in names]))
    misfits = F.lit(False)
    for f in schema.fields:
        if f.name in named and not isinstance(f.dataType, T.StringType):
            cell = F.when(~F.col(f.name).isin(*null_tokens), F.col(f.name))
            misfits = misfits | (cell.isNotNull() & cell.try_cast(f.dataType).isNull())
    marked = texts.select(
        F.coalesce(F.col(MALFORMED), F.to_csv(kept, {"escape": '"'})).alias("line"),
        F.when(F.col(MALFORMED).isNotNull(), "cells").when(misfits, "type").alias("reason"),
    )
    return marked.where(F.col("reason").isNotNull())


def _lines(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool) -> DataFrame:
    """Text cells by name, and the whole line where it is malformed."""
    names = [f.name for f in schema.fields]
    if multi_line:
        return read_whole_files(spark, path, names, {**CSV, "enforceSchema": False})
    return resolved(read_lines(spark, path), names)


def text_shape(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, MALFORMED]])


def parsed(lines: DataFrame, shape: T.StructType, header: str) -> DataFrame:
    """Lines of text (`value`) -> text cells, without header and empty lines; an odd number of quotes leaves a cell open."""
    line = F.col("__text")
    ddl = ", ".join(f"`{n}` string" for n in shape.names)
    cells = F.from_csv(line, ddl, {"escape": '"', "columnNameOfCorruptRecord": MALFORMED})
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    rows = lines.select(F.col("value").alias("__text")).where((line != header) & (F.trim(line) != ""))
    rows = rows.select(cells.alias("__cells"), F.when(quotes % 2 == 1, line).alias("__open"))
    return rows.select(*[F.col("__cells")[n].alias(n) for n in shape.names if n != MALFORMED], F.coalesce("__open", F.col("__cells")[MALFORMED]).alias(MALFORMED))


def typed(texts: DataFrame, schema: T.StructType, null_tokens: Sequence[str] = NULL_TOKENS, strict: bool = True) -> DataFrame:
    """Text columns -> the types of the schema, in its order."""
    out = []
    for f in schema.fields:
        cell = F.when(~F.col(f.name).isin(*null_tokens), F.col(f.name))
        if not isinstance(f.dataType, T.StringType):
            cell = cell.cast(f.dataType) if strict else cell.try_cast(f.dataType)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cell = no_nan(cell)
        out.append(cell.alias(f.name))
    return texts.select(*out)


def read_inferred(spark: SparkSession, path: str, null_token: str = "NA") -> DataFrame:
    """Types inferred from the data, at the cost of a second scan; a fixed schema is the default elsewhere."""
    return spark.read.options(**CSV, inferSchema=True, nullValue=null_token).csv(path)


def cleaned_name(source: str) -> str:
    return f"{PurePosixPath(source).stem}_cleaned"


def write_snapshot(df: DataFrame, path: str, form: str = "parquet", partition_by: Sequence[str] = ()) -> str:
    """Replace the table at `path`. CSV snapshots carry a header and write nulls as empty cells."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if form == "csv":
        writer.options(**CSV).csv(path)
    else:
        writer.parquet(path)
    return path


def append_new(df: DataFrame, path: str, keys: Sequence[str], batch_id: int) -> DataFrame:
    """Append rows whose keys are not in the table yet, as one batch; repeating a batch rewrites only that batch.

    The target is created where absent.
    """
    spark = df.sparkSession
    stored = read_or_none(spark, path)
    fresh = df
    if stored is not None:
        fresh = without_stored(df, stored.where(F.col("batch_id") != batch_id), keys)
    fresh.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return spark.read.parquet(path)


def without_stored(df: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `df` whose keys `stored` does not hold. Only the stretch of the stored table that the leading key of `df`
    spans is read, so the cost follows the batch and not the history."""
    span = df.agg(F.min(keys[0]).alias("low"), F.max(keys[0]).alias("high")).first()
    near = stored
    if span["low"] is not None:
        near = stored.where(F.col(keys[0]).between(F.lit(span["low"]), F.lit(span["high"])) | F.col(keys[0]).isNull())
    used = near.select(*[F.col(k).alias(f"__{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return df.join(used, same, "left_anti").select(*df.columns)


def with_defaults(df: DataFrame, defaults: Mapping[str, Any] = RECORD_DEFAULTS) -> DataFrame:
    absent = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def from_records(
    spark: SparkSession, records: Sequence[Mapping[str, Any]], schema: T.StructType | str, defaults: Mapping[str, Any] = RECORD_DEFAULTS
) -> DataFrame:
    """Records given by hand (a request holds one); bulk input comes as a table."""
    return with_defaults(spark.createDataFrame([dict(r) for r in records], schema), defaults)


def write_split(df: DataFrame, path: str) -> str:
    """Training and test rows in one table; a reader of one split touches only its folder."""
    with unsorted_folders(df.sparkSession):
        df.write.mode("overwrite").partitionBy("split").parquet(path)
    return path


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("split") == split).drop("split")


def metrics_document(train: DataFrame, test: DataFrame, importances: DataFrame) -> DataFrame:
    """One nested row: train {accuracy, f1}, test {accuracy, precision, recall, f1, roc_auc}, top_features {name: share}."""
    right = test.select(F.struct("accuracy", "precision", "recall", "f1", "roc_auc"))
    pairs = F.sort_array(F.collect_list(F.struct(F.col("position"), F.col("feature"), F.col("importance"))))
    top = importances.agg(F.map_from_entries(F.transform(pairs, lambda p: F.struct(p["feature"], p["importance"]))))
    return train.select(
        F.struct("accuracy", "f1").alias("train"), right.scalar().alias("test"), top.scalar().alias("top_features")
    )


def write_metrics(document: DataFrame, path: str, run_id: str, step: str) -> str:
    """Append-only by (run, step): a later step never overwrites an earlier one, a repeat replaces only itself."""
    target = f"{path}/run_id={run_id}/step={step}"
    document.write.mode("overwrite").json(target)
    return target


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)
