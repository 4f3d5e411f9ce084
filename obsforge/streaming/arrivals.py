"""Files that arrive in a folder become rows of a table, each key once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from obsforge.operators.feed import read_or_none
from obsforge.schema import KEYS, NULL_TOKENS, RAW
from obsforge.session import cut_lineage
from obsforge.sources.headers import FILE, MALFORMED, resolved, with_places
from obsforge.sources.tables import parsed, text_shape, typed, without_stored


def read_arrivals(
    spark: SparkSession,
    folder: str,
    schema: T.StructType = RAW,
    files_per_batch: int = 1,
    null_tokens: Sequence[str] = NULL_TOKENS,
) -> DataFrame:
    """Stream of typed rows from CSV files whose header is the schema's names in its order, at most `files_per_batch` new files at
    a time; `read_arriving_lines` takes files of any order.

    Every line is used or fails the stream: too many or too few cells, an open quote, or a cell that does not fit its type. So
    does a line that holds the schema's names in another order.
    """
    names = [f.name for f in schema.fields]
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    texts = parsed(lines, text_shape(names), ",".join(names))
    cells = F.array(*[F.coalesce(F.trim(F.col(n)), F.lit("")) for n in names])
    permuted = (F.array_sort(cells) == F.lit(sorted(names))) & (cells != F.lit(names))
    texts = texts.withColumn(MALFORMED, F.when(permuted, F.concat_ws(",", cells)).otherwise(F.col(MALFORMED))).where(cells != F.lit(names))
    fail = F.raise_error(F.concat(F.lit("malformed line: "), F.col(MALFORMED)))
    checked = texts.select(*[F.when(F.col(MALFORMED).isNull(), F.col(n)).otherwise(fail.cast("string")).alias(n) for n in names])
    return typed(checked, schema, null_tokens)


def read_arriving_lines(spark: SparkSession, folder: str, files_per_batch: int = 1) -> DataFrame:
    """Stream of the lines of CSV files with the file they come from; `run_stream` reads each file by its own header."""
    return with_places(spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder))


def _rows_by_header(lines: DataFrame, schema: T.StructType, null_tokens: Sequence[str]) -> DataFrame:
    names = [f.name for f in schema.fields]
    texts = resolved(lines, names)
    fail = F.raise_error(F.concat(F.lit("malformed line: "), F.col(MALFORMED)))
    checked = texts.select(*[F.when(F.col(MALFORMED).isNull(), F.col(n)).otherwise(fail.cast("string")).alias(n) for n in names])
    return typed(checked, schema, null_tokens)


def deduplicated(stream: DataFrame, event_time: str, keys: Sequence[str], delay: str) -> DataFrame:
    """Drop repeats of a key that arrive within `delay` of each other; state older than that is forgotten.

    That is also its loss: a row that arrives more than `delay` behind the newest one is dropped, new or not, and
    `dropped_late` counts those. Use `run_stream`, which looks into the target, where no row may be lost.
    """
    stream = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def dropped_late(query: StreamingQuery) -> int:
    """Rows the watermark has dropped so far, from the progress the query still remembers."""
    return sum(int(o.get("numRowsDroppedByWatermark", 0)) for p in query.recentProgress for o in p["stateOperators"])


def run_stream(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    keys: Sequence[str] = KEYS,
    on_batch: Callable[[DataFrame, int], None] | None = None,
    available_now: bool = True,
    interval: str = "1 minute",
    schema: T.StructType = RAW,
    null_tokens: Sequence[str] = NULL_TOKENS,
) -> StreamingQuery:
    """Append each micro-batch to `target` and hand the new rows to `on_batch` (for example a scorer).

    A stream of lines (`read_arriving_lines`) becomes rows of `schema` here, each file by its own header; a file whose names are
    others fails the stream with an error that names it, before anything of its batch is written.

    Exactly once: a batch writes only its own `batch_id` folder, so a replay after a failure overwrites it, and rows whose
    keys an earlier batch holds are left out. Order of arrival does not matter: of equal keys within a batch the first by
    content is kept.
    """

    def handle(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        if FILE in rows.columns:
            rows = _rows_by_header(rows, schema, null_tokens)
        names = rows.columns
        position = F.struct(*[F.col(c) for c in names])
        unique = cut_lineage(rows.groupBy(*keys).agg(F.min(position).alias("__row")).select("__row.*"))
        stored = read_or_none(spark, target)
        if stored is not None:
            unique = without_stored(unique, stored.where(F.col("batch_id") < batch_id), keys)
        folder = f"{target}/batch_id={batch_id}"
        unique.write.mode("overwrite").parquet(folder)
        if on_batch is not None:
            on_batch(spark.read.schema(rows.schema).parquet(folder), batch_id)

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def arrivals_table(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target)
