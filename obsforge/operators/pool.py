"""A pool of rows kept in stretches of its leading key, with a counter and a digest for each stretch.

Every append to the pool and every batch taken from it records how many rows it holds per stretch, and the sum of their
digests. The record is written last; without it an append or a batch does not count. Which stretches hold rows that were not
taken yet is then known from these small tables: a batch reads the stretches whose counters differ, in their order, until it
has its rows. What was consumed before, and what lies behind, is not read, and a row that comes late reopens its stretch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsforge.functions.columns import row_fingerprint
from obsforge.operators import feed
from obsforge.plans.ordered import running_before
from obsforge.session import unsorted_folders

STRETCH, APPEND, BATCH = "stretch", "append_id", feed.BATCH
# Nulls come first in the order of a key, and NaN last.
NULLS, NANS = -(1 << 63), (1 << 63) - 1
MICROS_PER_DAY = 86_400_000_000
TEXT_BYTES = 7


def stretch_of(df: DataFrame, key: str, width: float) -> Column:
    """The number of the stretch a row lies in; it never falls as the key grows.

    `width` counts days of a date or timestamp, units of a number, and leading bytes (up to 7) of a text.
    """
    dtype, column = df.schema[key].dataType, F.col(f"`{key}`")
    if isinstance(dtype, T.DateType):
        number = F.floor(F.unix_date(column) / width)
    elif isinstance(dtype, T.TimestampType):
        number = F.floor(F.unix_micros(column) / int(width * MICROS_PER_DAY))
    elif isinstance(dtype, T.TimestampNTZType):
        number = F.floor(F.unix_micros(F.convert_timezone(F.lit("UTC"), F.lit("UTC"), column).cast("timestamp")) / int(width * MICROS_PER_DAY))
    elif isinstance(dtype, T.NumericType):
        number = F.floor(column.cast("double") / width)
        if isinstance(dtype, (T.DoubleType, T.FloatType)):
            number = F.when(F.isnan(column), F.lit(NANS)).otherwise(number)
    elif isinstance(dtype, T.StringType):
        head = F.hex(F.substring(column.cast("binary"), 1, min(int(width), TEXT_BYTES)))
        number = F.conv(F.rpad(head, 2 * TEXT_BYTES, "0"), 16, 10)
    else:
        raise ValueError(f"no stretches over {dtype.simpleString()}")
    return F.coalesce(number.cast("long"), F.lit(NULLS))


def counters(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(stretch, n, h0, h1): rows of each stretch and the sums of the halves of their digests; the order of rows does not matter."""
    digest = df.select(STRETCH, row_fingerprint(list(columns)).alias("__digest"))
    halves = feed.digest_sums(F.col("__digest"))
    return digest.groupBy(STRETCH).agg(F.count("*").alias("n"), *[h.alias(f"h{i}") for i, h in enumerate(halves)])


def _with_stretch(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(STRETCH, T.LongType())])


def _summed(records: DataFrame) -> DataFrame:
    return records.groupBy(STRETCH).agg(*[F.sum(c).alias(c) for c in ("n", "h0", "h1")])


class Pool:
    """Rows below `path`, in stretches of the first of `keys`."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], width: float = 1):
        self.spark, self.path, self.keys, self.width = spark, path.rstrip("/"), list(keys), width
        self._schema: T.StructType | None = None

    def records(self) -> DataFrame | None:
        """(append_id, stretch, n, h0, h1) of all appends that count."""
        return feed.read_or_none(self.spark, f"{self.path}/counters")

    def append(self, rows: DataFrame, append_id: int) -> None:
        """Add rows once; a repeated append id changes nothing. The rows of a hot stretch are written by several tasks."""
        known = self.records()
        if known is not None and not known.where(F.col(APPEND) == append_id).isEmpty():
            return
        if known is not None and known.select(STRETCH).first() is not None:
            rows = rows.select(*[f"`{n}`" for n in self.schema().names])
        target = f"{self.path}/rows/{APPEND}={append_id}"
        placed = rows.withColumn(STRETCH, stretch_of(rows, self.keys[0], self.width)).withColumn("__spread", F.xxhash64(*[F.col(f"`{n}`") for n in rows.columns]))
        dealt = placed.repartitionByRange(STRETCH, *[F.col(f"`{k}`") for k in self.keys], "__spread").drop("__spread")
        with unsorted_folders(self.spark):
            dealt.write.mode("overwrite").partitionBy(STRETCH).parquet(target)
        stored = self.spark.read.schema(_with_stretch(rows.schema)).parquet(target)
        counters(stored, rows.columns).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/counters/{APPEND}={append_id}")

    def schema(self) -> T.StructType:
        """That of the first rows; every append must have the same columns."""
        if self._schema is None:
            records = self.records()
            first = None if records is None else records.select(APPEND, STRETCH).first()
            if first is None:
                raise ValueError("the pool is empty")
            self._schema = self.spark.read.parquet(f"{self.path}/rows/{APPEND}={first[APPEND]}/{STRETCH}={first[STRETCH]}").schema
        return self._schema

    def rows(self, stretches: Sequence[int] | None = None) -> DataFrame:
        """All rows that count, or those of some stretches; only their folders are read."""
        return _folders(self, self.records(), f"{self.path}/rows", APPEND, stretches, self.schema())

    def progress(self, state: str) -> DataFrame:
        """(stretch, n_pool, n_consumed, open): open where the pool's counter and digest differ from those of the batches."""
        commits = feed.read_or_none(self.spark, f"{state}/commits")
        pool = _summed(self.records())
        if commits is None:
            return pool.select(STRETCH, F.col("n").alias("n_pool"), F.lit(0).cast("long").alias("n_consumed"), F.lit(True).alias("open"))
        used = _summed(commits).select(F.col(STRETCH).alias("__at"), *[F.col(c).alias(f"u_{c}") for c in ("n", "h0", "h1")])
        both = pool.join(used, F.col(STRETCH) == F.col("__at"), "left")
        same = F.lit(True)
        for c in ("n", "h0", "h1"):
            same = same & F.col(c).eqNullSafe(F.col(f"u_{c}"))
        return both.select(STRETCH, F.col("n").alias("n_pool"), F.coalesce("u_n", F.lit(0)).alias("n_consumed"), (~same).alias("open"))

    def wanted(self, state: str, n: int) -> list[tuple[int, bool]]:
        """The stretches, in order, that surely hold the next `n` rows, and whether any row of each was taken before.

        A stretch counts with the rows by which the pool exceeds the batches; one that differs without exceeding is read as well.
        """
        ahead = self.progress(state).where("open").withColumn("__more", F.greatest(F.col("n_pool") - F.col("n_consumed"), F.lit(0)))
        placed = running_before(ahead, [STRETCH], {"__before": F.col("__more")})
        rows = placed.where(F.col("__before") < n).select(STRETCH, (F.col("n_consumed") > 0).alias("touched")).collect()
        return sorted((r[STRETCH], r["touched"]) for r in rows)

    def pending(self, state: str, n: int) -> DataFrame | None:
        """Rows not taken yet that surely include the next `n`, or None if every counter agrees."""
        wanted = self.wanted(state, n)
        if not wanted:
            return None
        schema = self.schema()
        fresh, touched = [s for s, t in wanted if not t], [s for s, t in wanted if t]
        parts = [self.rows(fresh).select(*schema.names)] if fresh else []
        if touched:
            commits = feed.read_or_none(self.spark, f"{state}/commits")
            used = _folders(self, commits, f"{state}/rows", BATCH, touched, schema)
            parts.append(feed.pending(self.rows(touched).select(*schema.names), used.select(*schema.names), self.keys))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _folders(pool: Pool, records: DataFrame, root: str, kind: str, stretches: Sequence[int] | None, schema: T.StructType) -> DataFrame:
    """The rows below the folders of the records, and of some stretches only."""
    held = records if stretches is None else records.where(F.col(STRETCH).isin(*stretches))
    paths = sorted(f"{root}/{kind}={r[kind]}/{STRETCH}={r[STRETCH]}" for r in held.select(kind, STRETCH).distinct().collect())
    shape = _with_stretch(schema)
    return pool.spark.read.schema(shape).option("basePath", root).parquet(*paths).select(*shape.names)


def consume(pool: Pool, state: str, batch_id: int, n: int = 1, whole_keys: bool = False) -> DataFrame:
    """Take exactly the next `n` rows (fewer at the end) by keys, then content, as `batch_id`; nulls first, late rows in their place.

    Repeating a batch id changes nothing. The rows are written first, the counters last. With `whole_keys`, all rows that share the
    last key come along. An empty pool is an error. The state can be read by `feed.committed`.
    """
    spark, target = pool.spark, f"{state}/rows/{BATCH}={batch_id}"
    names = pool.schema().names
    commits = feed.read_or_none(spark, f"{state}/commits")
    if commits is None or commits.where(F.col(BATCH) == batch_id).isEmpty():
        waiting = pool.pending(state, n)
        batch = None if waiting is None else feed._first_rows(waiting, pool.keys, n, whole_keys)
        if batch is None or batch.isEmpty():
            raise ValueError("the pool is empty")
        placed = batch.withColumn(STRETCH, stretch_of(batch, pool.keys[0], pool.width))
        placed.write.mode("overwrite").partitionBy(STRETCH).parquet(target)
        record = counters(spark.read.schema(_with_stretch(pool.schema())).parquet(target), names)
        record.coalesce(1).write.mode("overwrite").parquet(f"{state}/commits/{BATCH}={batch_id}")
    return spark.read.schema(pool.schema()).parquet(target).select(*names)
