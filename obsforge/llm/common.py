"""Helpers shared by the text operators: reading tables, size-checked joins, UTF-8 columns as numpy arrays, word hashes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsforge.session import new_path, removed

# A side is broadcast only when it was counted and has at most so many rows and (summed) bytes; otherwise both sides are shuffled.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 32 << 20
# Bytes of text that one vectorised step holds; a longer document is a step of its own.
STEP_BYTES = 1 << 20

_GAP_BYTES = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]
GAP = np.zeros(256, dtype=bool)
GAP[_GAP_BYTES] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
GAP_CHARACTERS = "".join(map(chr, _GAP_BYTES))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def identified(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra columns of a table can never clash with an operator's own."""
    return docs.select(*[F.col(f"`{n}`") for n in ("doc_id", *names)])


def held_out(parts: int, part: int) -> Column:
    """Whether crc32 of doc_id as text leaves `part` modulo `parts`; a row without doc_id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == part, F.lit(False))


def small_enough(df: DataFrame, size: object | None = None) -> bool:
    """Whether a materialised table is within the bounds of a broadcast; `size` is an expression for the bytes of a row."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.lit(24) if size is None else size).alias("b")).first()
    return row["n"] <= BROADCAST_ROWS and (row["b"] or 0) <= BROADCAST_BYTES


def attach(left: DataFrame, right: DataFrame, on: list[str], how: str, size: object | None = None) -> DataFrame:
    """Join to a materialised right side: a broadcast if it is small enough, else a shuffle whose hot keys the engine splits."""
    side = right.select(*[F.col(c).alias(f"__{c}" if c in on else c) for c in right.columns])
    if small_enough(right, size):
        side = F.broadcast(side)
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in on]
    condition = same[0]
    for one in same[1:]:
        condition = condition & one
    return left.join(side, condition, how).drop(*[f"__{c}" for c in on])


class Intermediate:
    """Tables that an operator writes to the shared folder on its way and that go when its result is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self._paths = spark, []

    def __enter__(self) -> Intermediate:
        return self

    def __exit__(self, *error: object) -> None:
        for path in self._paths:
            removed(self.spark, path)

    def written(self, df: DataFrame, name: str) -> DataFrame:
        """A durable copy that stays until the block ends."""
        path = new_path(self.spark, name)
        self._paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def result(self, df: DataFrame, name: str) -> DataFrame:
        """A durable copy that outlives the block; it must not be read lazily from the block's tables."""
        path = new_path(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


# A bitmap over hashed ids of at most so many 64-bit words is broadcast whatever the number of ids (about 24 MB when full).
BITMAP_WORDS = 1 << 20


def possible(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """`docs` with __possible: false for rows whose doc_id is surely not in `ids`. The bitmap is bounded; if it fills up at very
    many ids, more rows are possible, and joins that follow only move more than they need."""

    word, bit = f"pmod(shiftrightunsigned(xxhash64(doc_id), 6), {BITMAP_WORDS}L)", "CAST(xxhash64(doc_id) & 63 AS INT)"
    bitmap = ids.groupBy(F.expr(word).alias("__word")).agg(F.expr(f"bit_or(shiftleft(1L, {bit}))").alias("__bits"))
    held = F.expr(f"shiftrightunsigned(coalesce(__bits, 0L), {bit}) & 1L = 1L")
    return docs.withColumn("__word", F.expr(word)).join(F.broadcast(bitmap), "__word", "left").withColumn("__possible", held).drop("__word", "__bits")


_HELD: dict[Any, Any] = {}


def kept_in_worker(key: Any, make: Callable[[], Any]) -> Any:
    """The one large object that a Python worker keeps from task to task; another key, of any operator, takes its place."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def forget_kept() -> None:
    """For operators that keep nothing: whatever another one left in this worker goes."""
    _HELD.clear()


def release() -> None:
    """Gives memory that a batch has freed back to the system, as workers live on and serve other stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values: every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BYTE_BASE = np.uint64(0xD6E8FEB86659FD93)


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset :]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def steps(data: np.ndarray, offsets: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive documents (from, to, bytes, offsets) of at most `limit` bytes together, or one longer document."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_starts(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = GAP) -> tuple[np.ndarray, np.ndarray]:
    """Byte position of every word, and the number of words before each document (one more entry than documents)."""
    between = gap[data]
    begins = ~between
    begins[1:] &= between[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[heads] = ~between[heads]
    starts = np.flatnonzero(begins)
    return starts, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for each word (separated by white space in ASCII), and the number of words before each document."""
    if lower:
        data = LOWER[data]
    starts, first = word_starts(data, offsets)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), first
    value = BYTE_VALUES[data]
    value[GAP[data]] = 0
    # Bytes before the first word are gaps; from there on each byte belongs to the last word that began.
    value = value[starts[0] :]
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(len(value)) - np.repeat(starts - starts[0], lengths)
    value *= powers(int(BYTE_BASE), int(lengths.max()))[place]
    return mixed(np.add.reduceat(value, starts - starts[0])), first
