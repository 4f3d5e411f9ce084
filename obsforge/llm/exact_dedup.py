"""Exact duplicates by a cuckoo-filter index of text digests.

Digests live in hash buckets. Each bucket has a cuckoo filter (short fingerprints, two possible slots groups for each) over a
store of full digests. A miss in the filter proves a digest new; a hit is verified against the stored digests; a filter that
overflows is rebuilt at twice the size from the stored keys; removing a digest deletes its fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsforge.llm.common import GAP_CHARACTERS, attach, forget_kept, identified, release
from obsforge.session import written

# Digests that a bucket is expected to hold, and that one scan task collapses before it hands them on.
BUCKET_DIGESTS = 50_000
# A digest shared by at least this part of all rows is joined by broadcast: there are at most 1 / HOT_SHARE such digests.
HOT_SHARE = 0.001


class CuckooIndex:
    """Cuckoo filter over the digests of a store; `store` maps each live digest to its value."""

    SLOTS = 4
    MAX_KICKS = 200

    def __init__(self, capacity: int = 1024, bits: int = 16):
        self.store: dict[bytes, tuple] = {}
        self.mask = (1 << bits) - 1
        self._clear(capacity)

    def _clear(self, capacity: int) -> None:
        groups = 1
        while groups * self.SLOTS * 0.9 < capacity:
            groups *= 2
        self.groups = groups
        self.table = [0] * (groups * self.SLOTS)

    def _print_of(self, digest: bytes) -> tuple[int, int]:
        """Fingerprint (never 0, which marks a free slot) and first group; both from separate bytes of the digest."""
        return (int.from_bytes(digest[8:16], "little") & self.mask) or 1, int.from_bytes(digest[16:24], "little") % self.groups

    def _other(self, group: int, mark: int) -> int:
        return group ^ ((mark * 0x5BD1E995) % self.groups)

    def _place(self, mark: int, group: int) -> bool:
        table, slots = self.table, self.SLOTS
        for g in (group, self._other(group, mark)):
            for at in range(g * slots, g * slots + slots):
                if not table[at]:
                    table[at] = mark
                    return True
        for kick in range(self.MAX_KICKS):
            at = group * slots + kick % slots
            mark, table[at] = table[at], mark
            group = self._other(group, mark)
            for at in range(group * slots, group * slots + slots):
                if not table[at]:
                    table[at] = mark
                    return True
        return False

    def _resize(self) -> None:
        capacity = self.groups * self.SLOTS * 2
        while True:
            self._clear(capacity)
            if all(self._place(*self._print_of(digest)) for digest in self.store):
                return
            capacity *= 2

    def may_contain(self, digest: bytes) -> bool:
        mark, group = self._print_of(digest)
        slots, other = self.SLOTS, self._other(group, mark)
        return mark in self.table[group * slots : (group + 1) * slots] or mark in self.table[other * slots : (other + 1) * slots]

    def get(self, digest: bytes) -> tuple | None:
        """The stored value; a filter hit counts only if the full digest is in the store."""
        return self.store.get(digest) if self.may_contain(digest) else None

    def insert(self, digest: bytes, value: tuple) -> None:
        """Adds a digest or replaces the value of a live one."""
        known = self.get(digest) is not None
        self.store[digest] = value
        if not known and not self._place(*self._print_of(digest)):
            self._resize()

    def delete(self, digest: bytes) -> bool:
        """Removes a live digest; False if it was not live."""
        if self.get(digest) is None:
            return False
        del self.store[digest]
        mark, group = self._print_of(digest)
        for g in (group, self._other(group, mark)):
            for at in range(g * self.SLOTS, (g + 1) * self.SLOTS):
                if self.table[at] == mark:
                    self.table[at] = 0
                    return True
        return True


_ENTRY = "digest binary, points long, keep_id long, copies long"


def _better(a: tuple, b: tuple) -> tuple:
    """Of two (points, doc_id, copies): more code points first, then the smaller id (a null id last); copies add up."""
    keep = a if (a[0], a[1] is not None, -(a[1] or 0)) >= (b[0], b[1] is not None, -(b[1] or 0)) else b
    return keep[0], keep[1], a[2] + b[2]


def _entries(index: CuckooIndex) -> pa.RecordBatch:
    values = list(index.store.values())
    columns = [list(index.store), [v[0] for v in values], [v[1] for v in values], [v[2] for v in values]]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int64(), pa.int64()))], ["digest", "points", "keep_id", "copies"])


def _collapsed(limit: int):
    """Merges equal digests of the rows a task reads; at most `limit` live digests are held, then they are handed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        index = CuckooIndex(limit)
        for batch in batches:
            for digest, *value in zip(*(batch.column(i).to_pylist() for i in range(4))):
                known = index.get(digest)
                index.insert(digest, tuple(value) if known is None else _better(known, tuple(value)))
                if len(index.store) >= limit:
                    yield _entries(index)
                    index = CuckooIndex(limit)
        if index.store:
            yield _entries(index)
        del index
        release()

    return run


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    """One bucket: the entries of all tasks merged into one index."""
    index = CuckooIndex(max(1024, len(rows)))
    ids = [None if pd.isna(i) else int(i) for i in rows["keep_id"]]
    for digest, points, doc_id, copies in zip(rows["digest"], rows["points"], ids, rows["copies"]):
        digest, value = bytes(digest), (int(points), doc_id, int(copies))
        known = index.get(digest)
        index.insert(digest, value if known is None else _better(known, value))
    return _entries(index).to_pandas()


def normalised(text: Column) -> Column:
    """The text without any character of [\\x20\\x09-\\x0D]; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), GAP_CHARACTERS, "")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest (SHA-256 of the normalised text), points (code points of the original text)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return identified(docs, "text").select("doc_id", F.unhex(F.sha2(normalised(text), 256)).alias("digest"), F.length(text).cast("long").alias("points"))


def build_index(marked: DataFrame, bucket_digests: int = BUCKET_DIGESTS) -> DataFrame:
    """(digest, points, keep_id, copies): one row per live digest of `digests(docs)`; copies are merged before the shuffle."""
    entries = marked.select("digest", "points", F.col("doc_id").cast("long").alias("keep_id"), F.lit(1).cast("long").alias("copies"))
    collapsed = entries.mapInArrow(_collapsed(bucket_digests), _ENTRY)
    buckets = max(1, -(-marked.count() // bucket_digests) * 4)
    bucket = F.pmod(F.xxhash64("digest"), F.lit(buckets)).alias("bucket")
    return collapsed.select(bucket, "*").groupBy("bucket").applyInPandas(_merged, _ENTRY)


def remove(index: DataFrame, marked: DataFrame, bucket_digests: int = BUCKET_DIGESTS) -> DataFrame:
    """The index without the digests of `marked` (doc_id, digest, points); unknown digests change nothing.

    Both sides are dealt into the same buckets; each bucket's filter is rebuilt from its keys and the digests are deleted.
    """
    buckets = max(1, -(-index.count() // bucket_digests) * 4)
    bucket = F.pmod(F.xxhash64("digest"), F.lit(buckets)).alias("bucket")
    gone = marked.groupBy("digest").agg(F.count(F.lit(1)).alias("n"))

    def drop(live: pd.DataFrame, dead: pd.DataFrame) -> pd.DataFrame:
        held = _merged_index(live)
        for digest in dead["digest"]:
            held.delete(bytes(digest))
        return _entries(held).to_pandas()

    return index.select(bucket, "*").groupBy("bucket").cogroup(gone.select(bucket, "digest").groupBy("bucket")).applyInPandas(drop, _ENTRY)


def _merged_index(rows: pd.DataFrame) -> CuckooIndex:
    index = CuckooIndex(max(1024, len(rows)))
    for digest, points, doc_id, copies in zip(rows["digest"], rows["points"], rows["keep_id"], rows["copies"]):
        index.insert(bytes(digest), (int(points), None if pd.isna(doc_id) else int(doc_id), int(copies)))
    return index


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of `docs` (doc_id, text, any other columns).

    Texts are equal when identical without white space in ASCII; null text is empty. The row with most code points, then the
    smallest doc_id stays. Rows that repeat one doc_id and text count in group_size and share the decision of that doc_id.
    A row without doc_id keeps null and is kept only if every row of its group lacks one. An empty table gives no rows.
    """
    marked = written(digests(docs), "digests")
    index = written(build_index(marked), "digest-index")
    repeated = index.where("copies > 1").select("digest", "keep_id", "copies")
    least = max(2, int(marked.count() * HOT_SHARE))
    hot = repeated.where(F.col("copies") >= least).select("digest", F.col("keep_id").alias("hot_id"), F.col("copies").alias("hot_copies"))
    rest = repeated.where(F.col("copies") < least)
    # Hot digests are met by broadcast (a bounded number); the rows they cover get a key of their own in the shuffled join.
    rows = marked.join(F.broadcast(hot), "digest", "left")
    rows = rows.withColumn("key", F.when(F.col("hot_copies").isNotNull(), F.unhex(F.lpad(F.hex("doc_id"), 16, "0"))).otherwise(F.col("digest")))
    rows = attach(rows, rest.withColumnRenamed("digest", "key"), ["key"], "left", F.lit(48))
    alone = F.coalesce("hot_copies", "copies").isNull()
    keep = F.when(F.col("hot_copies").isNotNull(), F.col("hot_id")).when(F.col("copies").isNotNull(), F.col("keep_id")).otherwise(F.col("doc_id"))
    return rows.select(
        "doc_id",
        keep.alias("keep_id"),
        F.when(alone, F.lit(1)).otherwise(F.coalesce("hot_copies", "copies")).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
