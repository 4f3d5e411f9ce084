"""Target-distribution importance resampling over hashed word features.

Features are runs of consecutive words; a feature's bucket is the crc32 of its bytes. The crcs are taken many at a time: distinct
features of equal length form a matrix of bytes, all their crcs are updated column by column, and the buckets are scattered back
to the places of the features. Documents are drawn without replacement by adding Gumbel noise to their weights.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsforge.llm.common import LOWER, Intermediate, identified, mixed, steps, utf8, word_starts
from obsforge.plans.ordered import running_before

LONGEST, BUCKETS, SEED, PERCENT, LEAST_WORDS = 1, 10_000, 2024, 10, 20
# Bytes of text in one vectorised step (a longer document is a step of its own), and of features in one matrix.
STEP, MATRIX = 4 << 20, 4 << 20
# Rows that are ranked in one task: at least the first number, then a share of all.
RANKED_ROWS, RANKED_PARTS = 20_000, 2000

_GAP = np.ones(256, dtype=bool)
_GAP[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def _crc_table() -> np.ndarray:
    """The change of a crc32 by each value of its lowest byte."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, np.uint32(0xEDB88320) ^ (value >> 1), value >> 1)
    return value.astype(np.uint32)


_CRC = _crc_table()


def crc_columns(rows: np.ndarray) -> np.ndarray:
    """crc32 of every row of a matrix of bytes, all rows at once, column by column."""
    crc = np.full(len(rows), 0xFFFFFFFF, dtype=np.uint32)
    for column in np.ascontiguousarray(rows.T):
        crc = _CRC[(crc ^ column) & 0xFF] ^ (crc >> 8)
    return crc ^ np.uint32(0xFFFFFFFF)


def distinct_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first of equal rows, and for every row the number of its first; exact for any bytes."""
    n, length = rows.shape
    padded = np.zeros((n, -(-length // 8) * 8), dtype=np.uint8)
    padded[:, :length] = rows
    parts = padded.view(np.uint64)
    key = parts[:, 0]
    for k in range(1, parts.shape[1]):
        key = mixed(key) + parts[:, k]
    _, first, of = np.unique(key, return_index=True, return_inverse=True)
    if parts.shape[1] > 1 and not np.array_equal(parts[first][of], parts):  # two features share a key
        return np.arange(n), np.arange(n)
    return first, of


def word_bytes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words in lower case with one space after each: bytes, starts, lengths, and the number of words before each document."""
    data = LOWER[data]
    begins, first = word_starts(data, offsets, _GAP)
    if not len(begins):
        return np.zeros(0, dtype=np.uint8), begins, begins, first
    inside = ~_GAP[data]
    lengths = np.add.reduceat(inside, begins, dtype=np.int64)
    starts = np.cumsum(lengths + 1) - lengths - 1
    out = np.full(int(lengths.sum()) + len(lengths), 0x20, dtype=np.uint8)
    out[np.arange(int(lengths.sum())) + np.repeat(np.arange(len(lengths)), lengths)] = data[inside]
    return out, starts, lengths, first


def feature_buckets(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of every feature text[start : start + length]."""
    out = np.zeros(len(starts), dtype=np.int64)
    order = np.argsort(lengths, kind="stable")
    edges = np.flatnonzero(np.diff(lengths[order], prepend=-1))
    for here in np.split(order, edges[1:]) if len(order) else ():
        length = int(lengths[here[0]])
        windows = np.lib.stride_tricks.sliding_window_view(text, length)
        some = max(1, MATRIX // length)
        for at in range(0, len(here), some):
            part = here[at : at + some]
            rows = windows[starts[part]]
            first, of = distinct_rows(rows)
            out[part] = (crc_columns(rows[first]).astype(np.int64) % buckets)[of]
    return out


def document_features(data: np.ndarray, offsets: np.ndarray, longest: int, buckets: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Words of each document, and for each length of runs (bucket of every feature, features before each document)."""
    text, starts, lengths, first = word_bytes(data, offsets)
    count, found = np.diff(first), []
    for k in range(1, longest + 1):
        runs = np.maximum(count - k + 1, 0)
        before = np.concatenate([[0], np.cumsum(runs)])
        at = np.arange(before[-1]) + np.repeat(first[:-1] - before[:-1], runs)
        last = at + k - 1
        found.append((feature_buckets(text, starts[at], starts[last] + lengths[last] - starts[at], buckets), before))
    return count, found


def bucket_counts(rows: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts by bucket, added up in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, part, at in steps(*utf8(batch.column(0)), STEP):
                for found, _ in document_features(part, at, longest, buckets)[1]:
                    total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    return rows.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """For every bucket floor(1000 ln(share of the target's features / share of all documents' features)), add-one smoothed.

    What comes to the driver is one number per bucket and table.
    """

    def counts(rows: DataFrame) -> np.ndarray:
        out = np.zeros(buckets, dtype=np.int64)
        for row in bucket_counts(rows, longest, buckets).collect():
            out[row["bucket"]] = row["n"]
        return out

    s, t = counts(docs), counts(target)
    above, below = float(int(s.sum()) + buckets), float(int(t.sum()) + buckets)
    return np.array([math.floor(1000 * math.log((float(b) + 1) * above / ((float(a) + 1) * below))) for a, b in zip(s.tolist(), t.tolist())], dtype=np.int64)


def weighed(rows: DataFrame, gain: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """The rows with __words, __features (their numbers) and __weight (sum of the gains of the features)."""
    buckets, at_text, names = len(gain), rows.columns.index("text"), [*rows.columns, "__words", "__features", "__weight"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, part, at in steps(*utf8(batch.column(at_text)), STEP):
                words, found = document_features(part, at, longest, buckets)
                features, weight = np.zeros(b - a, dtype=np.int64), np.zeros(b - a, dtype=np.int64)
                for bucket, before in found:
                    sums = np.concatenate([[0], np.cumsum(gain[bucket])])
                    features, weight = features + np.diff(before), weight + sums[before[1:]] - sums[before[:-1]]
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, *(pa.array(x, pa.int64()) for x in (words, features, weight))], names)

    shape = rows.withColumns({name: F.lit(0).cast("long") for name in names[-3:]}).schema
    return rows.mapInArrow(run, shape)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """floor(1000 x Gumbel noise) from the digest of `<seed>:<doc_id>`; null as an empty id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def importance_resampling(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank (all but doc_id long) for every row of (doc_id, text, any other columns).

    Of the N rows with at least `least_words` words the floor(percent N / 100) highest scores are drawn and ranked 1, 2, ...; of
    ties the smaller doc_id comes first, null last. rank is null for all others. Rows that share doc_id and score follow each
    other in any order. Null and empty texts have no features and weight 0; a null doc_id has the noise of an empty one.
    `target` needs a text column; an empty target gives gains below or at 0. An empty table gives no rows.
    """
    gain = gains(docs, target, longest, buckets)
    rows = weighed(identified(docs, "text"), gain, longest)
    score = (F.col("__weight") + noise(F.col("doc_id"), seed)).alias("score")
    with Intermediate(docs.sparkSession) as between:
        scored = between.written(rows.select("doc_id", F.col("__words").alias("n_words"), F.col("__features").alias("n_features"), F.col("__weight").alias("weight"), score, F.monotonically_increasing_id().alias("__row")), "scores")
        n = scored.where(F.col("n_words") >= least_words).count()
        order = scored.select("*", (-F.col("score")).alias("__lowest"), F.col("doc_id").isNull().alias("__unnamed"))
        ranked = order.where(F.col("n_words") >= least_words)
        some = max(RANKED_ROWS, n // RANKED_PARTS)
        ranked = running_before(ranked, ["__lowest", "__unnamed", "doc_id", "__row"], {"__before": F.lit(1).cast("long")}, rows=n, rows_per_bucket=some)
        place = F.col("__before") + 1
        kept = ["doc_id", "n_words", "n_features", "weight", "score"]
        ranked = ranked.select(*kept, F.when(place <= n * percent // 100, place).alias("rank"))
        others = scored.where(F.col("n_words") < least_words).select(*kept, F.lit(None).cast("long").alias("rank"))
        return between.result(ranked.unionByName(others), "ranks")


def resampled(docs: DataFrame, target: DataFrame, **parameters: int) -> DataFrame:
    """The drawn rows of `docs` with all their columns. Rows that share doc_id and score with the last drawn one come too."""
    ranks = importance_resampling(docs, target, **parameters)
    last = ranks.where("rank IS NOT NULL").orderBy(F.desc("rank")).select("doc_id", "score").first()
    if last is None:
        return docs.where("false")
    chosen = {k: parameters.get(k, d) for k, d in (("longest", LONGEST), ("buckets", BUCKETS))}
    rows = weighed(docs, gains(docs, target, **chosen), chosen["longest"])
    score = F.col("__weight") + noise(F.col("doc_id"), parameters.get("seed", SEED))
    unnamed, earlier = F.col("doc_id").isNull(), F.col("doc_id") <= F.lit(last["doc_id"])
    tied = F.lit(True) if last["doc_id"] is None else ~unnamed & earlier
    drawn = (F.col("__words") >= parameters.get("least_words", LEAST_WORDS)) & ((score > last["score"]) | ((score == last["score"]) & tied))
    return rows.where(drawn).select(*[F.col(f"`{c}`") for c in docs.columns])
