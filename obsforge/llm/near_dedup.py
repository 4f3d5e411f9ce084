"""Near duplicates by MinHash with sequential Bayesian verification.

1. Every document's shingle set gives BANDS * ROWS min-hashes. Documents of equal sets form one class.
2. Classes that share a band are candidates. Within a band's bucket, signatures are compared batch by batch; a pair goes as
   soon as the posterior probability of its similarity reaching the threshold is below MISS.
3. Survivors are verified on the full shingle sets, the likeliest first; a pair that verified links already connect needs no
   look. So a bucket hands on links in proportion to its members, never its pairs, and yet connects all that belongs together.
4. Components of the verified links are found by contraction. Only buckets of several blocks are looked at once more: classes
   outside the bucket's commonest component are compared with its other blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsforge.llm.common import attach, forget_kept, identified, mixed, release, steps, utf8, word_hashes
from obsforge.llm.graph import components
from obsforge.session import written

SHINGLE_WORDS = 5
THRESHOLD = 80  # percent: 100 * intersection >= THRESHOLD * union
# At similarity 0.8 all bands miss with probability (1 - 0.8^5)^32 = 3e-6; pairs at 0.1 meet with 3e-4.
BANDS, ROWS = 32, 5
BATCH = 40  # min-hashes compared before each decision
MISS = 1e-6  # a pair is given up below this posterior probability of being similar enough
# Classes, and shingles of all of them, that one task compares; larger buckets are dealt into blocks.
BLOCK, BLOCK_SHINGLES = 1024, 2_000_000
TASK_ROWS = 4096  # rows of buckets that are dealt to one task

_HASHES = BANDS * ROWS
_FACTORS = (mixed(np.arange(1, _HASHES + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SHIFTS = (mixed(np.arange(1, _HASHES + 1, dtype=np.uint64)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
_BAND_FACTORS = mixed(np.arange(1001, 1001 + _HASHES, dtype=np.uint64)).reshape(BANDS, ROWS) | np.uint64(1)
_WORD_FACTORS = mixed(np.arange(2001, 2100, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """For each document the sorted distinct hashes of its `words`-word shingles (A-Z in lower case)."""
    hashes, first = word_hashes(data, offsets, lower=True)
    m = max(0, len(hashes) - words + 1)
    runs = np.zeros(m, dtype=np.uint64)
    for k in range(words):
        runs += hashes[k : k + m] * _WORD_FACTORS[k]
    runs = mixed(runs)
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= words:
            sets.append(np.unique(runs[a : b - words + 1]))
        else:  # too short for a shingle: the whole sequence is one
            part = hashes[a:b] * _WORD_FACTORS[: b - a]
            sets.append(mixed(part.sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)) if b > a else part)
    return sets


def set_digest(one: np.ndarray) -> tuple[int, int]:
    """128 bits that depend only on the members of the set."""
    return tuple(int(mixed(one ^ np.uint64(salt)).sum(dtype=np.uint64).view(np.int64)) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F))


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """[set, hash] minima; sets must not be empty."""
    values = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    at = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((_HASHES, len(sets)), dtype=np.uint32)
    for k in range(_HASHES):
        out[k] = np.minimum.reduceat(values * _FACTORS[k] + _SHIFTS[k], at)
    return out.T


def least_matches(compared: int, threshold: float, miss: float) -> int:
    """Fewest equal min-hashes of `compared` at which similarity >= threshold still has posterior probability >= miss.

    Under a uniform prior the posterior of the match rate is Beta(m + 1, n - m + 1), whose upper tail at q is the probability
    that at most m of n + 1 trials at rate q succeed. One byte of each min-hash is kept, so unequal ones match at 1/256.
    """
    q, tail = threshold + (1 - threshold) / 256, 0.0
    for m in range(compared + 2):
        tail += math.comb(compared + 1, m) * q**m * (1 - q) ** (compared + 1 - m)
        if tail >= miss:
            return m
    return compared


def _sketch(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b, part, at in steps(data, offsets):
                sets = shingle_sets(part, at, words)
                full = [i for i, s in enumerate(sets) if len(s)]
                low, high = [0] * len(sets), [0] * len(sets)
                bands: list = [None] * len(sets)
                marks: list = [None] * len(sets)
                if full:
                    minima = minhashes([sets[i] for i in full])
                    keys = mixed((minima.reshape(-1, BANDS, ROWS) * _BAND_FACTORS).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
                    bytes_kept = ((minima * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)
                    for row, i in enumerate(full):
                        low[i], high[i] = set_digest(sets[i])
                        bands[i], marks[i] = keys[row], bytes_kept[row].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()), pa.array(low, pa.int64()), pa.array(high, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(marks, pa.binary())],
                    ["doc_id", "n_shingles", "low", "high", "bands", "marks"],
                )
            del batch, data, offsets
            release()

    return run


def _survivors(marks: np.ndarray, sizes: np.ndarray, apart: np.ndarray, threshold: int) -> np.ndarray:
    """Matrix of equal min-hashes of the pairs that survive all batches, 0 elsewhere; `apart` names the parts to compare across."""
    n, out = len(marks), np.zeros((len(marks), len(marks)), dtype=np.int16)
    needed = [least_matches(end, threshold / 100, MISS) for end in range(BATCH, _HASHES + 1, BATCH)]
    for i in range(n - 1):
        near = (apart[i + 1 :] != apart[i]) & (100 * np.minimum(sizes[i + 1 :], sizes[i]) >= threshold * np.maximum(sizes[i + 1 :], sizes[i]))
        others = np.flatnonzero(near) + i + 1
        found = np.zeros(len(others), dtype=np.int16)
        for batch, least in enumerate(needed):
            span = slice(batch * BATCH, (batch + 1) * BATCH)
            found = found + (marks[others, span] == marks[i, span]).sum(axis=1, dtype=np.int16)
            stay = found >= least
            others, found = others[stay], found[stay]
        out[i, others] = out[others, i] = found
    return out


def _forest(weights: np.ndarray) -> list[tuple[int, int]]:
    """Maximum spanning forest of a dense symmetric matrix; 0 means no link."""
    n, links = len(weights), []
    best, via, free = np.full(n, -1, dtype=np.int32), np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
    for _ in range(n):
        i = int(np.argmax(np.where(free, best, -2)))
        if best[i] > 0:
            links.append((int(via[i]), i))
        free[i] = False
        better = free & (weights[i] > best) & (weights[i] > 0)
        best[better], via[better] = weights[i][better], i
    return links


def _connected(sets: list[np.ndarray], weights: np.ndarray, roots: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Verified links that connect what any verified survivor connects: the likeliest first, none between parts already joined."""
    roots, links = roots.copy(), []

    def verify(i: int, j: int) -> None:
        if roots[i] != roots[j]:
            shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * shared >= threshold * (len(sets[i]) + len(sets[j]) - shared):
                links.append((i, j))
                roots[roots == roots[j]] = roots[i]

    tried = _forest(weights)
    for i, j in tried:
        verify(i, j)
        weights[i, j] = weights[j, i] = 0
    x, y = np.nonzero(np.triu(weights) * (roots[:, None] != roots[None, :]))
    for k in np.argsort(-weights[x, y], kind="stable").tolist():
        verify(int(x[k]), int(y[k]))
    return links


class _Block(NamedTuple):
    """One class in a block of a bucket."""

    cid: int
    asked: bool
    root: int
    size: int
    marks: bytes
    shingles: np.ndarray


def _links_of(block: list[_Block], threshold: int) -> list[tuple[int, int]]:
    """Verified links within a block, only those that have a row asked for at one end."""
    rows = list({r.cid: r for r in sorted(block, key=lambda r: (r.cid, r.asked))}.values())
    if len(rows) < 2:
        return []
    roots, asked = np.array([r.root for r in rows]), np.array([r.asked for r in rows])
    marks = np.frombuffer(b"".join(r.marks for r in rows), dtype=np.uint8).reshape(-1, _HASHES)
    weights = _survivors(marks, np.array([r.size for r in rows]), roots, threshold)
    if not asked.all():
        weights[~(asked[:, None] | asked[None, :])] = 0
    return [(rows[i].cid, rows[j].cid) for i, j in _connected([r.shingles for r in rows], weights, roots, threshold)]


def _blocks(words: int, threshold: int, keys: int):
    """Links of all blocks of a task: rows arrive sorted by the first `keys` columns, which name a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, block = None, []
        forget_kept()

        def links(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["x", "y"])

        for batch in batches:
            found: list[tuple[int, int]] = []
            names = list(zip(*(batch.column(k).to_pylist() for k in range(keys))))
            cids, roots, asked, sizes, lows, highs, marks = (batch.column(keys + k).to_pylist() for k in range(7))
            for a, _, part, at in steps(*utf8(batch.column(keys + 7))):
                for i, shingles in enumerate(shingle_sets(part, at, words), a):
                    if names[i] != name:
                        found += _links_of(block, threshold)
                        name, block = names[i], []
                    # Another text under the same doc_id does not belong to the class.
                    if len(shingles) == sizes[i] and set_digest(shingles) == (lows[i], highs[i]):
                        block.append(_Block(cids[i], asked[i], roots[i], sizes[i], marks[i], shingles))
            yield links(found)
            del batch, cids, roots, asked, sizes, lows, highs, marks, names
            release()
        yield links(_links_of(block, threshold))
        block.clear()
        release()

    return run


def _links(dealt: DataFrame, classes: DataFrame, keys: list[str], words: int, threshold: int) -> DataFrame:
    """Verified links (x, y) of the blocks of (cid, root, asked), with what `classes` knows of each cid; spread over many tasks."""
    parts = max(1, -(-dealt.count() // TASK_ROWS))
    rows = dealt.join(classes, "cid").select(*keys, "cid", "root", "asked", "n_shingles", "low", "high", "marks", "text")
    return rows.repartition(parts, *keys).sortWithinPartitions(*keys).mapInArrow(_blocks(words, threshold, len(keys)), "x long, y long")


def similar_classes(classes: DataFrame, docs: DataFrame, words: int, threshold: int) -> DataFrame:
    """(id, root) for the classes (cid, doc_id, n_shingles, low, high, bands, marks) that are linked with another class."""
    rows = classes.select(F.explode("bands").alias("key"), "cid")
    met = rows.groupBy("key").agg(F.min("cid").alias("least"), F.max("cid").alias("most")).where("least < most").select("key")
    members = rows.join(met, "key", "left_semi")
    members = written(members.join(classes.select("cid", "n_shingles"), "cid"), "bucket-members")
    # Buckets of the same members are compared once.
    mark = [F.pmod(F.xxhash64("cid", F.lit(salt)), F.lit(1 << 31)) for salt in (1, 2, 3)]
    alike = members.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.sum("n_shingles").alias("shingles"), F.min("cid").alias("centre"), *[F.sum(m).alias(f"s{i}") for i, m in enumerate(mark)])
    chosen = alike.groupBy("size", "shingles", "centre", "s0", "s1", "s2").agg(F.min("key").alias("key"))
    parts = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("shingles") / BLOCK_SHINGLES)).cast("int").alias("parts")
    members = written(members.select("key", "cid").join(chosen.select("key", "centre", parts), "key"), "bucket-members")

    active = written(classes.join(members, "cid", "left_semi").select("cid", "doc_id", "low", "high"), "active")
    texts = attach(identified(docs, "text"), active, ["doc_id"], "inner").select("cid", "low", "high", "text")
    full = texts.join(classes.select("cid", "n_shingles", "marks"), "cid")

    # Every block of a bucket, each with the bucket's first class to tie the blocks together.
    blocks = F.when(F.col("cid") == F.col("centre"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.pmod(F.xxhash64("cid", "key"), F.col("parts")).cast("int")))
    dealt = members.select("key", "cid", F.explode(blocks).alias("block"), F.col("cid").alias("root"), F.lit(True).alias("asked"))
    links = written(_links(dealt, full, ["key", "block"], words, threshold), "verified")
    roots = components(links)
    large = members.where("parts > 1")
    if large.isEmpty():
        return roots

    # Buckets of several blocks whose classes are still apart: all outside the commonest part are compared with all others.
    labelled = written(large.join(roots.select(F.col("id").alias("cid"), "root"), "cid", "left").withColumn("root", F.coalesce("root", "cid")), "open-members")
    shares = labelled.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    apart = shares.groupBy("key").agg(F.max_by("root", "n").alias("common"), F.count(F.lit(1)).alias("roots"), (F.sum("n") - F.max("n")).alias("outside")).where("roots > 1")
    labelled = labelled.join(apart.select("key", "common", F.ceil(F.col("outside") / BLOCK).cast("int").alias("rounds")), "key")
    place = F.pmod(F.xxhash64("cid", "key"), F.col("parts")).cast("int")
    turn = F.pmod(F.xxhash64("key", "cid"), F.col("rounds")).cast("int")
    outside = labelled.where("root <> common").select("key", "cid", "root", turn.alias("turn"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("block"), F.lit(True).alias("asked"))
    inside = labelled.select("key", "cid", "root", F.explode(F.sequence(F.lit(0), F.col("rounds") - 1)).alias("turn"), place.alias("block"), F.lit(False).alias("asked"))
    more = _links(outside.unionByName(inside), full, ["key", "turn", "block"], words, threshold)
    return components(links.union(more))


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of `docs` (doc_id, text, any other columns).

    Two documents are linked if 100 * shared shingles >= threshold * all shingles of both; component_id is the smallest doc_id
    reachable by links. A text with fewer words than a shingle is one shingle; null text and text without words have none, are
    linked with nothing and kept. Rows repeating a doc_id are judged by their own text. A row without doc_id takes part; it is
    kept only if no row of its component has one. An empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, n_shingles long, low long, high long, bands array<long>, marks binary"
    sketches = written(identified(docs, "text").mapInArrow(_sketch(words), shape), "sketches")
    same = ["n_shingles", "low", "high"]
    sets = sketches.where("n_shingles > 0").groupBy(*same).agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    sets = written(sets.withColumn("cid", F.monotonically_increasing_id()), "classes")
    one = sets.select("cid", F.col("least").alias("doc_id"), *same)
    classes = written(sketches.join(one.withColumnRenamed("doc_id", "id"), same).where(F.col("doc_id").eqNullSafe(F.col("id"))).drop("id"), "class-sketches")
    roots = similar_classes(classes, docs, words, threshold)
    grouped = sets.join(roots.select(F.col("id").alias("cid"), "root"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    least = grouped.groupBy("root").agg(F.min("least").alias("component"))
    judged = grouped.join(least, "root").where("copies > 1 OR component IS DISTINCT FROM least").select(*same, "component", F.lit(True).alias("known"))
    rows = attach(sketches.select("doc_id", *same), written(judged, "judged"), same, "left", F.lit(64))
    component = F.when(F.col("known"), F.col("component")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
