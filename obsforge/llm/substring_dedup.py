"""Removal of repeated word passages by Rabin-Karp hashes of all windows of a fixed number of words.

A window whose words also start in a document with a smaller id goes, with every word it covers. Shuffling one row per word of
the corpus is avoided without losing a window:

1. Each window names an anchor: its least gram (a short run of words, by hash). Equal windows name equal anchors, so a window
   can only repeat if its anchor occurs in two documents. About one position in twenty is an anchor.
2. An anchor's context is all words that windows with this anchor can reach. Where a smaller document has the same anchor in the
   same context, the whole context goes. Of the documents that share anchor and context the smallest stands for all.
3. Only where one anchor has several contexts, the documents that stand for them hash every window with that anchor. Windows
   are counted in Spark, and those that start in a smaller document go.
Intervals of a document are merged and cut out. Hashes are polynomials over 64-bit word hashes, two independent ones for windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsforge.llm.common import GAP, identified, mixed, possible, powers, steps, utf8, word_hashes, word_starts
from obsforge.session import written

WINDOW = 50
GRAM = 10
_BASES = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)


class RollingHash:
    """Hashes of any stretches of a sequence of word hashes from prefix sums: sum of h[i] * base^i, shifted back to the start."""

    def __init__(self, hashes: np.ndarray, base: int):
        up, self.down = powers(base, len(hashes) + 1), powers(pow(base, -1, 1 << 64), len(hashes) + 1)
        self.sums = np.append(np.uint64(0), np.cumsum(hashes * up[:-1], dtype=np.uint64))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """pick over values[i : i + width] for every i; beyond the end the last stretch is shorter."""
    out, held = values.copy(), 1
    while held < width:
        step = min(held, width - held)
        out[:-step] = pick(out[:-step], out[step:]) if step < len(out) else out[:-step]
        held += step
    return out


class _Anchors:
    """Grams, valid windows and the least gram of each, for the documents of one step."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int, gram: int):
        hashes, first = word_hashes(data, offsets)
        n, self.first, self.hashes = len(hashes), first, hashes
        self.rolling = RollingHash(hashes, _BASES[0])
        self.owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        self.end = first[1:][self.owner]
        at = np.arange(n)
        self.grams = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
        fits = at + gram <= self.end
        self.grams[fits] = self.rolling.of(at[fits], at[fits] + gram) >> np.uint64(1)
        self.valid = at + window <= self.end
        self.least = np.zeros(n, dtype=np.uint64)
        if self.valid.any():
            self.least[self.valid] = _sliding(self.grams, window - gram + 1, np.minimum)[self.valid]

    def chosen(self, reach: int) -> np.ndarray:
        """Positions whose gram is the least of a valid window that holds it."""
        before = np.append(np.zeros(reach, dtype=np.uint64), self.least)
        return np.flatnonzero((_sliding(before, reach + 1, np.maximum)[: len(self.grams)] == self.grams) & (self.grams > 0))


def _records(ids: pa.Array, rows: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    taken = ids.take(pa.array(rows, pa.int64()))
    return pa.RecordBatch.from_arrays([taken, *(pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(np.int64)) for c in columns.values())], ["doc_id", *columns])


def _anchors(window: int, gram: int):
    """(doc_id, gram, context, at, left, right): anchor positions, and the words of the context before and from the anchor on."""
    reach = window - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b, part, at in steps(data, offsets):
                found = _Anchors(part, at, window, gram)
                here = found.chosen(reach)
                if not len(here):
                    continue
                begin = found.first[found.owner[here]]
                low, high = np.maximum(begin, here - reach), np.minimum(found.end[here], here + window)
                context = mixed(RollingHash(found.hashes, _BASES[1]).of(low, high) + ((here - low) * 65536 + (high - here)).astype(np.uint64))
                yield _records(batch.column(0).slice(a, b - a), found.owner[here], {"gram": found.grams[here], "context": context, "at": here - begin, "left": here - low, "right": high - here})

    return run


def _windows(window: int, gram: int):
    """(doc_id, h1, h2, at): every window whose least gram stands at one of the given positions of its document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            places = batch.column(2)
            for a, b, part, at in steps(data, offsets):
                found = _Anchors(part, at, window, gram)
                other = RollingHash(found.hashes, _BASES[1])
                wanted = np.zeros(len(found.grams) + 1, dtype=bool)
                for row in range(a, b):
                    spots = np.array(places[row].as_py(), dtype=np.int64) + found.first[row - a]
                    wanted[spots[spots < found.first[row - a + 1]]] = True
                spots = np.flatnonzero(wanted[:-1])
                hit = np.zeros(len(found.grams) + 1, dtype=bool)
                for back in range(window - gram + 1):
                    start = spots - back
                    good = start >= 0
                    start, spot = start[good], spots[good]
                    hit[start[found.valid[start] & (found.least[start] == found.grams[spot]) & (found.owner[start] == found.owner[spot])]] = True
                start = np.flatnonzero(hit)
                if len(start):
                    yield _records(batch.column(0).slice(a, b - a), found.owner[start], {"h1": found.rolling.of(start, start + window), "h2": other.of(start, start + window), "at": start - found.first[found.owner[start]]})

    return run


def repeated_intervals(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, low, high): stretches of words, end exclusive, that repeat passages of smaller documents; they may overlap."""
    known = identified(docs, "text").where("doc_id IS NOT NULL")
    anchors = written(known.mapInArrow(_anchors(window, gram), "doc_id long, gram long, context long, at long, left long, right long"), "anchors")
    shared = anchors.groupBy("gram").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("gram")
    packed = (F.col("at") * 65536 + F.col("left") * 256 + F.col("right")).alias("place") if window < 256 else F.struct("at", "left", "right").alias("place")
    anchors = written(anchors.select("doc_id", "gram", "context", packed).join(shared, "gram", "left_semi"), "shared-anchors")
    if window < 256:
        at, left, right = F.expr("shiftright(place, 16)"), F.expr("shiftright(place, 8) & 255"), F.expr("place & 255")
    else:
        at, left, right = F.col("place.at"), F.col("place.left"), F.col("place.right")

    contexts = anchors.groupBy("gram", "context").agg(F.min("doc_id").alias("smallest"))
    several = written(contexts.groupBy("gram").agg((F.count(F.lit(1)) > 1).alias("several")), "shared-grams")
    judged = written(anchors.join(contexts.join(several, "gram"), ["gram", "context"]).select("doc_id", at.alias("at"), left.alias("left"), right.alias("right"), "smallest", "several"), "judged-anchors")
    whole = judged.where(f"doc_id > smallest AND left + right >= {window}").select("doc_id", (F.col("at") - F.col("left")).alias("low"), (F.col("at") + F.col("right")).alias("high"))

    open_places = written(judged.where("doc_id = smallest AND several").groupBy("doc_id").agg(F.collect_set("at").alias("places")), "open-anchors")
    texts = possible(known, open_places).where("__possible").join(open_places, "doc_id")
    hashed = written(texts.select("doc_id", "text", "places").mapInArrow(_windows(window, gram), "doc_id long, h1 long, h2 long, at long"), "windows")
    least = hashed.groupBy("h1", "h2").agg(F.min("doc_id").alias("smallest"), F.max("doc_id").alias("largest")).where("smallest < largest").drop("largest")
    single = hashed.join(least, ["h1", "h2"]).where("doc_id > smallest").select("doc_id", F.col("at").alias("low"), (F.col("at") + window).alias("high"))
    return whole.union(single)


def _cut(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            spans = batch.column(2)
            for a, b, part, at in steps(data, offsets):
                starts, first = word_starts(part, at)
                keep = np.ones(len(starts), dtype=bool)
                for row in range(a, b):
                    if spans[row].is_valid:
                        begin, end = first[row - a], first[row - a + 1]
                        for span in spans[row].as_py():
                            keep[min(end, begin + span["low"]) : min(end, begin + span["high"])] = False
                # A kept word takes one gap byte before it along, as a space, unless it is the first kept one of its document.
                kept = np.flatnonzero(keep)
                owner = np.searchsorted(first, kept, side="right") - 1
                later = np.append(False, owner[1:] == owner[:-1])[: len(kept)]
                stay = ~GAP[part]
                lengths = np.diff(np.append(starts, len(part)))
                if len(starts):
                    stay[starts[0] :] &= np.repeat(keep, lengths)
                out = part.copy()
                out[starts[kept[later]] - 1] = 0x20
                stay[starts[kept[later]] - 1] = True
                cuts = np.append(0, np.cumsum(stay))[at]
                result = out[stay].tobytes()
                texts = [result[cuts[i] : cuts[i + 1]] for i in range(b - a)]
                words = np.diff(first)
                gone = words - np.diff(np.append(0, np.cumsum(keep))[first])
                columns = [batch.column(0).slice(a, b - a), pa.array(words), pa.array(gone), pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if with_text:
                    columns.append(pa.array([t.decode("utf-8", "replace") for t in texts], pa.string()))
                    names.append("kept_text")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def without_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256[, kept_text] for every row of `docs` (doc_id, text, any other columns).

    Words are separated by white space in ASCII; kept words are joined by one space. Null and empty texts have no words, texts
    shorter than a window lose none. A row without doc_id gives and loses nothing. Rows that repeat a doc_id are one document:
    they do not count against each other, and all of them lose the words found in any. An empty table gives no rows.
    """
    spans = written(repeated_intervals(docs, window).groupBy("doc_id").agg(F.collect_set(F.struct("low", "high")).alias("spans")), "removals")
    rows = possible(identified(docs, "text"), spans)
    # Only texts that may lose words are shuffled to meet their intervals.
    whole = rows.where("NOT __possible").select("doc_id", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))
    rows = whole.union(rows.where("__possible").join(spans, "doc_id", "left").select("doc_id", "text", "spans"))
    shape = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return rows.mapInArrow(_cut(with_text), shape)
