"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of whole texts are computed once per document. Boosted trees are grown on a bounded sample of labelled rows; every
path from a root to a node is a conjunctive rule. A lasso logistic regression keeps few of them, and these become one Spark
column expression over the statistics.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsforge.llm.common import identified, steps, utf8, word_hashes, word_starts

# Labelled rows a model is fitted on; beyond that a share of all, by a hash of doc_id.
MAX_LABELLED = 20_000
TREES, DEPTH, BINS, RATE, LEAF = 30, 3, 32, 0.3, 20
LASSO = 0.002
ITERATIONS = 400

STATISTICS = [
    "log_words", "word_length", "letters", "capitals", "digits", "stops", "symbols", "spaces", "line_words", "distinct_words",
    "top_word", "echoes", "longest_echo", "distinct_lines", "single_letters", "bare_symbols",
]

_KIND = np.full(256, 5, dtype=np.uint8)  # letters 0, capitals 1, digits 2, stops 3, white space 4, other symbols 5
_KIND[[*range(ord("a"), ord("z") + 1), *range(128, 256)]] = 0
_KIND[range(ord("A"), ord("Z") + 1)] = 1
_KIND[range(ord("0"), ord("9") + 1)] = 2
_KIND[[ord(c) for c in ".,;:'\"()-"]] = 3
_KIND[[0x20, *range(0x09, 0x0E)]] = 4
_LINE_GAP = np.zeros(256, dtype=bool)
_LINE_GAP[[0x0A, 0x0D]] = True


def text_statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """[document, statistic] in the order of STATISTICS; all zero for a text without words."""
    n = len(offsets) - 1
    out = np.zeros((n, len(STATISTICS)))
    hashes, first = word_hashes(data, offsets)
    starts, _ = word_starts(data, offsets)
    _, first_line = word_starts(data, offsets, _LINE_GAP)
    line_starts, _ = word_starts(data, offsets, _LINE_GAP)
    kinds = _KIND[data]
    # Upper-case letters beyond ASCII that two-byte UTF-8 writes as C3 80..9E.
    accented = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[:-1] == 0xC3)) + 1
    kinds[accented] = 1
    words_after = np.append(starts, len(data))
    for i in range(n):
        a, b, lo, hi = first[i], first[i + 1], offsets[i], offsets[i + 1]
        count = b - a
        if not count:
            continue
        share = np.bincount(kinds[lo:hi], minlength=6) / (hi - lo)
        here = hashes[a:b]
        _, times = np.unique(here, return_counts=True)
        same = here[1:] == here[:-1]
        breaks = np.flatnonzero(np.concatenate([[True], ~same, [True]]))
        lengths = np.minimum(np.diff(words_after[a : b + 1]), hi - starts[a:b])
        lines = line_starts[first_line[i] : first_line[i + 1]]
        ends = np.append(lines[1:], hi)
        seen = {data[s:e].tobytes().strip() for s, e in zip(lines.tolist(), ends.tolist())}
        head = kinds[starts[a:b]]
        out[i] = [
            np.log1p(count), (1 - share[4]) * (hi - lo) / count, share[0], share[1], share[2], share[3], share[5], share[4],
            np.log1p(count / len(lines)), len(times) / count, times.max() / count, same.sum() / count, np.diff(breaks).max() / count,
            len(seen) / len(lines), (lengths <= 2).sum() / count, (head == 5).sum() / count,
        ]
    return out


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of its whole text; null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b, part, at in steps(data, offsets):
                found = text_statistics(part, at)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(found[:, k]) for k in range(len(STATISTICS)))], ["doc_id", *STATISTICS])

    shape = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{s} double" for s in STATISTICS)
    return identified(docs, "text").mapInArrow(run, shape)


class Rule(NamedTuple):
    """A conjunction of (statistic, whether above, bound) with its weight."""

    terms: tuple[tuple[int, bool, float], ...]
    weight: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), dtype=bool)
        for k, above, bound in self.terms:
            out &= (x[:, k] > bound) == above
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for k, above, bound in self.terms:
            out = out & ((F.col(STATISTICS[k]) > bound) if above else (F.col(STATISTICS[k]) <= bound))
        return F.when(out, F.lit(self.weight)).otherwise(F.lit(0.0))


class Ensemble(NamedTuple):
    intercept: float
    rules: list[Rule]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule in self.rules:
            total = total + rule.column()
        return 1 / (1 + F.exp(-total))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def tree_paths(x: np.ndarray, y: np.ndarray) -> list[tuple]:
    """Paths to all nodes of boosted trees (logistic loss, second-order splits on quantile bins)."""
    cuts = [np.unique(np.quantile(x[:, k], np.arange(1, BINS) / BINS)) for k in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)], axis=1)
    margin, paths = np.full(len(y), np.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9))), []
    for _ in range(TREES):
        p = _sigmoid(margin)
        slope, curve = y - p, p * (1 - p)
        nodes = [((), np.arange(len(y)))]
        for depth in range(DEPTH + 1):
            below = []
            for terms, rows in nodes:
                if terms:
                    paths.append(terms)
                best, choice = 1e-6, None
                g, h = slope[rows].sum(), curve[rows].sum()
                for k in range(x.shape[1]) if depth < DEPTH and len(rows) >= 2 * LEAF else ():
                    where = binned[rows, k]
                    size = len(cuts[k]) + 1
                    gs, hs = np.cumsum(np.bincount(where, slope[rows], size))[:-1], np.cumsum(np.bincount(where, curve[rows], size))[:-1]
                    counts = np.cumsum(np.bincount(where, minlength=size))[:-1]
                    gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
                    gain[(counts < LEAF) | (len(rows) - counts < LEAF)] = 0
                    if len(gain) and gain.max() > best:
                        best, choice = gain.max(), (k, int(gain.argmax()))
                if choice is None:
                    margin[rows] += RATE * g / (h + 1)
                    continue
                k, at = choice
                high, bound = binned[rows, k] > at, float(cuts[k][at])
                below += [((*terms, (k, False, bound)), rows[~high]), ((*terms, (k, True, bound)), rows[high])]
            nodes = below
    return list(dict.fromkeys(paths))


def lasso_logistic(features: np.ndarray, y: np.ndarray, penalty: float = LASSO) -> tuple[float, np.ndarray]:
    """Intercept and sparse weights by accelerated proximal gradient steps."""
    z = features.astype(np.float64)
    n = len(y)
    top = np.ones(z.shape[1])
    for _ in range(20):  # power iteration: the largest eigenvalue bounds the step
        top = z.T @ (z @ top)
        top /= np.linalg.norm(top) + 1e-12
    step = 4 * n / (np.linalg.norm(z @ top) ** 2 + n)
    w, b = np.zeros(z.shape[1]), float(np.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9)))
    v, c, t = w.copy(), b, 1.0
    for _ in range(ITERATIONS):
        r = _sigmoid(z @ v + c) - y
        new = v - step * (z.T @ r) / n
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        bias, ahead = c - step * r.mean(), (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / ahead * (new - w), bias + (t - 1) / ahead * (bias - b)
        w, b, t = new, bias, ahead
    return b, w


def fit(labelled: DataFrame, most: int = MAX_LABELLED) -> Ensemble:
    """Ensemble from (doc_id, label 0/1, statistics); at most about `most` rows are used, a share of all by hash of doc_id.

    Rows without label are ignored. Without any row every score is 0.5; with one class only the score is that class's share.
    """
    labelled = labelled.where("label IS NOT NULL")
    count = labelled.count()
    if count > most:
        labelled = labelled.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) < int(1e6 * most / count))
    rows = labelled.select("doc_id", F.col("label").cast("double"), *STATISTICS).toPandas().sort_values(["doc_id", *STATISTICS])
    if not len(rows):
        return Ensemble(0.0, [])
    x, y = rows[STATISTICS].to_numpy(), rows["label"].to_numpy()
    if y.min() == y.max():
        return Ensemble(float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))), [])
    paths = tree_paths(x, y)
    if not paths:
        return Ensemble(float(np.log(y.mean() / (1 - y.mean()))), [])
    rules = [Rule(terms, 0.0) for terms in paths]
    bias, weights = lasso_logistic(np.stack([r.holds(x) for r in rules], axis=1), y)
    return Ensemble(float(bias), [Rule(r.terms, float(w)) for r, w in zip(rules, weights) if w])


def scored(table: DataFrame, ensemble: Ensemble, threshold: float = 0.3) -> DataFrame:
    """doc_id, score (share of label 1), predicted (1 if score >= threshold) from a table of statistics, one row for each of its rows."""
    rows = table.select("doc_id", ensemble.score().alias("score"))
    return rows.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
