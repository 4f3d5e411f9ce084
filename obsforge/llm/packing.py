"""Packing of documents into training sequences: first-fit decreasing over a tournament tree of bin capacities.

Documents are tokenised in parallel and cut into pieces of at most one sequence. Pieces are dealt at random into groups of
bounded size; each group is packed on its own.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsforge.llm.common import identified, kept_in_worker, mixed, powers, release
from obsforge.session import written

CAPACITY = 1024
END_TOKEN = 0
GROUP_PIECES = 8192  # expected pieces of a group, dealt at random
STEP_CHARACTERS = 1 << 19
CACHED_BYTES = 32 << 20  # ids of distinct words are kept by a worker up to so many bytes before it starts anew,
WORD_BYTES = 150  # at about so many for a word

_OTHER, _LETTER, _DIGIT, _SPACE = 0, 1, 2, 3
_POINT_BASE = 0x9FB21C651E98DF25
# How byte-level models write bytes: printable ones as themselves, the others as the characters from 256 on, in order.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_POINTS = np.arange(256, dtype="<u2")
_BYTE_POINTS[sorted(set(range(256)) - set(_PRINTABLE))] = np.arange(256, 512 - len(_PRINTABLE))


@lru_cache(maxsize=1)
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Class of every code point in the word pattern, and whether libraries may disagree about it."""
    kind, doubtful = np.zeros(0x110000, dtype=np.uint8), np.zeros(0x110000, dtype=bool)
    for first in range(0, 0x110000, 0x800):  # blocks of this size are all of surrogates or without any
        if 0xD800 <= first <= 0xDFFF:
            continue
        text = "".join(map(chr, range(first, first + 0x800)))
        for pattern, value in ((r"\p{L}+", _LETTER), (r"\p{N}+", _DIGIT), (r"\p{White_Space}+", _SPACE), (r"\p{Cn}+", -1)):
            for found in regex.finditer(pattern, text):
                span = slice(first + found.start(), first + found.end())
                if value < 0:
                    doubtful[span] = True
                else:
                    kind[span] = value
    doubtful[0x1C:0x20] = True  # separators that some patterns take for white space
    doubtful[0x10000:] |= kind[0x10000:] != _OTHER  # letters and digits that newer Unicode versions add
    return kind, doubtful


class WordTokenizer:
    """Ids of whole texts, equal to the tokenizer's own, from the ids of distinct words.

    A byte-level tokenizer splits a text by a pattern and encodes every word by itself. The split is done here in numpy, each
    distinct word of a step is encoded once by the tokenizer and kept. A text with special tokens or with characters whose
    class may differ between Unicode versions goes to the tokenizer whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        """Empty store: the slot of each known word; where a slot's ids begin, how many they are, and all ids one after another."""
        self.known: dict[int, int] = {}
        self.begins, self.counts = np.zeros(1 << 16, dtype=np.int64), np.zeros(1 << 16, dtype=np.int64)
        self.ids, self.used = np.zeros(1 << 18, dtype=np.uint32), 0

    def _learn(self, keys: list[int], words: list[str]) -> None:
        """Encodes words, their bytes written as characters, by the tokenizer's own model."""
        tokenize = self.tokenizer.model.tokenize
        found = [[token.id for token in tokenize(w)] for w in words]
        counts = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        first, total = len(self.known), int(counts.sum())
        while first + len(words) > len(self.counts):
            self.begins, self.counts = np.concatenate([self.begins, np.zeros_like(self.begins)]), np.concatenate([self.counts, np.zeros_like(self.counts)])
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.counts[first : first + len(words)] = counts
        self.begins[first : first + len(words)] = self.used + np.cumsum(counts) - counts
        self.ids[self.used : self.used + total] = np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=total)
        self.used += total
        self.known.update(zip(keys, range(first, first + len(words))))

    def _direct(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def _word_starts(points: np.ndarray, kind: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """Where words begin: 's 't 're 've 'm 'll 'd | ?letters | ?digits | ?others | white space but its last character."""
        n = len(points)
        start = np.ones(n, dtype=bool)
        start[1:] = kind[1:] != kind[:-1]
        head = np.zeros(n + 2, dtype=bool)
        head[heads] = True
        start |= head[:n]
        inner = ~head[1 : n + 1]  # the next character belongs to the same text
        inner[n - 1] = False
        space = kind == _SPACE
        last = np.flatnonzero(space[:-1] & ~space[1:] & inner[:-1])
        start[last] = True
        start[last + 1] = points[last] != 0x20
        quote = np.flatnonzero((points[:-1] == 0x27) & start[:-1] & (kind[1:] == _LETTER) & inner[:-1])
        if len(quote):
            one = points[quote + 1]
            beyond = np.minimum(quote + 2, n - 1)
            more = inner[quote + 1] & (quote + 2 < n)
            two = np.where(more, points[beyond], 0)
            short = np.isin(one, [ord(c) for c in "stmd"])
            long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
            hit = short | long
            start[quote[hit] + 1] = False
            after = quote[hit] + np.where(short[hit], 2, 3)
            follows = (after < n) & ~head[np.minimum(after, n)]
            after = after[follows]
            start[after[kind[after] == _LETTER]] = True
        return start

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        classes, doubtful = _classes()
        out: list[np.ndarray | None] = [None] * len(texts)
        points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for t in texts]
        easy = [i for i, p in enumerate(points) if len(p) and not doubtful[p].any() and not any(s in texts[i] for s in self.special)]
        hard = sorted(set(range(len(texts))) - set(easy))
        for i, ids in zip(hard, self._direct([texts[i] for i in hard])):
            out[i] = ids
        if not easy:
            return out
        flat = np.concatenate([points[i] for i in easy])
        lengths = np.array([len(points[i]) for i in easy])
        heads = np.cumsum(lengths) - lengths
        starts = np.flatnonzero(self._word_starts(flat, classes[flat], heads))
        sizes = np.diff(np.append(starts, len(flat)))
        value = mixed(flat.astype(np.uint64) + np.uint64(1))
        value *= powers(_POINT_BASE, int(sizes.max()))[np.arange(len(flat)) - np.repeat(starts, sizes)]
        words, at, which = np.unique(mixed(np.add.reduceat(value, starts)), return_index=True, return_inverse=True)
        if len(self.known) * WORD_BYTES > CACHED_BYTES:
            self._forget()
        keys = words.tolist()
        new = [i for i, key in enumerate(keys) if key not in self.known]
        if new:
            spelled = _BYTE_POINTS[np.frombuffer("".join([texts[i] for i in easy]).encode(), dtype=np.uint8)].tobytes().decode("utf-16-le")
            place = np.append(0, np.cumsum(1 + (flat >= 0x80) + (flat >= 0x800) + (flat >= 0x10000)))
            begins, ends = place[starts[at[new]]].tolist(), place[starts[at[new]] + sizes[at[new]]].tolist()
            self._learn([keys[i] for i in new], [spelled[a:b] for a, b in zip(begins, ends)])
        slots = np.fromiter(map(self.known.__getitem__, keys), dtype=np.int64, count=len(keys))[which]
        per_word = self.counts[slots]
        ends = np.cumsum(per_word)
        ids = self.ids[np.repeat(self.begins[slots] - (ends - per_word), per_word) + np.arange(ends[-1])]
        cuts = np.append(0, ends)[np.searchsorted(starts, np.append(heads, len(flat)))]
        for row, i in enumerate(easy):
            out[i] = ids[cuts[row] : cuts[row + 1]]
        return out


def _tokenizer(path: str) -> WordTokenizer:
    return kept_in_worker(("tokenizer", path), lambda: WordTokenizer(path))


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]): every document's ids and END_TOKEN, cut after each `capacity` ids.

    `tokenizer` is the file of a byte-level tokenizer at the same place on all executors. Null text is empty: one id. With
    `with_ids`, ids holds the piece as little-endian unsigned 32-bit integers.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]

    def cut(ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
        rows, start, length, crc, total, parts = [], [], [], [], [], []
        for row, encoded in enumerate(_tokenizer(tokenizer).encode(texts)):
            whole = np.append(encoded, END_TOKEN).astype("<u4")
            for at in range(0, len(whole), capacity):
                part = whole[at : at + capacity].tobytes()
                rows.append(row)
                start.append(at)
                length.append(len(part) // 4)
                crc.append(zlib.crc32(part))
                total.append(len(whole))
                if with_ids:
                    parts.append(part)
        columns = [ids.take(pa.array(rows, pa.int64())), *(pa.array(c, pa.int64()) for c in (start, length, crc, total)), *[pa.array(parts, pa.binary())] * with_ids]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, texts, size = 0, [], 0
            for row in range(len(batch)):
                texts.append(batch.column(1)[row].as_py() or "")
                size += len(texts[-1])
                if size >= STEP_CHARACTERS or row + 1 == len(batch):
                    yield cut(batch.column(0).slice(first, row + 1 - first), texts)
                    first, texts, size = row + 1, [], 0
            release()

    shape = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return identified(docs, "text").mapInArrow(run, shape)


class BinTree:
    """Tournament tree over the free space of bins: each node holds the most free space below it."""

    def __init__(self, capacity: int, bins: int):
        self.leaves = 1
        while self.leaves < max(1, bins):
            self.leaves *= 2
        self.most = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """Takes `size` from the first bin that has it; the bin, and what was free in it."""
        node, most = 1, self.most
        while node < self.leaves:
            node *= 2
            if most[node] < size:
                node += 1
        free = most[node]
        most[node] = free - size
        found, node = node - self.leaves, node // 2
        while node:
            most[node] = max(most[2 * node], most[2 * node + 1])
            node //= 2
        return found, free


def first_fit_decreasing(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every size, longest first; equal sizes keep their order."""
    bins, offsets = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    tree = BinTree(capacity, len(sizes))
    for i in np.argsort(-sizes, kind="stable").tolist():
        found, free = tree.place(int(sizes[i]))
        bins[i], offsets[i] = found, capacity - free
    return bins, offsets


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, with_ids: bool = False) -> DataFrame:
    """The rows of `pieces` with sequence_id and offset: where each piece lies, without gaps or overlaps.

    docs: (doc_id, text, any other columns). A row repeating another is packed as well. An empty table gives no rows.
    """
    cut = written(pieces(docs, tokenizer, capacity, with_ids), "pieces")
    groups = max(1, -(-cut.count() // group_pieces))
    # A number of its own for each row: the deal is uniform whatever ids and texts repeat.
    dealt = cut.withColumn("group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable")
        bins, offsets = first_fit_decreasing(rows["length"].to_numpy(), capacity)
        return rows.assign(sequence_id=(int(rows["group"].iloc[0]) << 32) + bins, offset=offsets).drop(columns="group")

    shape = ", ".join(f"`{n}` {t}" for n, t in cut.dtypes) + ", sequence_id long, offset long"
    return dealt.groupBy("group").applyInPandas(run, shape)
