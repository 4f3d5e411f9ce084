"""Language identification by cross-parsing: the language whose labelled text covers a document in the fewest phrases wins.

A suffix automaton of each language's labelled text recognises exactly the substrings of that text. Reading a document, the
longest match from each position on is one phrase (greedy parsing); a character the language never shows is a phrase of its
own. Phrases times log2 of the labelled length, per character, estimate the cross entropy.

Each automaton has its own alphabet. A small one is laid out as a dense transition table, with a failed step already resolved to
"end the phrase, start the next at the root"; a larger one as sorted keys of its transitions. Many stretches of text then advance
one character per numpy operation. Languages are parsed in groups of bounded memory; what goes from group to group is the best
language, its rate, and the sum of all weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsforge.llm.common import identified, kept_in_worker, release
from obsforge.session import written

UNDETERMINED = "und"
# Bounds of the labelled sample: documents a language, characters taken from the middle of each.
SAMPLE_DOCUMENTS = 192
SAMPLE_CHARACTERS = 256
# A table of more cells (of 4 bytes) is kept as sorted transitions; bytes of all automata that a worker parses with at once.
DENSE_CELLS = 1 << 23
GROUP_BYTES = 256 << 20
# A document is parsed in stretches of this many characters; a phrase ends with its stretch in every language alike.
STRETCH = 512
STEP_CHARACTERS = 1 << 20

_END = np.int32(1 << 30)  # marks a transition that ends a phrase


@lru_cache(maxsize=1)
def _character_tables() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: its lower-case code point (0x20 for anything but a letter), and whether it is a letter."""
    letters = np.zeros(0x110000, dtype=bool)
    lower = np.full(0x110000, 0x20, dtype=np.int32)
    for c in chain(range(0xD800), range(0xE000, 0x110000)):
        character = chr(c)
        if character.isalpha():
            letters[c] = True
            small = character.lower()
            lower[c] = ord(small) if len(small) == 1 else c
    return lower, letters


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)


def folded(text: str) -> np.ndarray:
    """Code points in lower case; each run of other characters than letters is one space."""
    points = _character_tables()[0][_code_points(text)]
    keep = np.ones(len(points), dtype=bool)
    keep[1:] = (points[1:] != 0x20) | (points[:-1] != 0x20)
    return points[keep]


def transitions(symbols: list[int]) -> list[dict[int, int]]:
    """For each state of the suffix automaton the state that follows by each symbol; 0 is the root, to which nothing leads back."""
    following: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in symbols:
        current = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and symbol not in following[state]:
            following[state][symbol] = current
            state = link[state]
        if state >= 0:
            target = following[state][symbol]
            if length[state] + 1 == length[target]:
                link[current] = target
            else:
                clone = len(following)
                following.append(dict(following[target]))
                length.append(length[state] + 1)
                link.append(link[target])
                while state >= 0 and following[state].get(symbol) == target:
                    following[state][symbol] = clone
                    state = link[state]
                link[target] = link[current] = clone
        last = current
    return following


def suffix_automaton(symbols: list[int], width: int) -> np.ndarray:
    """Transition table [state, symbol] of the suffix automaton; 0 is the root and also "no transition"."""
    following = transitions(symbols)
    table = np.zeros((len(following), width), dtype=np.int32)
    for state, out in enumerate(following):
        table[state, list(out)] = list(out.values())
    return table


class _Automaton:
    """The automaton of one language; symbol 0 stands for every character the language does not show."""

    def __init__(self, parts: list[np.ndarray]):
        self.shown = np.unique(np.concatenate([*parts, np.zeros(0, dtype=np.int32)]))
        self.width = len(self.shown) + 1
        # Symbol 0 separates the sampled texts; no transition reads it, so no match crosses a border.
        symbols = [s for part in parts for s in [0, *(np.searchsorted(self.shown, part) + 1).tolist()]]
        self.bits = np.log2(max(2, len(symbols)))
        following = transitions(symbols)
        for out in following:
            out.pop(0, None)
        self.fresh = np.zeros(self.width, dtype=np.int32)
        self.fresh[list(following[0])] = list(following[0].values())
        self.fresh |= _END
        sizes = np.array([len(out) for out in following])
        keys = np.repeat(np.arange(len(following), dtype=np.int64) * self.width, sizes) + np.array([s for out in following for s in out], dtype=np.int64)
        targets = np.array([t for out in following for t in out.values()], dtype=np.int32)
        self.table = None
        if 2 * len(symbols) * self.width <= DENSE_CELLS:
            self.table = np.tile(self.fresh, len(following))
            self.table[keys] = targets
        else:
            order = np.argsort(keys)
            self.keys, self.targets = keys[order], targets[order]

    def step(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The next state of each; _END is added where a phrase ended before it."""
        if self.table is not None:
            return self.table[state * self.width + symbol]
        key = state.astype(np.int64) * self.width + symbol
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.targets[at], self.fresh[symbol])


class CrossParser:
    """Automata of some languages, each over its own alphabet."""

    def __init__(self, samples: dict[str, list[str]]):
        self.languages = sorted(samples)
        self.automata = [_Automaton([folded(t) for t in sorted(samples[language])]) for language in self.languages]
        self.bits = [a.bits for a in self.automata]
        # Characters that any language shows are numbered from 1; each language has its symbol for every number.
        shown = np.unique(np.concatenate([a.shown for a in self.automata] or [np.zeros(0, dtype=np.int32)]))
        self.number = np.zeros(0x110000, dtype=np.int32)
        self.number[shown] = np.arange(1, len(shown) + 1)
        self.symbols = []
        for automaton in self.automata:
            symbol = np.zeros(len(shown) + 1, dtype=np.int32)
            symbol[self.number[automaton.shown]] = np.arange(1, automaton.width)
            self.symbols.append(symbol)

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrase counts [text, language] of folded texts."""
        owner = [i for i, t in enumerate(texts) for _ in range(0, len(t), STRETCH)]
        counts = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        if not owner:
            return counts
        parts = [t[at : at + STRETCH] for t in texts for at in range(0, len(t), STRETCH)]
        lengths = np.array([len(p) for p in parts])
        order = np.argsort(-lengths, kind="stable")
        width = int(lengths.max())
        grid = np.zeros((width, len(parts)), dtype=np.int32)
        for column, at in enumerate(order):
            grid[: lengths[at], column] = self.number[parts[at]]
        active = np.searchsorted(-lengths[order], -np.arange(width), side="left")
        owners = np.array(owner)[order]
        for k, automaton in enumerate(self.automata):
            read = self.symbols[k][grid]
            state = np.zeros(len(parts), dtype=np.int32)
            ended = np.ones(len(parts), dtype=np.int64)
            for t in range(width):
                n = active[t]
                step = automaton.step(state[:n], read[t, :n])
                ended[:n] += step >> 30
                state[:n] = step & (_END - 1)
            # From the root even the first character that is not shown counted as the end of a phrase.
            np.add.at(counts[:, k], owners, ended)
        return counts

    def rates(self, texts: list[str | None]) -> np.ndarray:
        """Bits per character [text, language]; infinite for a text without a letter."""
        letters = _character_tables()[1]
        parts = [folded(t or "") for t in texts]
        readable = np.array([bool(t) and bool(letters[_code_points(t)].any()) for t in texts], dtype=bool)
        rate = self.phrases(parts) * np.array(self.bits) / np.maximum(1, [len(p) for p in parts])[:, None]
        rate[~readable] = np.inf
        return rate


def _parser(samples: tuple[tuple[str, tuple[str, ...]], ...]) -> CrossParser:
    return kept_in_worker(("languages", samples), lambda: CrossParser({language: list(texts) for language, texts in samples}))


def _groups(model: tuple[tuple[str, tuple[str, ...]], ...]) -> list[tuple[tuple[str, tuple[str, ...]], ...]]:
    """The languages in order, in groups whose automata take at most GROUP_BYTES, or of one language."""
    groups, held = [], 0
    for language, texts in model:
        characters, letters = sum(map(len, texts)) + len(texts), len(set().union(*texts)) + 1
        cells = 2 * characters * letters
        size = 36 * characters + (4 * cells if cells <= DENSE_CELLS else 0)
        if not groups or held + size > GROUP_BYTES:
            groups.append([])
            held = 0
        groups[-1].append((language, texts))
        held += size
    return [tuple(g) for g in groups]


def train(labelled: DataFrame) -> tuple[tuple[str, tuple[str, ...]], ...]:
    """The model: sampled texts of each language, from (doc_id, text, lang).

    At most SAMPLE_DOCUMENTS documents a language, drawn by a hash of doc_id and combined before the shuffle; of each, up to
    SAMPLE_CHARACTERS characters around the middle of the text. Rows without language or text teach nothing.
    """
    half = F.greatest(F.lit(1), (F.length("text") / 2).cast("int") - SAMPLE_CHARACTERS // 2)
    drawn = F.xxhash64("doc_id")
    part = F.substring("text", half, F.lit(SAMPLE_CHARACTERS))
    rows = identified(labelled, "text", "lang").where("lang IS NOT NULL AND length(text) > 0")
    rows = rows.select("lang", F.pmod(drawn, F.lit(SAMPLE_DOCUMENTS)).alias("place"), F.struct(drawn.alias("h"), part.alias("part")).alias("one"))
    chosen = rows.groupBy("lang", "place").agg(F.min("one").alias("one")).select("lang", "one.part")
    samples: dict[str, list[str]] = {}
    for row in chosen.toLocalIterator():  # at most SAMPLE_DOCUMENTS short rows a language
        samples.setdefault(row["lang"], []).append(row["part"])
    return tuple((language, tuple(sorted(samples[language]))) for language in sorted(samples))


def identify(docs: DataFrame, model: tuple[tuple[str, tuple[str, ...]], ...]) -> DataFrame:
    """doc_id, lang_pred, score for every row of (doc_id, text, any other columns).

    Null text and text without a letter give `und` with score 0; so does every text if the model has no language. Ties go to
    the first language by name. Repeated rows repeat their result; an empty table gives none. Whole texts are read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = identified(docs, "text").select("doc_id", "text", F.lit(None).cast("string").alias("best"), F.lit(float("inf")).alias("rate"), F.lit(0.0).alias("weight"))
    groups = _groups(model)
    for i, group in enumerate(groups):
        last = i + 1 == len(groups)
        rows = rows.mapInArrow(_compared(group, last), f"doc_id {kind}, {'' if last else 'text string, '}best string, rate double, weight double")
        if not last:
            rows = written(rows, "languages")
    known = F.col("best").isNotNull()
    return rows.select("doc_id", F.coalesce("best", F.lit(UNDETERMINED)).alias("lang_pred"), F.when(known, 1 / F.col("weight")).otherwise(F.lit(0.0)).alias("score"))


def _compared(group: tuple[tuple[str, tuple[str, ...]], ...], last: bool):
    """The best language so far, its rate, and the sum of 2^(best rate - rate) over the languages, after those of `group`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(group)
        names = np.array(parser.languages, dtype=object)
        for batch in batches:
            texts = batch.column(1)
            a = 0
            while a < len(batch):
                b, held, chosen = a, 0, []
                while b < len(batch) and (not chosen or held < STEP_CHARACTERS):
                    chosen.append(texts[b].as_py())
                    held += len(chosen[-1] or "")
                    b += 1
                part = batch.slice(a, b - a)
                rate = parser.rates(chosen)
                before = part.column(3).to_numpy(zero_copy_only=False)
                least = np.minimum(before, rate.min(axis=1))
                told = np.isfinite(least)
                base = np.where(told, least, 0.0)
                weight = part.column(4).to_numpy(zero_copy_only=False) * np.exp2(base - before) + np.exp2(base[:, None] - rate).sum(axis=1)
                best = np.array(part.column(2).to_pylist(), dtype=object)
                better = told & (least < before)
                best[better] = names[rate.argmin(axis=1)[better]]
                columns = [part.column(0), part.column(1), pa.array(best.tolist(), pa.string()), pa.array(least), pa.array(weight)]
                names_of = ["doc_id", "text", "best", "rate", "weight"]
                kept = [0, 2, 3, 4] if last else range(5)
                yield pa.RecordBatch.from_arrays([columns[k] for k in kept], [names_of[k] for k in kept])
                a = b
            release()

    return run
