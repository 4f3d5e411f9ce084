import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from obsforge.llm import common, near_dedup
from obsforge.llm.exact_dedup import CuckooIndex, build_index, digests, exact_duplicates, remove
from obsforge.llm.graph import components as connected
from obsforge.llm.near_dedup import least_matches, near_duplicates
from obsforge.llm.substring_dedup import without_repeats

from .helpers import BLANKS, components, edges, frame, prose, shingles, words_of


def test_cuckoo_index_inserts_deletes_and_resizes():
    rng, index, live = random.Random(5), CuckooIndex(16, bits=6), {}
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    before = index.groups
    for step in range(20_000):
        key = rng.choice(keys)
        if rng.random() < 0.6:
            index.insert(key, (step,))
            live[key] = (step,)
        else:
            assert index.delete(key) == (live.pop(key, None) is not None)
    assert index.store == live and index.groups > before
    assert all(index.get(k) == live.get(k) for k in keys)
    assert sum(1 for x in index.table if x) == len(live)


def brute_exact(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault("".join(c for c in text or "" if c not in BLANKS), []).append((i, len(text or "")))
    out = []
    for i, text in rows:
        key = "".join(c for c in text or "" if c not in BLANKS)
        best = max(groups[key], key=lambda g: (g[1], g[0] is not None, -(g[0] or 0)))[0]
        out.append((i, best, len(groups[key]), i == best, hashlib.sha256(key.encode()).hexdigest()))
    return out


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_exact_duplicates_of_edge_cases(spark):
    rows = edges()
    assert as_rows(exact_duplicates(frame(spark, rows))) == sorted(brute_exact(rows), key=repr)
    assert exact_duplicates(frame(spark, [])).count() == 0


def test_exact_duplicates_with_a_hot_group(spark):
    rows = [(i, "same text" if i % 3 else prose(i // 2, 5)) for i in range(3000)]
    assert as_rows(exact_duplicates(frame(spark, rows))) == sorted(brute_exact(rows), key=repr)


def test_index_removal(spark):
    rows = [(i, prose(i % 40, 6)) for i in range(100)]
    marked = digests(frame(spark, rows))
    index = build_index(marked, bucket_digests=16)
    gone = digests(frame(spark, [(500, prose(3, 6)), (501, "unknown")]))
    left = remove(index, gone, bucket_digests=16)
    assert index.count() == 40 and left.count() == 39
    assert left.join(gone, "digest", "left_semi").count() == 0


def test_connected_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(0, 60)] + [(100 + rng.randrange(50), 100 + rng.randrange(50)) for _ in range(30)] + [(7, 7), (200, 300)]
    parent = {n: n for link in links for n in link}

    def find(n):
        return n if parent[n] == n else find(parent[n])

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    loops = {a for a, b in links if a == b} - {n for a, b in links if a != b for n in (a, b)}
    expected = {(n, find(n)) for n in parent if n not in loops}
    assert {tuple(r) for r in connected(spark.createDataFrame(links, "x long, y long")).collect()} == expected
    assert connected(spark.createDataFrame([], "x long, y long")).count() == 0


def test_posterior_bound_keeps_similar_pairs():
    rng = np.random.default_rng(0)
    for n in (72, 144, 288):
        least = least_matches(n, 0.8, 1e-6)
        assert 0.4 * n < least < 0.8 * n
        assert (rng.binomial(n, 0.8, 100_000) >= least).all()


def varied(base, rng, changes):
    words = base.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = prose(rng.randrange(10**6), 1)
    return " ".join(words)


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_against_all_pairs(spark, size):
    rng = random.Random(size)
    texts = [r[1] for r in edges()]
    for family in range(6):
        base = prose(1000 + family, 90)
        texts += [base, *(varied(base, rng, k % 9) for k in range(12))]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    got = {r["doc_id"]: r for r in near_duplicates(frame(spark, rows), words=size).collect()}
    sets = [shingles(t, size) for t in texts]
    expected = components(sets)
    for i, s in enumerate(sets):
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (len(s), expected[i], expected[i] == i)


def test_near_duplicates_in_blocks_and_without_rows(spark, monkeypatch):
    rng = random.Random(11)
    base = prose(5, 100)
    texts = [base, *(varied(base, rng, k % 16) for k in range(120))]
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(frame(spark, list(enumerate(texts))), words=2).collect()}
    assert [got[i] for i in range(len(texts))] == components([shingles(t, 2) for t in texts])
    assert near_duplicates(frame(spark, [])).count() == 0


@pytest.mark.parametrize("n", range(7))
def test_steps_of_few_words(spark, n):
    text = " ".join("abcdef"[:n])
    sets = near_dedup.shingle_sets(*common.utf8(pa.array([text])), 5)
    assert [len(s) for s in sets] == [len(shingles(text, 5))]
    got = near_duplicates(frame(spark, [(1, text)]).coalesce(1), words=5).collect()
    assert [(r["doc_id"], r["n_shingles"], r["kept"]) for r in got] == [(1, len(shingles(text, 5)), True)]


def test_near_duplicates_by_shuffled_joins(spark, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    rows = [(i, prose(i // 3, 30) + (" end" if i % 3 else "")) for i in range(30)]
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(frame(spark, rows)).collect()}
    assert [got[i] for i in range(30)] == components([shingles(t, 5) for _, t in rows])


def test_documents_without_id_take_part(spark):
    got = near_duplicates(frame(spark, [(None, prose(1, 40)), (7, prose(1, 40)), (None, prose(2, 40)), (None, None)]), words=2).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in got) == [("7", "7", True), ("None", "7", False), ("None", "None", True), ("None", "None", True)]


def brute_repeats(rows, window):
    first = {}
    for i, text in rows:
        w = words_of(text)
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, text in rows:
        w = words_of(text)
        gone = set()
        for p in range(len(w) - window + 1):
            if i is not None and first[tuple(w[p : p + window])] < i:
                gone.update(range(p, p + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def passages(window):
    rng = random.Random(window)
    shared = [prose(70 + k, window + 3 * k).split() for k in range(5)]
    rows = [r for r in edges() if r[0] not in (12, 13, 16)]
    for i in range(100, 160):
        words = prose(i, rng.randrange(5, 120)).split()
        for _ in range(rng.randrange(3)):
            part, at = rng.choice(shared), rng.randrange(len(words) + 1)
            cut = rng.choice([0, 0, 1, 2, 5])
            words[at:at] = part[cut:] if rng.random() < 0.5 else part
        rows.append((i, rng.choice([" ", "\n", "  "]).join(words)))
    rows.append((200, " ".join(["again"] * 300)))
    rows.append((201, " ".join(["again"] * 100)))
    return rows


@pytest.mark.parametrize("window", [50, 12])
def test_repeated_passages_against_all_windows(spark, window):
    rows = passages(window)
    got = without_repeats(frame(spark, rows), window, with_text=True)
    assert as_rows(got) == sorted(brute_repeats(rows, window), key=repr)
    assert without_repeats(frame(spark, []), window).count() == 0


def test_repeated_passages_with_a_full_bitmap(spark, monkeypatch):
    monkeypatch.setattr(common, "BITMAP_WORDS", 1)
    rows = passages(12)
    assert as_rows(without_repeats(frame(spark, rows), 12, with_text=True)) == sorted(brute_repeats(rows, 12), key=repr)
