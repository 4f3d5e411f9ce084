import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from obsforge.llm import importance
from obsforge.llm.importance import crc_columns, distinct_rows, document_features, importance_resampling, resampled

from .helpers import edges, frame, lower_ascii, prose


def features_of(text, longest):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text))
    return len(w), [" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


def brute(rows, target, percent=10, least_words=20, longest=1, buckets=10_000, seed=2024):
    """(n_words, n_features, weight, score, rank) of every row, in the order of the rows."""

    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [r[1] for r in rows]), (t, target)):
        for text in texts:
            for f in features_of(text, longest)[1]:
                counts[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (sum(s) + buckets) / ((s[b] + 1.0) * (sum(t) + buckets)))) for b in range(buckets)]
    out = []
    for doc_id, text in rows:
        n, found = features_of(text, longest)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[: len(able) * percent // 100], 1):
        row[5] = rank
    return sorted(map(repr, out))


def got(result):
    return sorted(repr([r[c] for c in ("doc_id", "n_words", "n_features", "weight", "score", "rank")]) for r in result.collect())


def texts():
    rows = [(r[0], r[1]) for r in edges()]
    rng = random.Random(3)
    rows += [(100 + i, prose(i, rng.randrange(1, 90)) + rng.choice(["", " Word-Part_x9", " ÉTÉ é日本", "\x00null\x7f"])) for i in range(150)]
    target = [prose(i, 60) for i in range(5)] + [None, "", "word part x9"]
    return rows, target


def bench(spark, target):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(target)], "item_id long, text string, bucket string")


@pytest.mark.parametrize("parameters", [{}, {"longest": 3, "buckets": 97, "percent": 35, "least_words": 5, "seed": 1}])
def test_ranks_against_brute_force(spark, monkeypatch, parameters):
    monkeypatch.setattr(importance, "RANKED_ROWS", 20)  # many ranges, as in a large table
    monkeypatch.setattr(importance, "STEP", 1000)
    rows, target = texts()
    assert got(importance_resampling(frame(spark, rows), bench(spark, target), **parameters)) == brute(rows, target, **parameters)


def test_equal_scores_are_ranked_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(importance, "RANKED_ROWS", 10)
    rows = [(None, prose(1, 30))] * 60 + [(i % 20, prose(1, 30)) for i in range(60)]
    result = importance_resampling(frame(spark, rows), bench(spark, ["a b"]), percent=100)
    assert got(result) == brute(rows, ["a b"], percent=100)
    assert sorted(r["rank"] for r in result.collect()) == list(range(1, 121))


def test_empty_tables(spark):
    assert importance_resampling(frame(spark, []), bench(spark, ["a"])).count() == 0
    rows = [(1, prose(1, 40)), (2, None)] * 10
    assert got(importance_resampling(frame(spark, rows), bench(spark, []))) == brute(rows, [])
    assert resampled(frame(spark, [(1, "short")]), bench(spark, ["a"])).count() == 0


def test_drawn_rows_keep_their_columns(spark):
    rows, target = texts()
    docs = frame(spark, rows)
    drawn = resampled(docs, bench(spark, target), percent=20)
    assert drawn.columns == docs.columns
    ranks = importance_resampling(docs, bench(spark, target), percent=20).where("rank IS NOT NULL").collect()
    assert sorted(str(r["doc_id"]) for r in drawn.collect()) == sorted(str(r["doc_id"]) for r in ranks)
    by_id = dict(rows)
    assert all(r["text"] == by_id[r["doc_id"]] for r in drawn.collect() if r["doc_id"] is not None)


def test_crc_of_byte_matrices():
    rng = np.random.default_rng(1)
    for length in (1, 2, 7, 8, 9, 16, 33, 700):
        rows = rng.integers(0, 256, (50, length), dtype=np.uint8)
        assert crc_columns(rows).tolist() == [zlib.crc32(r.tobytes()) for r in rows]


def test_features_that_share_a_key_stay_apart(monkeypatch):
    monkeypatch.setattr(importance, "mixed", lambda x: x * np.uint64(0))
    rows = np.frombuffer(b"firsttaillongfirsttaillong" + b"other-taillong" [1:], dtype=np.uint8).reshape(3, 13)
    first, of = distinct_rows(rows)
    assert np.array_equal(rows[first][of], rows)


def test_runs_do_not_cross_documents():
    data = b"ab cd" + b"ef" + b"" + b"--gh ij kl"
    count, found = document_features(np.frombuffer(data, dtype=np.uint8), np.array([0, 5, 7, 7, 17]), 3, 2**32)
    assert count.tolist() == [2, 1, 0, 3]
    expected = [[b"ab", b"cd", b"ef", b"gh", b"ij", b"kl"], [b"ab cd", b"gh ij", b"ij kl"], [b"gh ij kl"]]
    assert [f.tolist() for f, _ in found] == [[zlib.crc32(x) for x in e] for e in expected]
    assert [b.tolist() for _, b in found] == [[0, 2, 3, 3, 6], [0, 1, 1, 1, 3], [0, 0, 0, 0, 1]]
