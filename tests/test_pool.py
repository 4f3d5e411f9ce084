"""The pool in stretches: each row once, in order, whatever is late, repeated or lost, and only open stretches are read."""

import datetime
import random
import shutil

import pytest
from pyspark.sql import functions as F

from obsforge.operators import feed
from obsforge.operators.pool import NANS, NULLS, Pool, consume, stretch_of

SCHEMA = "k int, v string, x double"


def order(row):
    return (row[0] is not None, row[0] or 0)


def test_taken_in_order_against_a_plain_list(spark, tmp_path):
    """Random appends and batches: every batch is the head of what a sorted list still holds."""
    rng = random.Random(3)
    pool, state = Pool(spark, str(tmp_path / "pool"), ["k"], 5), str(tmp_path / "state")
    left, batch = [], 0
    for append in range(4):
        rows = [(rng.choice([None, *range(-12, 40)]), rng.choice("ab"), float(rng.randrange(3))) for _ in range(rng.randrange(5, 40))]
        pool.append(spark.createDataFrame(rows, SCHEMA), append)
        pool.append(spark.createDataFrame(rows, SCHEMA), append)
        left += rows
        for n in (1, rng.randrange(2, 15)):
            got = [tuple(r) for r in consume(pool, state, batch, n).collect()]
            again = [tuple(r) for r in consume(pool, state, batch, n + 3).collect()]
            assert sorted(map(repr, got)) == sorted(map(repr, again)) and len(got) == min(n, len(left))
            assert sorted(map(order, got)) == sorted(map(order, left))[:n]
            for row in got:
                left.remove(row)
            batch += 1
    rest = consume(pool, state, batch, 1000).collect()
    assert sorted(map(repr, map(tuple, rest))) == sorted(map(repr, left))
    with pytest.raises(ValueError, match="empty"):
        consume(pool, state, batch + 1)
    assert not pool.progress(state).where("open OR n_pool <> n_consumed").count()
    taken = feed.committed(spark, state).select("k", "v", "x")
    whole = pool.rows().select("k", "v", "x")
    assert taken.exceptAll(whole).isEmpty() and whole.exceptAll(taken).isEmpty()


def folders(df):
    return sorted({part.split("=")[1] for f in df.inputFiles() for part in f.split("/") if part.startswith("stretch=")}, key=int)


def test_only_stretches_whose_counter_differs_are_read(spark, tmp_path):
    pool, state = Pool(spark, str(tmp_path / "pool"), ["k"], 10), str(tmp_path / "state")
    pool.append(spark.createDataFrame([(i, "a", 0.0) for i in range(100)], SCHEMA), 0)
    consume(pool, state, 0, 35)
    assert [r["stretch"] for r in pool.progress(state).where("open").orderBy("stretch").collect()] == [3, 4, 5, 6, 7, 8, 9]
    assert pool.wanted(state, 5) == [(3, True)] and pool.wanted(state, 6) == [(3, True), (4, False)]
    assert folders(pool.pending(state, 6)) == ["3", "4"]
    pool.append(spark.createDataFrame([(11, "late", 0.0), (None, "late", 0.0)], SCHEMA), 1)
    assert pool.wanted(state, 2) == [(NULLS, False), (1, True)]
    waiting = pool.pending(state, 3)
    assert folders(waiting) == [str(NULLS), "1", "3"]
    assert [r["v"] for r in consume(pool, state, 1, 2).collect()] == ["late", "late"]
    assert pool.wanted(state, 1) == [(3, True)]


def test_equal_rows_are_told_apart_by_their_number(spark, tmp_path):
    pool, state = Pool(spark, str(tmp_path / "pool"), ["k"]), str(tmp_path / "state")
    pool.append(spark.createDataFrame([(1, "a", 0.0)] * 5 + [(1, None, None)], SCHEMA), 0)
    assert consume(pool, state, 0, 2).count() == 2
    pool.append(spark.createDataFrame([(1, "a", 0.0)], SCHEMA), 1)
    assert consume(pool, state, 1, 4).count() == 4
    assert consume(pool, state, 2, 9).count() == 1


def test_appends_and_batches_without_record_do_not_count(spark, tmp_path):
    path, state = str(tmp_path / "pool"), str(tmp_path / "state")
    pool = Pool(spark, path, ["k"])
    with pytest.raises(ValueError, match="empty"):
        consume(pool, state, 0)
    pool.append(spark.createDataFrame([(1, "a", 0.0), (2, "b", 0.0)], SCHEMA), 0)
    pool.append(spark.createDataFrame([(0, "lost", 0.0)], SCHEMA), 1)
    shutil.rmtree(f"{path}/counters/append_id=1")
    assert [r["v"] for r in consume(pool, state, 0).collect()] == ["a"]
    pool.append(spark.createDataFrame([(0, "found", 0.0)], SCHEMA), 1)
    assert [r["v"] for r in consume(pool, state, 1).collect()] == ["found"]
    shutil.rmtree(f"{state}/commits/batch_id=1")
    assert [r["v"] for r in consume(pool, state, 2).collect()] == ["found"]
    assert feed.committed(spark, state).count() == 2


def test_rows_that_share_the_last_key_can_come_along(spark, tmp_path):
    pool, state = Pool(spark, str(tmp_path / "pool"), ["k", "v"]), str(tmp_path / "state")
    pool.append(spark.createDataFrame([(1, "a", 0.0), (1, "a", 1.0), (1, "b", 2.0)], SCHEMA), 0)
    assert consume(pool, state, 0, 1, whole_keys=True).count() == 2
    assert [r["v"] for r in consume(pool, state, 1).collect()] == ["b"]


def test_empty_append_and_other_column_order(spark, tmp_path):
    pool, state = Pool(spark, str(tmp_path / "pool"), ["k"]), str(tmp_path / "state")
    pool.append(spark.createDataFrame([], SCHEMA), 0)
    with pytest.raises(ValueError, match="empty"):
        consume(pool, state, 0)
    pool.append(spark.createDataFrame([(1, "a", 0.0)], SCHEMA), 1)
    pool.append(spark.createDataFrame([("b", 2, 0.0)], "v string, k int, x double"), 2)
    assert [(r["k"], r["v"]) for r in consume(pool, state, 0, 2).orderBy("k").collect()] == [(1, "a"), (2, "b")]


@pytest.mark.parametrize(
    "kind, width, values",
    [
        ("int", 7, [None, -20, -7, -1, 0, 1, 6, 7, 100]),
        ("decimal(10,2)", 0.5, [None, "-3.00", "0.00", "0.49", "0.50", "99.99"]),
        ("double", 2.5, [None, float("-inf"), -3.0, -0.0, 0.0, 2.5, 1e300, float("inf"), float("nan")]),
        ("date", 10, [None, datetime.date(1969, 12, 1), datetime.date(1970, 1, 1), datetime.date(2020, 2, 29)]),
        ("timestamp", 1, [None, datetime.datetime(1960, 1, 1, 5), datetime.datetime(2020, 1, 1), datetime.datetime(2020, 1, 1, 23, 59, 59, 999999), datetime.datetime(2020, 1, 2)]),
        ("timestamp_ntz", 1, [None, datetime.datetime(1960, 1, 1, 5), datetime.datetime(2020, 1, 1), datetime.datetime(2020, 1, 2)]),
        ("string", 3, [None, "", "\x01", "a", "abc", "abcd", "abd", "b", "é", "日本", "\U0001d49c"]),
    ],
)
def test_stretches_never_fall_as_the_key_grows(spark, kind, width, values):
    source = "string" if kind.startswith("decimal") else kind
    df = spark.createDataFrame([(v,) for v in values], f"k {source}").select(F.col("k").cast(kind))
    rows = df.select("k", stretch_of(df, "k", width).alias("s")).orderBy("k").collect()
    got = [r["s"] for r in rows]
    assert got == sorted(got) and got[0] == NULLS and None not in got
    if kind == "double":
        assert got[-1] == NANS
    if kind == "string":
        assert len(set(got)) == len(got) - 1
    with pytest.raises(ValueError):
        stretch_of(spark.createDataFrame([([1],)], "k array<int>"), "k", 1)


def test_an_append_takes_one_digest_of_each_row(spark, tmp_path, monkeypatch):
    from obsforge.operators import pool

    taken, digest = [], pool.row_fingerprint

    def counted(columns):
        taken.append(list(columns))
        return digest(columns)

    monkeypatch.setattr(pool, "row_fingerprint", counted)
    kept = pool.Pool(spark, str(tmp_path / "pool"), ["k"], 10)
    # More stretches than folders that stay open, and copies.
    kept.append(spark.range(200).selectExpr("id % 100 as k", "cast(id % 50 as double) as v"), 0)
    assert len(taken) == 1
    assert kept.rows().count() == 200 and sorted(r["n"] for r in kept.records().collect()) == [20] * 10
