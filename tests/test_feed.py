"""Feed and stream: each row once, whatever is repeated, lost or late."""

import datetime
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obsforge.operators import feed
from obsforge.sources import tables
from obsforge.streaming import arrivals

KEYS = ["d", "p"]


@pytest.fixture()
def pool(spark):
    rows = [(datetime.date(2014, 1, 1 + i // 3), "abc"[i % 3], float(i)) for i in range(12)]
    return spark.createDataFrame(rows, "d date, p string, x double").repartition(3)


def test_drains_each_row_once(spark, pool, tmp_path):
    state = str(tmp_path / "state")
    for batch in range(4):
        first = feed.consume(spark, pool, state, batch, KEYS, 3)
        again = feed.consume(spark, pool, state, batch, KEYS, 3)
        assert first.count() == 3 and first.exceptAll(again).isEmpty()
    taken = feed.committed(spark, state)
    assert sorted(r["x"] for r in taken.collect()) == [float(i) for i in range(12)]
    assert [r["batch_id"] for r in taken.orderBy("x").collect()] == [i // 3 for i in range(12)]
    with pytest.raises(ValueError, match="empty"):
        feed.consume(spark, pool, state, 4, KEYS)


def test_late_rows_are_taken(spark, pool, tmp_path):
    state = str(tmp_path / "state")
    feed.consume(spark, pool.where("x <> 1"), state, 0, KEYS, 3)
    assert [r["x"] for r in feed.consume(spark, pool, state, 1, KEYS).collect()] == [1.0]
    assert [r["x"] for r in feed.consume(spark, pool, state, 2, KEYS).collect()] == [4.0]


def test_rows_without_commit_do_not_count(spark, pool, tmp_path):
    state = str(tmp_path / "state")
    feed.consume(spark, pool, state, 0, KEYS)
    pool.where("x in (1, 5)").write.parquet(f"{state}/rows/batch_id=1")
    assert feed.committed(spark, state).count() == 1
    assert [r["x"] for r in feed.consume(spark, pool, state, 1, KEYS).collect()] == [1.0]
    assert feed.committed(spark, state).count() == 2


def test_exactly_n_rows_of_one_key(spark, tmp_path):
    pool = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (1, "b"), (2, "c"), (None, "d"), (None, None)], "k int, v string")
    state = str(tmp_path / "state")
    taken = [[(r["k"], r["v"]) for r in feed.consume(spark, pool, state, batch, ["k"], 2).collect()] for batch in range(4)]
    assert list(map(len, taken)) == [2, 2, 2, 1]
    assert {r[0] for r in taken[0]} == {None} and {r[0] for r in taken[1]} == {1}
    whole = feed.committed(spark, state).select("k", "v")
    assert whole.exceptAll(pool).isEmpty() and pool.exceptAll(whole).isEmpty()
    with pytest.raises(ValueError, match="empty"):
        feed.consume(spark, pool, state, 4, ["k"])


def test_late_copies_and_null_keys_are_kept(spark, tmp_path):
    schema, state = "k int, v string", str(tmp_path / "state")
    pool = spark.createDataFrame([(None, "n"), (1, "a"), (2, "b"), (3, "c")], schema)
    assert feed.consume(spark, pool, state, 0, ["k"], 3).count() == 3
    late = pool.unionByName(spark.createDataFrame([(1, "a"), (1, "z"), (None, "n")], schema))
    assert feed.late_rows(late, feed.committed(spark, state), ["k"], feed.high_water(feed.read_or_none(spark, f"{state}/commits"), ["k"])).count() == 3
    rows = [r for batch in (1, 2) for r in feed.consume(spark, late, state, batch, ["k"], 2).collect()]
    assert sorted((str(r["k"]), r["v"]) for r in rows) == [("1", "a"), ("1", "z"), ("3", "c"), ("None", "n")]
    assert feed.pending(late, feed.committed(spark, state), ["k"]).isEmpty()


def test_rows_that_share_the_last_key_can_come_along(spark, tmp_path):
    pool = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    state = str(tmp_path / "state")
    assert feed.consume(spark, pool, state, 0, ["k"], whole_keys=True).count() == 2
    assert [r["v"] for r in feed.consume(spark, pool, state, 1, ["k"]).collect()] == ["c"]


def test_a_batch_reads_the_pool_from_the_mark_on(spark, pool, tmp_path, capsys):
    path, state = str(tmp_path / "pool"), str(tmp_path / "state")
    pool.write.parquet(path)
    stored = spark.read.parquet(path)
    feed.consume(spark, stored, state, 0, KEYS, 4)
    mark = feed.high_water(feed.read_or_none(spark, f"{state}/commits"), KEYS)
    assert mark["rows"] == 4 and mark["copies"] == 1
    feed._beyond(stored, KEYS, mark).explain()
    assert "GreaterThanOrEqual(d,2014-01-02)" in capsys.readouterr().out


def test_large_batches_use_the_rank_search(spark, pool, tmp_path, monkeypatch):
    monkeypatch.setattr(feed, "TOP_ROWS", 0)
    assert sorted(r["x"] for r in feed.take_next(pool, None, KEYS, 5).collect()) == [0, 1, 2, 3, 4]


def test_large_batches_share_out_copies(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(feed, "TOP_ROWS", 0)
    pool = spark.createDataFrame([(i // 9, "ab"[i % 2]) for i in range(40)], "k int, v string")
    state = str(tmp_path / "state")
    for batch in range(6):
        assert feed.consume(spark, pool, state, batch, ["k"], 7).count() == min(7, 40 - 7 * batch)
    taken = feed.committed(spark, state).select("k", "v")
    assert taken.exceptAll(pool).isEmpty() and pool.exceptAll(taken).isEmpty()


def test_invariants_and_report(spark, pool, tmp_path):
    state = str(tmp_path / "state")
    feed.consume(spark, pool, state, 0, KEYS, 2)
    feed.consume(spark, pool, state, 1, KEYS, 1)
    taken = feed.committed(spark, state)
    assert feed.check_pool(pool, taken, KEYS).first().asDict() == {
        "n_pool": 12, "n_consumed": 3, "n_left": 9, "n_repeated": 0, "adds_up": True, "in_order": True,
    }
    wrong = taken.unionByName(pool.where("x = 11").withColumn("batch_id", F.lit(9)))
    assert feed.check_pool(pool, wrong, KEYS).first()["in_order"] is False
    report = feed.feed_report(taken, 12, KEYS).orderBy("batch_id").collect()
    assert [(r["rows_before"], r["rows_after"]) for r in report] == [(12, 10), (10, 9)]


def test_fingerprints(spark, pool):
    assert feed.batch_fingerprint(None) == "no_file" and feed.batch_fingerprint(pool.limit(0)) == "empty_file"
    whole = feed.batch_fingerprint(pool)
    assert whole == feed.batch_fingerprint(pool.repartition(1)) != feed.batch_fingerprint(pool.where("x > 0"))
    assert not feed.check_fresh(whole, whole) and feed.check_fresh("no_file", "no_file") and feed.check_fresh(whole, "x")


@pytest.mark.parametrize("per_bucket", [None, 3])
def test_staleness(spark, per_bucket):
    df = spark.createDataFrame([("u", i, "ab"[i // 4 % 2]) for i in range(12)], "g string, t int, f string")
    out = feed.staleness(df, "f", ["t"], ["g"], rows_per_bucket=per_bucket)
    assert sorted(r["t"] for r in out.where("changed").collect()) == [0, 4, 8]


def test_append_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "table")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    more = spark.createDataFrame([(2, "b"), (3, "c")], "k int, v string")
    tables.append_new(first, path, ["k"], 0)
    for _ in range(2):
        assert sorted(r["k"] for r in tables.append_new(more, path, ["k"], 1).collect()) == [1, 2, 3]


def test_append_knows_null_keys(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([(1, None, "a"), (None, None, "b"), (None, "x", "c")], "k int, j string, v string")
    for batch in range(3):
        assert tables.append_new(rows, path, ["k", "j"], batch).count() == 3


def write_day(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write("d,p,x\n" + "".join(f"{d},{p},{x}\n" for d, p, x in rows))


def test_stream_takes_each_key_once(spark, tmp_path):
    folder, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema, seen = StructType.fromDDL("d date, p string, x double"), []
    write_day(folder, "1.csv", [("2014-01-02", "a", 1)])
    write_day(folder, "2.csv", [("2014-01-03", "a", 2), ("2014-01-03", "a", 2)])
    run = lambda: arrivals.run_stream(
        arrivals.read_arrivals(spark, folder, schema), target, checkpoint, KEYS, lambda rows, batch: seen.append(rows.count())
    ).awaitTermination()
    run()
    write_day(folder, "3.csv", [("2014-01-02", "a", 1), ("2014-01-01", "late", "NA")])
    run()
    run()
    rows = sorted((str(r["d"]), r["p"], r["x"]) for r in arrivals.arrivals_table(spark, target).collect())
    assert rows == [("2014-01-01", "late", None), ("2014-01-02", "a", 1.0), ("2014-01-03", "a", 2.0)]
    assert seen == [1, 1, 1]
