"""Distributed building blocks against brute force; small limits force the paths that large tables take."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsforge.operators import split
from obsforge.plans import ranks
from obsforge.plans.ordered import neighbours, running_before
from obsforge.plans.ranks import exact_quantiles, key_at_rank, precedes, repeated


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(5)
    # Group "hot" holds most rows.
    rows = [(("hot" if rng.random() < 0.7 else f"g{rng.randrange(4)}"), i, rng.randrange(100)) for i in range(600)]
    return spark.createDataFrame(rows, "g string, t int, v int").repartition(7), rows


@pytest.mark.parametrize("per_bucket", [None, 40])
def test_running_before(series, per_bucket):
    df, rows = series
    out = running_before(df, ["t"], {"s": F.col("v")}, {"m": F.col("v")}, ["g"], rows=600, rows_per_bucket=per_bucket)
    got = {r["t"]: (r["s"], r["m"]) for r in out.collect()}
    sums, maxima = {}, {}
    for g, t, v in sorted(rows, key=lambda r: r[1]):
        assert got[t] == (sums.get(g, 0), maxima.get(g))
        sums[g], maxima[g] = sums.get(g, 0) + v, max(v, maxima.get(g, v))


@pytest.mark.parametrize("per_bucket", [None, 40])
@pytest.mark.parametrize("following", [False, True])
def test_neighbours(series, per_bucket, following):
    df, rows = series
    out = neighbours(df, ["t"], {"near": F.col("v")}, ["g"], following, rows=600, rows_per_bucket=per_bucket)
    got = {r["t"]: r["near"] for r in out.collect()}
    last = {}
    for g, t, v in sorted(rows, key=lambda r: r[1], reverse=following):
        assert got[t] == last.get(g)
        last[g] = v


def test_running_without_group(series):
    df, rows = series
    out = running_before(df, ["t"], {"s": F.lit(1)}, rows=600, rows_per_bucket=50)
    assert {r["t"]: r["s"] for r in out.collect()} == {t: t for _, t, _ in rows}


@pytest.mark.parametrize("small", [10_000, 3])
def test_exact_quantiles(spark, small):
    rng = random.Random(1)
    columns = {
        "uniform": [rng.random() for _ in range(3000)],
        "hot": [7.0 if rng.random() < 0.4 else rng.gauss(0, 1e6) for _ in range(3000)],
        "gaps": [None if rng.random() < 0.3 else rng.expovariate(1) for _ in range(3000)],
        "few": [float(rng.randrange(5)) for _ in range(3000)],
        "nan": [float("nan") if rng.random() < 0.1 else rng.random() for _ in range(3000)],
        "empty": [None] * 3000,
    }
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns)).repartition(5)
    probs = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = exact_quantiles(df, list(columns), probs, small=small)
    for c, values in columns.items():
        known = [v for v in values if v is not None and v == v]
        for p in probs:
            expected = np.quantile(known, p) if known else None
            assert found[(c, p)] == (pytest.approx(expected, rel=1e-12) if known else None), (c, p)


def test_quantiles_survive_a_misleading_bracket(spark, monkeypatch):
    df = spark.range(2000).select(F.col("id").cast("double").alias("x"))
    start = ranks._Search("x", 0.5, 999, 1000, 1500.0, 1600.0)
    row = df.agg(*ranks._bracket_counts([start])).first()
    assert ranks._narrowed([start], row, 10) == [start] and start.low is None
    row = df.agg(*ranks._bracket_counts([start])).first()
    assert ranks._narrowed([start], row, 10) == [start] and start.low is not None


@pytest.mark.parametrize("limit", [10, 100_000])
def test_key_at_rank(spark, limit):
    rng = random.Random(3)
    keys = [("2014-01-05" if rng.random() < 0.4 else f"2014-01-{rng.randrange(1, 28):02d}", rng.randrange(10_000)) for _ in range(1500)]
    keys += [("2014-01-05", 77)] * 300
    df = spark.createDataFrame(keys, "d string, k int").repartition(6)
    ordered = sorted(keys)
    for rank in (0, 5, 400, 700, 900, 1799):
        hit = key_at_rank(df, ["d", "k"], rank, len(keys), limit)
        assert hit.key == ordered[rank]
        assert (hit.below, hit.equal) == (ordered.index(ordered[rank]), ordered.count(ordered[rank]))
        assert df.where(precedes(df, ["d", "k"], hit.key)).count() == hit.below


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_key_at_rank_of_times(spark, kind):
    df = spark.range(400).select((F.lit("2024-03-31 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id") * 7)).cast(kind).alias("t"))
    hit = key_at_rank(df, ["t"], 150, 400, 20)
    assert df.where(precedes(df, ["t"], hit.key)).count() == hit.below <= 150 < hit.below + hit.equal


MIXED = [None] * 120 + [5] * 400 + list(range(-300, 700))


@pytest.mark.parametrize("kind, accuracy", [("int", 10_000), ("long", 100), ("float", 100), ("double", 10_000), ("decimal(15,2)", 100), ("decimal(30,2)", 100), ("timestamp", 10_000), ("smallint", 100)])
def test_key_at_rank_by_a_histogram_of_the_leading_key(spark, monkeypatch, kind, accuracy):
    monkeypatch.setattr(ranks, "BRACKET_ACCURACY", accuracy)
    rows = [(v, i % 7) for i, v in enumerate(MIXED)]
    lead = F.col("v").cast("long").cast("timestamp") if kind == "timestamp" else F.col("v").cast(kind)
    if kind == "double":
        rows += [(None, 9)] * 40
        lead = F.when(F.col("k") == 9, F.lit(float("nan"))).otherwise(lead)
    df = spark.createDataFrame(rows, "v int, k int").select(lead.alias("v"), "k").repartition(5)
    ordered = [(r["v"], r["k"]) for r in df.orderBy("v", "k").select(ranks.sortable(df, "v").alias("v"), "k").collect()]
    for rank in (0, 119, 300, 900, len(rows) - 1):
        hit = key_at_rank(df, ["v", "k"], rank, len(rows), 10)
        assert repr(hit.key) == repr(ordered[rank])
        places = [i for i, key in enumerate(ordered) if repr(key) == repr(ordered[rank])]
        assert (hit.below, hit.equal) == (places[0], len(places))


def test_key_at_rank_of_large_numbers_and_one_value(spark):
    top = 2**63 - 1
    df = spark.createDataFrame([(top - i % 50,) for i in range(400)], "v long")
    assert key_at_rank(df, ["v"], 399, 400, 10).key == (top,)
    assert key_at_rank(df, ["v"], 0, 400, 10).key == (top - 49,)
    same = spark.range(300).select(F.lit(1.5).alias("v"))
    assert key_at_rank(same, ["v"], 200, 300, 10) == ranks.KeyAtRank((1.5,), 0, 300)


def pushed(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "PushedFilters" in line][0].split("PushedFilters: ")[1]


def test_rank_search_reads_little(spark, tmp_path, monkeypatch):
    start = F.to_date(F.lit("2014-01-01"))
    spark.range(4000).select(F.date_add(start, (F.col("id") % 40).cast("int")).alias("d"), (F.col("id") * 7 % 1000).alias("n")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plans = []
    tally = ranks._tally
    monkeypatch.setattr(ranks, "_tally", lambda *asked: plans.append(tally(*asked)) or plans[-1])
    rest = []
    last = ranks._narrowed_key
    monkeypatch.setattr(ranks, "_narrowed_key", lambda rows, *more: rest.append(rows) or last(rows, *more))
    # A date and ties: one tally of all dates, then the rows of one day.
    assert key_at_rank(df, ["d", "n"], 1234, 4000, 200).below <= 1234
    assert len(plans) == len(rest) == 1 and "EqualTo(d," in pushed(rest[0])
    # A number: nothing above the bracket is read.
    plans.clear()
    key_at_rank(df, ["n"], 1234, 4000, 200)
    assert len(plans) == 1 and "LessThanOrEqual(n," in pushed(plans[0])


def test_repeated(spark):
    df = spark.createDataFrame([("a", 25), ("b", 0), ("c", 1)], "x string, n long")
    got = {r["x"]: r["count"] for r in repeated(df, "n", chunk=10).groupBy("x").count().collect()}
    assert got == {"a": 25, "c": 1}


@pytest.mark.parametrize("limit", [5, None])
def test_chronological_is_a_partition_of_the_rows(spark, limit):
    rows = [(i // 10, i % 3, float(i)) for i in range(100)] + [(4, 1, 0.5)] * 60
    df = spark.createDataFrame(rows, "d int, p int, x double").repartition(4)
    out = split.chronological(df, "d", ["p"], key_limit=limit)
    halves = {s: [tuple(r)[:3] for r in out.where(F.col("split") == s).collect()] for s in ("training", "prediction")}
    assert len(halves["training"]) == int(160 * (2 / 3))
    assert sorted(halves["training"] + halves["prediction"]) == sorted(rows)
    assert max(r[:2] for r in halves["training"]) <= min(r[:2] for r in halves["prediction"])


def test_chronological_anchor(spark):
    out = split.chronological(spark.range(10), "id")
    assert {r["split"]: r["n_rows"] for r in split.split_counts(out).collect()} == {"training": 6, "prediction": 4}
    empty = split.chronological(spark.range(0), "id")
    assert empty.columns == ["id", "split"] and empty.count() == 0


def test_class_quotas():
    assert split.class_quotas({0: 75, 1: 25}, 0.2) == {0: 15, 1: 5}
    assert sum(split.class_quotas({"a": 7, "b": 3, "c": 1}, 0.25).values()) == 3


@pytest.mark.parametrize("widen", [6.0, 0.0])
def test_stratified_quotas_and_content(spark, widen):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y")).repartition(5)
    out = split.stratified(df, "y", ["id"], 0.2, widen=widen)
    assert {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()} == {
        (0, "train"): 720, (0, "test"): 180, (1, "train"): 80, (1, "test"): 20,
    }
    assert out.select("id").distinct().count() == 1000
    again = split.stratified(df.repartition(3), "y", ["id"], 0.2)
    assert out.exceptAll(again).isEmpty()


def test_stratified_shares_out_identical_copies(spark):
    df = spark.createDataFrame([(1, 5.0)] * 70 + [(1, float(i)) for i in range(100, 130)] + [(0, 1.0)] * 50, "y int, x double")
    out = split.stratified(df, "y").groupBy("y", "split").count()
    assert {(r["y"], r["split"]): r["count"] for r in out.collect()} == {(1, "test"): 20, (1, "train"): 80, (0, "test"): 10, (0, "train"): 40}


def test_stratified_rejects_a_key_that_is_not_one(spark):
    df = spark.range(100).select("id", F.lit(1).alias("y"), F.lit("same").alias("k"))
    with pytest.raises(Exception, match="does not identify rows"):
        split.stratified(df, "y", ["k"]).collect()


def test_many_classes_and_missing_labels(spark, monkeypatch):
    df = spark.createDataFrame([(i, i % 37) for i in range(400)], "id int, y int")
    few = {(r["id"], r["split"]) for r in split.stratified(df, "y", ["id"], 0.2).collect()}
    monkeypatch.setattr(split, "MAX_CLASSES", 10)
    assert {(r["id"], r["split"]) for r in split.stratified(df, "y", ["id"], 0.2).collect()} == few
    gaps = df.unionByName(spark.createDataFrame([(900, None)], "id int, y int"))
    with pytest.raises(ValueError, match="without y"):
        split.stratified(gaps, "y", ["id"], 0.2)
    monkeypatch.setattr(split, "MAX_CLASSES", 100)
    with pytest.raises(ValueError, match="without y"):
        split.stratified(gaps, "y", ["id"], 0.2)


def test_columns_known_to_have_few_values_are_not_counted_again(spark, monkeypatch):
    from obsforge.plans import ranks

    df = spark.range(1000).selectExpr("cast(id % 7 as double) as a", "cast(id as double) as b", "cast(null as double) as c")
    plain = ranks.exact_quantiles(df, ["a", "b", "c"], [0.25, 0.5], small=100)
    few = ranks.few_valued(df, ["a", "b", "c"], small=100)
    assert few == ["a", "c"]
    counted, sketch = [], ranks.F.approx_count_distinct

    def watched(column, *rest):
        counted.append(column)
        return sketch(column, *rest)

    monkeypatch.setattr(ranks.F, "approx_count_distinct", watched)
    assert ranks.exact_quantiles(df, ["a", "c"], [0.25, 0.5], small=100, known_few=few) == {k: v for k, v in plain.items() if k[0] != "b"}
    assert counted == []
    assert ranks.exact_quantiles(df, ["a", "b", "c"], [0.25, 0.5], small=100, known_few=few) == plain and plain[("c", 0.5)] is None
    assert [c for c in counted if isinstance(c, str)] == ["b"]
