"""Operators on hand-computed frames."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsforge.functions.columns import content_hash
from obsforge.operators import clean, encode, impute, metrics, outliers, profile, runlog, validate
from obsforge.session import shared_dir
from obsforge.sources import tables


def column(df, name):
    return [r[name] for r in df.collect()]


@pytest.fixture(scope="module")
def outlier_frame(spark):
    return spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (4.0, 5.0), (100.0, 5.0), (None, None)], "x double, c double").coalesce(1)


def test_fences_and_modes(outlier_frame):
    fences = outliers.fit_fences(outlier_frame, ["x", "c"])
    assert {r["column"]: (r["q1"], r["q3"], r["low"], r["up"]) for r in fences.collect()} == {"x": (2, 4, -1, 7), "c": (5, 5, 5, 5)}
    clipped = outliers.apply_fences(outlier_frame, fences)
    assert column(clipped, "x") == [1, 2, 3, 4, 7, None]
    assert clipped.exceptAll(outliers.apply_fences(clipped, fences)).isEmpty()
    collapsed = outliers.apply_fences(outlier_frame, fences, "collapse")
    assert column(collapsed, "x") == [-1] * 5 + [None] and column(collapsed, "c") == [5] * 5 + [None]
    flags = {r["column"]: (r["has_outliers"], r["n_low"], r["n_up"]) for r in outliers.has_outliers(outlier_frame, fences).collect()}
    assert flags == {"x": (True, 0, 1), "c": (False, 0, 0)}


def test_centres(outlier_frame):
    mean = outliers.fit_fences(outlier_frame, ["x"], centre="mean")
    assert column(outliers.apply_fences(outlier_frame, mean, "mean"), "x")[4] == 22
    median = outliers.fit_fences(outlier_frame, ["x"], centre="median")
    assert column(outliers.apply_fences(outlier_frame, median, "median"), "x")[4] == 3
    with pytest.raises(ValueError, match="centre"):
        outliers.apply_fences(outlier_frame, mean, "median")


def test_all_null_column_passes_through(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert column(outliers.apply_fences(df, outliers.fit_fences(df, ["x"])), "x") == [None, None]
    assert column(clean.fill_median(df, clean.fit_median(df, ["x"])), "x") == [0.0, 0.0]


def test_scaler(spark):
    df = spark.createDataFrame([(1.0, 0.1), (3.0, 0.1), (None, None)], "x double, c double").coalesce(1)
    scaler = encode.fit_scaler(df, ["x", "c"])
    scaled = encode.apply_scaler(df, scaler)
    assert column(scaled, "x") == [-1, 1, None]
    other = encode.apply_scaler(spark.createDataFrame([(2.0, 1.1)], "x double, c double"), scaler).first()
    assert other["x"] == 0 and other["c"] == pytest.approx(1.0)


@pytest.mark.parametrize("per_bucket", [None, 2])
def test_codes(spark, per_bucket):
    df = spark.createDataFrame([("b", "z"), ("a", None), ("c", "y"), ("a", "x")], "l string, w string").coalesce(1)
    codes = encode.fit_codes(df, ["l", "w"], rows_per_bucket=per_bucket)
    coded = encode.apply_codes(df, codes, ["l", "w"])
    assert sorted(column(coded, "l")) == [0, 0, 1, 2] and sorted(v for v in column(coded, "w") if v is not None) == [0, 1, 2]
    assert encode.decode(coded, codes, ["l", "w"]).exceptAll(df).isEmpty()
    by_shuffle = encode.apply_codes(df, codes, ["l", "w"], broadcast_rows=0)
    assert coded.exceptAll(by_shuffle).isEmpty()


def test_unseen_codes(spark):
    codes = encode.fit_codes(spark.createDataFrame([("a",), ("b",)], "l string"), ["l"])
    new = spark.createDataFrame([("q",), (None,)], "l string").coalesce(1)
    assert column(encode.apply_codes(new, codes, ["l"], "null"), "l") == [None, None]
    assert column(encode.apply_codes(new, codes, ["l"], "keep"), "l") == [2, None]
    with pytest.raises(Exception, match="unseen value in l"):
        encode.apply_codes(new, codes, ["l"]).collect()


def test_mode_takes_the_smallest_of_ties_and_needs_a_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "x string").coalesce(1)
    assert column(clean.fill_mode(df, clean.fit_mode(df, ["x"])), "x") == ["b", "a", "b", "a", "a"]
    empty = spark.createDataFrame([(None,)], "x string")
    with pytest.raises(ValueError, match="no value"):
        clean.fill_mode(empty, clean.fit_mode(empty, ["x"]))


def test_binary_map_variants(spark):
    df = spark.createDataFrame([("Yes",), ("No",), ("1",), ("0.0",), ("x",), (None,)], "r string").coalesce(1)
    assert column(clean.binary_map(df, ["r", "absent"]), "r") == [1, 0, None, None, None, None]
    assert column(clean.binary_map(df, ["r"], passthrough=True), "r") == [1, 0, 1, 0, None, None]


def test_drop_unlabelled_needs_both_columns(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (1, 1)], "a int, b int")
    assert clean.drop_unlabelled(df, ["a", "b"]).count() == 1
    assert clean.drop_unlabelled(df, ["a", "absent"]).count() == 3


def test_align(spark):
    out = clean.align(spark.createDataFrame([(1.0, 2.0)], "a double, b double"), ["b", "z"])
    assert out.columns == ["b", "z"] and tuple(out.first()) == (2.0, None)


def test_vif(spark):
    rng = np.random.default_rng(0)
    x1 = rng.normal(size=500)
    x3 = rng.normal(size=500)
    x2 = 2 * x1 + 0.1 * rng.normal(size=500)
    df = spark.createDataFrame([(float(a), float(b), float(c), float(c), 1.0) for a, b, c in zip(x1, x2, x3)], "x1 double, x2 double, x3 double, x4 double, k double")
    others = np.column_stack([np.ones(500), x2, x3])
    residual = x1 - others @ np.linalg.lstsq(others, x1, rcond=None)[0]
    expected = np.var(x1) * 500 / (residual @ residual)
    factors = {r["feature"]: r["vif"] for r in profile.vif(df, ["x1", "x2", "x3"]).collect()}
    assert factors["x1"] == pytest.approx(expected, rel=1e-9)
    copies = {r["feature"]: r["vif"] for r in profile.vif(df, ["x1", "x3", "x4", "k"]).collect()}
    assert math.isinf(copies["x3"]) and math.isinf(copies["x4"]) and copies["k"] is None
    steps = {r["feature"]: r["dropped_at"] for r in profile.vif_eliminate(df, ["x1", "x2", "x3", "x4"], 10.0).collect()}
    assert sorted(v for v in steps.values() if v) == [1, 2] and steps["x4" if steps["x3"] else "x3"] is None


def test_distinct_counts_null_as_value(spark):
    df = spark.createDataFrame([("Yes", 1), ("No", 1), (None, 1)], "r string, k int")
    for approx in (False, True):
        assert {r["column"]: r["n_distinct"] for r in profile.distinct_counts(df, approx).collect()} == {"r": 3, "k": 1}


def gapped(spark, noise):
    rng = np.random.default_rng(2)
    a = rng.normal(10, 3, 400)
    b = 2 * a + rng.normal(0, noise, 400)
    c = a - b + rng.normal(0, noise, 400)
    rows = []
    for i in range(400):
        rows.append((i, None if i % 5 == 0 else float(a[i]), None if i % 7 == 0 else float(b[i]), None if i % 11 == 0 else float(c[i])))
    return rows, {"a": a, "b": b, "c": c}, spark.createDataFrame(rows, "i int, a double, b double, c double")


@pytest.mark.parametrize("estimator, cells", [("ols", 0), ("bayes", 16 * 3)])
def test_imputation_ways_agree(spark, monkeypatch, estimator, cells):
    """All patterns held, none held, or the three most frequent ones, until nothing moves; old copies of the rest's values go."""
    monkeypatch.setattr(impute, "ROUNDS_PER_COPY", 3)
    rows, _, df = gapped(spark, 4.0)
    columns = ["a", "b", "c"]
    one = {r["i"]: r for r in impute.mice(df, columns, 100, 1e-9, estimator).collect()}
    before = set(os.listdir(shared_dir(spark)))
    many = {r["i"]: r for r in impute.mice(df, columns, 100, 1e-9, estimator, matrix_cells=cells).collect()}
    left = [n for n in set(os.listdir(shared_dir(spark))) - before if n.startswith("imputed-values")]
    assert len(left) == 1 and len(many) == 400
    for i, *cells in rows:
        for name, cell in zip(columns, cells):
            assert one[i][name] == pytest.approx(many[i][name], abs=1e-5)
            assert cell is None or one[i][name] == cell == many[i][name]


def test_a_round_reads_the_rest_once(spark, monkeypatch):
    """Jobs over rare patterns do not grow with the columns: one scan a round."""
    _, _, df = gapped(spark, 4.0)
    scans = []
    products = impute._Rest.products
    monkeypatch.setattr(impute._Rest, "products", lambda self: scans.append(1) or products(self))
    impute.mice(df, ["a", "b", "c"], 4, 0.0, matrix_cells=0)
    assert len(scans) == 4


@pytest.mark.parametrize("estimator", ["ols", "bayes"])
def test_imputation_finds_what_depends(spark, estimator):
    rows, truth, df = gapped(spark, 0.5)
    one = {r["i"]: r for r in impute.mice(df, ["a", "b", "c"], 3, 1e-5, estimator).collect()}
    error, naive = [], []
    for i, *cells in rows:
        for name, cell in zip(["a", "b", "c"], cells):
            if cell is not None:
                assert one[i][name] == cell
            elif i % 35 and i % 55 and i % 77:
                error.append((one[i][name] - truth[name][i]) ** 2)
                naive.append((truth[name].mean() - truth[name][i]) ** 2)
    assert np.mean(error) < np.mean(naive) / 4


def test_validation(spark):
    base = dict(Location="1", MinTemp="10", MaxTemp="25", WindGustDir="180", WindGustSpeed="30", WindDir9am="180", WindDir3pm="180",
                WindSpeed9am="15", WindSpeed3pm="25", Humidity9am="70", Humidity3pm="50", Pressure3pm="1013", Cloud9am="3", Cloud3pm="5",
                RainToday="0")
    cases = [base, {**base, "MaxTemp": "5"}, {**base, "RainToday": "2"}, {**base, "Cloud9am": "cloudy"}, {**base, "Location": "0"},
             {**dict.fromkeys(base), "Location": "1", "MinTemp": "100", "MaxTemp": "25"}]
    names = list(base)
    df = spark.createDataFrame([tuple(c[n] for n in names) for c in cases], ", ".join(f"{n} string" for n in names)).coalesce(1)
    errors = column(validate.with_errors(df, validate.request_rules()), "errors")
    assert errors[0] == [] and errors[1] == ["MaxTemp:at_least"]
    assert errors[2] == ["RainToday:range", "RainToday:members"] and errors[3] == ["Cloud9am:number"] and errors[4] == ["Location:range"]
    assert len(errors[5]) == 13 and "MinTemp:range" in errors[5] and "MaxTemp:at_least" not in errors[5]
    valid, rejects = validate.check(df, validate.request_rules())
    assert (valid.count(), rejects.count()) == (1, 5)
    with pytest.raises(ValueError, match="unexpected columns: Extra"):
        validate.require_no_extra(df.withColumn("Extra", F.lit(1)), names)


def brute_metrics(rows):
    pos = sum(y for y, *_ in rows)
    neg = len(rows) - pos
    wins = sum((a > b) + (a == b) / 2 for y, _, a in rows if y for z, _, b in rows if not z)
    return wins / (pos * neg) if pos and neg else None


@pytest.mark.parametrize("per_bucket", [None, 4])
def test_metrics_against_brute_force(spark, per_bucket):
    rows = [(int((i * 7) % 5 < 2), int(i % 4 == 0), (i % 9) / 8) for i in range(60)]
    df = spark.createDataFrame(rows, "label int, prediction int, score double").repartition(3)
    got = metrics.report(df, rows_per_bucket=per_bucket).first()
    assert got["roc_auc"] == pytest.approx(brute_metrics(rows))
    assert got["tp"] == sum(y and p for y, p, _ in rows) and got["fp"] == sum((not y) and p for y, p, _ in rows)
    order = sorted({s for *_, s in rows}, reverse=True)
    steps, area, last_r, last_p = 0.0, 0.0, 0.0, 1.0
    for s in order:
        taken = [y for y, _, v in rows if v >= s]
        precision, recall = sum(taken) / len(taken), sum(taken) / sum(y for y, *_ in rows)
        steps += (recall - last_r) * precision
        area += (recall - last_r) * (precision + last_p) / 2
        last_r, last_p = recall, precision
    assert got["average_precision"] == pytest.approx(steps) and got["pr_auc"] == pytest.approx(area)
    full = metrics.roc_curve(df, rows_per_bucket=per_bucket)
    short = metrics.roc_curve(df, drop_collinear=True, rows_per_bucket=per_bucket)
    assert full.count() == len(order) + 1 and short.exceptAll(full).isEmpty()


def test_metrics_of_one_class_and_no_positive_predictions(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 0, 0.2)], "label int, prediction int, score double")
    got = metrics.report(df).first()
    assert got["roc_auc"] is None and got["precision"] == 0 and got["recall"] == 0 and got["f1"] == 0 and got["accuracy"] == 1
    assert sum(column(metrics.confusion_cells(df), "n")) == 2 and metrics.confusion_cells(df).count() == 4


def test_residual_bins(spark):
    rows = [(y, s / 50) for y in (0, 1) for s in range(51)]
    df = spark.createDataFrame(rows, "label int, score double")
    counts, _ = np.histogram([y - s for y, s in rows], 30)
    assert [r["n"] for r in metrics.residual_histogram(df).orderBy("bin").collect()] == counts.tolist()
    assert column(metrics.residual_histogram(df.limit(1), bins=4), "n").count(1) == 1


@pytest.mark.parametrize("per_bucket", [None, 2])
def test_promotion(spark, per_bucket):
    rows = [("m", "2", 0.8), ("m", "10", 0.8), ("m", "3", 0.7), ("m", "11", None), ("n", "1", None)]
    df = spark.createDataFrame(rows, "model string, version string, metric double")
    out = runlog.promote(df, rows_per_bucket=per_bucket)
    assert {(r["model"], r["version"]): r["promoted"] for r in out.collect()} == {
        ("m", "2"): True, ("m", "3"): False, ("m", "10"): True, ("m", "11"): False, ("n", "1"): True,
    }
    assert {r["model"]: r["champion"] for r in runlog.champions(out).collect()} == {"m": 10, "n": 1}
    assert {r["model"]: r["version"] for r in runlog.latest_version(df).collect()} == {"m": 11, "n": 1}


def test_deployments_are_inserted_once(spark):
    df = spark.createDataFrame([("m", "2", 0.8), ("m", "10", 0.1)], "model string, version string, metric double")
    wanted = runlog.deployed_version(df, runlog.promote(df))
    first = runlog.missing_deployments(wanted, None)
    assert first.select("version").first()[0] == 2 and runlog.missing_deployments(wanted, first).isEmpty()


def test_malformed_lines_fail_or_are_rejects(spark, tmp_path):
    from pyspark.sql.types import StructType

    path, schema = str(tmp_path / "lines.csv"), StructType.fromDDL("a int, value string, x double")
    with open(path, "w") as out:
        out.write('a,value,x\n1,y,2.0\n2,"y, ""q""",3.0\n3,z,4,EXTRA\n4,z\n5,"open,1.0\n6,w,bad\n\n7,,NA\n')
    good = tables.read_history(spark, path, schema, strict=False).collect()
    assert [tuple(r) for r in good] == [(1, "y", 2.0), (2, 'y, "q"', 3.0), (6, "w", None), (7, None, None)]
    rejects = tables.read_rejects(spark, path, schema).collect()
    assert [tuple(r) for r in rejects] == [("3,z,4,EXTRA", "cells"), ("4,z", "cells"), ('5,"open,1.0', "cells"), ("6,w,bad", "type")]
    with pytest.raises(Exception, match="malformed line"):
        tables.read_history(spark, path, schema).collect()


def test_cells_with_line_breaks(spark, tmp_path):
    from pyspark.sql.types import StructType

    path, schema = str(tmp_path / "breaks.csv"), StructType.fromDDL("a int, b string, x double")
    with open(path, "w") as out:
        out.write('a,b,x\n1,"y\nz",2.0\n')
    assert [tuple(r) for r in tables.read_history(spark, path, schema, multi_line=True).collect()] == [(1, "y\nz", 2.0)]
    with pytest.raises(Exception, match="malformed line"):
        tables.read_history(spark, path, schema).collect()
    assert tables.read_rejects(spark, path, schema).count() == 2


def test_failed_predictions_are_logged_with_their_error(spark):
    import datetime

    rows = spark.createDataFrame([(1, 0.5, 1, 0.9, "Yes", 3, None), (2, None, None, None, None, 3, "x:range")],
                                 "id int, x double, prediction int, probability double, prediction_label string, model_version long, error string")
    at = datetime.datetime(2024, 5, 6, 7, 8, 9, tzinfo=datetime.timezone.utc)
    facts = runlog.prediction_facts(rows, "parent", ["id"], ["x"], "prediction", at, "hash")
    assert facts._jdf.queryExecution().executedPlan().toString().count("Scan") <= 1
    found = {}
    for r in facts.collect():
        found.setdefault(r["run_id"], {})[r["key"]] = r["value"] if r["kind"] != "metric" else r["num"]
    good, bad = sorted(found.values(), key=len, reverse=True)
    assert good == {
        "x": "0.5", "pipeline_type": "prediction", "prediction_date": "20240506_070809", "model_version": "3", "prediction_status": "COMPLETED",
        "endpoint": "predict_api", "data_hash": "hash", "prediction_result": 1.0, "prediction_probability": 0.9, "prediction_label": "Yes",
    }
    assert bad["prediction_status"] == "FAILED" and bad["error_message"] == "x:range" and "prediction_result" not in bad and bad["x"] == "NA"


def test_promotion_texts(spark):
    df = spark.createDataFrame([("m", "1", 0.8), ("m", "2", 0.7), ("m", "3", 0.9)], "model string, version string, metric double")
    out = runlog.with_promotion_text(runlog.promote(df, keep_best=True)).orderBy("version")
    assert column(out, "promotion") == [
        "First model assigned as champion", "Not promoted (no accuracy improvement)", "New model promoted to champion (Accuracy: 0.9000 vs 0.8000)",
    ]


def test_only_small_tables_are_spread(spark, tmp_path, monkeypatch):
    from obsforge import session

    path = str(tmp_path / "table")
    spark.range(1000).repartition(2).write.parquet(path)
    stored = spark.read.parquet(path)
    assert "RoundRobin" in session.spread(stored)._jdf.queryExecution().toString()
    monkeypatch.setattr(session, "SPREAD_BYTES", 16)
    assert "RoundRobin" not in session.spread(stored)._jdf.queryExecution().toString()


def test_history_reader(spark, tmp_path):
    path = str(tmp_path / "history.csv")
    with open(path, "w") as out:
        out.write('id,day,place,x\n1,2014-01-01,"A, ""B""",1.5\n2,NA,,nan\n3,2014-01-03,null,7\n')
    schema = "id int, day date, place string, x double"
    from pyspark.sql.types import StructType

    df = tables.read_history(spark, path, StructType.fromDDL(schema)).orderBy("id").coalesce(1)
    assert column(df, "place") == ['A, "B"', None, None] and column(df, "x") == [1.5, None, 7.0]
    with open(path, "a") as out:
        out.write("4,2014-01-04,P,bad\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.read_history(spark, path, StructType.fromDDL(schema)).collect()
    assert tables.read_history(spark, path, StructType.fromDDL(schema), strict=False).where("x is null").count() == 2
    with pytest.raises(ValueError, match="columns differ"):
        tables.read_history(spark, path, StructType.fromDDL("id int"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_history(spark, str(tmp_path / "absent.csv"), StructType.fromDDL(schema))
    assert dict(tables.read_inferred(spark, path).dtypes)["id"] == "int"


def test_records_get_defaults(spark):
    df = tables.from_records(spark, [{"Location": 1, "Sunshine": 2.0}], "Location int, Sunshine double")
    assert df.first().asDict() == {"Location": 1, "Sunshine": 2.0, "Evaporation": 0.0}


def test_content_hash_sees_where_nulls_are(spark):
    df = spark.createDataFrame([(None, 1), (1, None)], "a int, b int")
    assert df.select(content_hash(1, ["a", "b"]).alias("h")).distinct().count() == 2


@pytest.mark.parametrize("unseen", ["null", "keep"])
def test_large_dictionary_with_hot_values_and_nulls(spark, unseen):
    # 90 % one value, 5 % null, the rest many values, one of them unseen; "row 1" is a value like those rows are dealt by.
    text = "CASE WHEN id % 20 = 0 THEN NULL WHEN id % 20 = 1 THEN concat('v', id) WHEN id = 2 THEN 'row 1' WHEN id = 3 THEN 'new' ELSE 'hot' END"
    df = spark.range(0, 40_000, numPartitions=8).selectExpr("id", f"{text} AS c")
    codes = encode.fit_codes(df.where("c IS NULL OR c <> 'new'"), ["c"])
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        small = encode.apply_codes(df, codes, ["c"], unseen)
        large = encode.apply_codes(df, codes, ["c"], unseen, broadcast_rows=0)
        assert large.schema == small.schema
        assert sorted(map(tuple, large.collect()), key=str) == sorted(map(tuple, small.collect()), key=str)
        back = encode.decode(large, codes, ["c"], broadcast_rows=0)
        assert {r["id"]: r["c"] for r in back.collect()} == {r["id"]: None if r["c"] == "new" else r["c"] for r in df.collect()}
        for result in (large, back):
            tasks = sorted(r["count"] for r in result.groupBy(F.spark_partition_id()).count().collect())
            assert tasks[-1] < 2 * tasks[len(tasks) // 2]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_split_tables_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from obsforge import session

    before, seen, write = spark.conf.get(session.WRITERS), [], DataFrameWriter.parquet

    def watched(self, *args, **kwargs):
        seen.append(spark.conf.get(session.WRITERS))
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    rows = spark.range(100).withColumn("split", F.when(F.col("id") % 3 == 0, "test").otherwise("train"))
    path = tables.write_split(rows, str(tmp_path / "split"))
    assert seen == [str(session.OPEN_FOLDERS)] and spark.conf.get(session.WRITERS) == before
    assert sorted(column(tables.read_split(spark, path, "test"), "id")) == list(range(0, 100, 3))
    assert spark.read.parquet(path).count() == 100


def test_rules_run_as_generated_code(spark):
    # Rules of one name are both listed, in their order.
    rules = [validate.Rule("range", "x", low=0.0), validate.Rule("required", "y"), validate.Rule("range", "x", high=5.0), validate.Rule("range", "x", low=1.0)]
    df = spark.createDataFrame([(-1.0, None), (2.0, 1.0), (9.0, 1.0), (None, 1.0)], "x double, y double").coalesce(1)
    assert column(validate.with_errors(df, rules), "errors") == [["x:range", "y:required", "x:range"], [], ["x:range"], []]
    assert column(validate.with_errors(df, []), "errors") == [[]] * 4
    valid, rejects = validate.check(df, rules)
    assert column(valid, "x") == [2.0, None] and column(rejects, "errors") == [["x:range", "y:required", "x:range"], ["x:range"]]
    # A function with a lambda would be interpreted, with all rules inside it.
    for part in (valid, rejects):
        assert "lambda" not in part._jdf.queryExecution().executedPlan().toString()


def test_predictions_are_named_once_per_row(spark):
    import datetime

    rows = spark.createDataFrame([(1, 0.5, 1, 0.9, "Yes", 3)], "id int, x double, prediction int, probability double, prediction_label string, model_version long")
    facts = runlog.prediction_facts(rows, "parent", ["id"], ["x"], "prediction", datetime.datetime(2024, 5, 6, tzinfo=datetime.timezone.utc))
    plan = facts._jdf.queryExecution().executedPlan().toString()
    # Operators stand above what they read: the id is taken below the step that makes many facts of a row.
    assert plan.index("Generate") < plan.index("md5") and "lambda" not in plan and facts.count() == 9
