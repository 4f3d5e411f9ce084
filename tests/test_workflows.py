"""Compositions on a small history."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from obsforge import workflows
from obsforge.operators import feed, model, runlog
from obsforge.schema import LABEL, RAW

PREPARED = [
    "Location", "MinTemp", "MaxTemp", "Evaporation", "Sunshine", "WindGustDir", "WindGustSpeed", "WindDir9am", "WindDir3pm",
    "WindSpeed9am", "WindSpeed3pm", "Humidity9am", "Humidity3pm", "Pressure3pm", "Cloud9am", "Cloud3pm", "RainToday", "RainTomorrow",
]


def test_prepare(obs):
    done = workflows.prepare(obs)
    assert done.df.columns == PREPARED and done.df.count() == 43
    assert done.facts == {
        "data_preparation.initial_shape": "(45, 23)", "data_preparation.final_shape": "(43, 18)",
        "data_preparation.missing_values_removed": 5, "data_preparation.rows_dropped": 2,
    }
    assert {r["Location"] for r in done.df.collect()} == {0, 1, 2}
    assert done.df.agg(F.max("WindSpeed3pm")).first()[0] < 150
    fence = {r["column"]: r["low"] for r in done.fences.collect()}
    collapsed = workflows.prepare(obs, fence_mode="collapse").df
    assert {r["MinTemp"] for r in collapsed.collect()} == {fence["MinTemp"]}
    assert collapsed.where("Sunshine is null").count() == done.df.where("Sunshine is null").count() > 0


def test_prepare_is_independent_of_partitioning(obs):
    one, many = (workflows.prepare(obs.repartition(n)).df for n in (1, 13))
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


@pytest.fixture(scope="module")
def home(spark, obs, tmp_path_factory):
    home = workflows.Home(spark, str(tmp_path_factory.mktemp("home")))
    counts = workflows.initial_load(home, obs)
    assert {r["split"]: r["n_rows"] for r in counts.collect()} == {"training": 30, "prediction": 15}
    workflows.run_all(home, workflows.training_rows(home), "run-1", 1)
    return home


def test_training_leaves_a_champion_and_a_document(home):
    assert home.champion() == 1
    document = home.spark.read.json(home.at("metrics"))
    assert {r["step"] for r in document.select("step").collect()} == {"train", "evaluate"}
    assert runlog.status(home.run_log()).where("run_id = 'run-1'").first()["status"] == "COMPLETED"
    assert runlog.search(home.run_log(), {"workflow_status": "COMPLETED", "model_type": "RandomForest"}).count() == 1


def test_failure_is_logged_and_raised(home):
    with pytest.raises(Exception, match="Absent"):
        workflows.run_all(home, home.spark.range(1).select(F.col("Absent")), "run-x", 9)


def test_failed_step_is_logged(home, obs):
    with pytest.raises(ValueError):
        workflows.run_all(home, obs.withColumn("WindGustDir", F.lit(None).cast("string")), "run-2", 2)
    assert runlog.status(home.run_log()).where("run_id = 'run-2'").first()["status"] == "FAILED"
    assert home.champion() == 1


def test_failed_preparation_is_logged(home, obs):
    with pytest.raises(ValueError) as raised:
        workflows.extract(home, obs.withColumn("WindGustDir", F.lit(None).cast("string")), "no-wind")
    facts = {r["key"]: r["value"] for r in home.run_log().where("run_id = 'no-wind'").collect()}
    assert facts["data_preparation.status"] == "FAILED" and facts["data_preparation.error"] == str(raised.value)


def test_failed_promotion_leaves_the_evaluation_complete(home, monkeypatch):
    with monkeypatch.context() as broken:
        broken.setattr(workflows.Home, "promoted", lambda self: self.spark.read.parquet(self.at("nowhere")))
        (row,) = workflows.evaluate(home, "r1", 1).collect()
    facts = {r["key"]: r["value"] for r in home.run_log().where("run_id = 'r1'").collect()}
    assert facts["evaluation_status"] == "COMPLETED" and "nowhere" in facts["model_promotion_error"]
    assert row["version"] == "1" and row["promoted"] is None and 0 <= row["metric"] <= 1


def test_scoring_uses_stored_state(home, obs):
    rows = obs.drop(LABEL)
    scored, rejects = workflows.score(home, rows)
    together = {(r["Date"], r["Location"]): r["probability"] for r in scored.collect()}
    assert len(together) + rejects.count() == 45
    one = rows.where("Location = 'Perth'").limit(1)
    for r in workflows.score(home, one)[0].collect():
        assert together[(r["Date"], r["Location"])] == pytest.approx(r["probability"])


def test_rule_breakers_are_rejected_and_unseen_values_scored(home, obs):
    rows = obs.drop(LABEL).limit(2).withColumn("Location", F.lit("Darwin"))
    broken = rows.withColumn("Humidity9am", F.lit(400.0))
    scored, rejects = workflows.score(home, rows.unionByName(broken))
    assert scored.count() == 2 and {e for r in rejects.collect() for e in r["errors"]} == {"Humidity9am:range"}


def test_state_round_trip(home, obs):
    state = model.ScoringState.load(home.spark, home.state_path(1))
    assert state.features == PREPARED[:-1] and "Sunshine" in state.flagged and state.vector[-1].endswith("_missing")


def test_only_complete_states_are_read(home, obs, tmp_path):
    spark, path = home.spark, str(tmp_path / "state")
    with pytest.raises(ValueError, match="no complete state"):
        model.ScoringState.load(spark, path)
    state = model.ScoringState.load(spark, home.state_path(1))
    state.save(path)
    reader = model.ScoringState.load(spark, path)

    class Broken:
        def write(self):
            raise OSError("writer lost")

    # A save that ends half-way, all tables written, leaves the former state in force.
    changed = dataclasses.replace(state, flagged=[], fences=state.fences.limit(0), model=Broken())
    with pytest.raises(OSError):
        changed.save(path)
    again = model.ScoringState.load(spark, path)
    assert again.flagged == state.flagged and again.fences.count() == state.fences.count()
    # The next complete one replaces it; whoever holds the former goes on reading it, and can ask for it by number.
    dataclasses.replace(state, fence_mode="collapse", fences=state.fences.limit(0), model=None).save(path)
    assert model.ScoringState.load(spark, path, with_model=False).fence_mode == "collapse"
    with pytest.raises(ValueError, match="without a forest"):
        model.ScoringState.load(spark, path)
    rows = obs.drop(LABEL).limit(5)
    expected = sorted(r["probability"] for r in model.score(rows, state, ["Date"]).collect())
    for kept in (reader, model.ScoringState.load(spark, path, save=1)):
        assert kept.fences.count() == state.fences.count()
        assert sorted(r["probability"] for r in model.score(rows, kept, ["Date"]).collect()) == expected


def test_promotion_and_steps_are_logged(home):
    facts = {(r["run_id"], r["key"]): r["value"] for r in runlog.current(home.run_log("run")).collect()}
    assert facts["run-1", "model_promotion"] == "First model assigned as champion"
    assert facts["run-2", "pipeline_status"] == "FAILED" and facts["run-2", "error_message"]


def test_requests_are_scored_or_rejected(home, spark):
    from obsforge.operators import validate

    fields = list(dict.fromkeys(r.column for r in validate.request_rules()))
    good = [1, 1.0, 10.0, 25.0, 180.0, 30.0, 90.0, 90.0, 10.0, 12.0, 50.0, 60.0, 1013.0, 4.0, 4.0, 0.0]
    values = dict(zip(["id", "Location", "MinTemp", "MaxTemp", "WindGustDir", "WindGustSpeed", "WindDir9am", "WindDir3pm", "WindSpeed9am", "WindSpeed3pm",
                       "Humidity9am", "Humidity3pm", "Pressure3pm", "Cloud9am", "Cloud3pm", "RainToday"], good))
    assert sorted(fields) == sorted(c for c in values if c != "id")
    names = ["id", *fields]
    broken = {**values, "id": 2, "MinTemp": 100.0, "Cloud9am": None}
    rows = spark.createDataFrame([[v[n] for n in names] for v in (values, broken)], ", ".join(f"{n} {'int' if n == 'id' else 'double'}" for n in names))
    for _ in range(2):
        scored, rejects = workflows.score_requests(home, rows, ["id"], "b1")
        assert [r["id"] for r in scored.collect()] == [1]
        assert {e for r in rejects.collect() for e in r["errors"]} == {"MinTemp:range", "Cloud9am:required"}
    logged = home.run_log("prediction").where("key = 'pipeline_type' AND value = 'manual_prediction'")
    assert logged.count() == 1
    with pytest.raises(ValueError, match="unexpected"):
        workflows.score_requests(home, rows.withColumn("Extra", F.lit(1)), ["id"], "b2")


def test_intermediate_tables_are_removed(home, obs):
    import os

    from obsforge.session import shared_dir

    left = {n.split("-")[0] for n in os.listdir(shared_dir(home.spark))}
    done = workflows.extract(home, obs, "run-3")
    assert done.df.count() == 43
    assert {n.split("-")[0] for n in os.listdir(shared_dir(home.spark))} <= left | {"checkpoints"}


def test_daily_steps(home):
    spark = home.spark
    first = workflows.daily(home, 0, 2)
    assert first.count() == 2
    again = workflows.daily(home, 0, 2)
    assert first.exceptAll(again).isEmpty()
    assert workflows.daily(home, 1, 1).count() == 1
    assert workflows.training_rows(home).count() == 33
    assert feed.check_pool(workflows.prediction_pool(home).rows().drop("stretch"), feed.committed(spark, home.at("feed")), ["Date", "Location"]).first()["adds_up"]
    assert home.spark.read.parquet(home.at("deployments")).count() == 1
    parent = workflows.deployment(home)[0]
    rolled = runlog.roll_up(home.run_log().where(F.col("parent_run_id") == parent)).first()
    assert rolled["n_predictions"] == 4  # three observed rows and one request
    tags = home.run_log("prediction").where("key = 'data_hash'")
    assert tags.count() == 3 and tags.select("value").distinct().count() == 2


def test_empty_history_fails_cleanly(spark):
    with pytest.raises(ValueError, match="no rows"):
        workflows.prepare(spark.createDataFrame([], RAW))


def test_methods_stay_short_enough_to_be_compiled(spark, tmp_path):
    name, before = "spark.sql.codegen.hugeMethodLimit", spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    try:
        spark.conf.set(name, 65535)
        workflows.Home(spark, str(tmp_path))
        assert int(spark.conf.get(name)) == 8000
        spark.conf.set(name, 4000)
        workflows.Home(spark, str(tmp_path))
        assert int(spark.conf.get(name)) == 4000
    finally:
        spark.conf.set(name, before)
