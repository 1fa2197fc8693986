"""The runs table and what a run's record is worth."""

from __future__ import annotations

from dataclasses import fields
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tillstone.operators.training import TrainingOptions
from tillstone.plans.medallion import FlowConfig, train
from tillstone.plans.runs import RunLog
from tillstone.sources.layers import LayerStore
from tillstone.sources.synthetic import synthetic_retail

AT = datetime(2024, 1, 1)


@pytest.fixture
def runs(spark, tmp_path):
    return RunLog(LayerStore(spark, str(tmp_path)))


def test_runs_are_appended_and_told_apart(runs):
    ids = [
        runs.append("a", "FINISHED", started_at=AT, params={"x": "1", "y": "2"}, metrics={"rmse": 1.5}),
        runs.append("b", "FAILED", started_at=AT),
    ]
    assert len(set(ids)) == 2 and runs.read().count() == 2
    assert {(r.run_id, r.name, r.value) for r in runs.params().collect()} == {(ids[0], "x", "1"), (ids[0], "y", "2")}
    assert [tuple(r) for r in runs.metrics().collect()] == [(ids[0], "rmse", 1.5)]
    failed = runs.read().where(F.col("run_id") == ids[1]).first()
    assert (failed.status, failed.params, failed.metrics, failed.model_name) == ("FAILED", {}, {}, None)
    assert failed.started_at == AT <= failed.ended_at


def test_a_failed_run_registers_no_model(runs):
    runs.append("a", "FAILED", started_at=AT, model=("m", 1, "/nowhere"))
    with pytest.raises(LookupError, match="'m'"):
        runs.load_model("m")


def test_no_run_at_all(runs):
    with pytest.raises(LookupError, match="no run"):
        runs.load_model("m")


def test_versions_count_on_per_name(runs):
    name, version, path = runs.new_model_version("m")
    assert (name, version) == ("m", 1) and path.startswith(runs.store.root)
    assert runs.new_model_version("other")[1] == 1


def test_all_params_name_every_option():
    options = TrainingOptions(num_trees=7, split_keys=("a", "b"))
    named = options.all_params()
    assert named["n_estimators"] == "7" and named["split_keys"] == "a,b"
    renamed = {"num_trees": "n_estimators"}
    assert {renamed.get(f.name, f.name) for f in fields(options)} <= set(named)
    assert set(options.params()) <= set(named)


def test_a_run_is_repeated_from_its_record(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    raw = synthetic_retail(spark, 800)
    store.overwrite("silver", raw.drop("InvoiceDate").withColumn("CustomerID", F.col("CustomerID").cast("bigint")).withColumn("UnitPrice", F.col("UnitPrice").cast("double")))
    cfg = FlowConfig("unused", store.root, training=TrainingOptions(num_trees=3, max_depth=3, seed=5, bootstrap=False))
    run_id = train(store, cfg)
    first = RunLog(store).read().where(F.col("run_id") == run_id).first()
    p = first.params
    again = TrainingOptions(
        num_trees=int(p["n_estimators"]), max_depth=int(p["max_depth"]), seed=int(p["seed"]), bootstrap=p["bootstrap"] == "True"
    )
    run_id = train(store, FlowConfig("unused", store.root, training=again))
    second = RunLog(store).read().where(F.col("run_id") == run_id).first()
    assert second.metrics == first.metrics and second.params == p
    assert (first.model_version, second.model_version) == (1, 2)
