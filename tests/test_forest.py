from __future__ import annotations

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from tillstone.operators.forest import forest_nodes, importances, leaf_means, with_leaves, with_walked_score


@pytest.fixture(scope="module")
def grown(spark, tmp_path_factory):
    rows = spark.createDataFrame(
        [(Vectors.dense([i % 17, (i * 7) % 23, 1.0, i / 50]), (i % 17) * 3.0 + (i * 7) % 5) for i in range(800)],
        ["scaledFeatures", "Quantity"],
    )
    path = str(tmp_path_factory.mktemp("forest") / "model")
    model = RandomForestRegressor(featuresCol="scaledFeatures", labelCol="Quantity", numTrees=4, maxDepth=6, seed=1).fit(rows)
    model.write().save(path)
    return rows, model, forest_nodes(spark, path)


def test_node_table_holds_every_node_once(grown):
    _, model, nodes = grown
    assert nodes.count() == model.totalNumNodes == nodes.select("tree", "node").distinct().count()
    leaf = nodes.where("feature is null")
    assert leaf.where("threshold is not null or below is not null or above is not null or gain is not null").count() == 0
    inner = nodes.where("feature is not null")
    assert inner.where("threshold is null or below is null or above is null").count() == 0
    # every node but the roots is the child of one other
    children = inner.select("tree", F.explode(F.array("below", "above")).alias("node"))
    assert children.count() == children.distinct().count() == nodes.count() - 4


@pytest.mark.parametrize("extra", [0, 5])
def test_walk_equals_the_model(grown, extra):
    rows, model, nodes = grown
    walked = with_walked_score(model.transform(rows), nodes, 6 + extra)
    assert walked.where(F.abs(F.col("walked") - F.col("prediction")) > 1e-9).count() == 0
    assert walked.where("walked is null").count() == 0
    assert walked.columns == ["scaledFeatures", "Quantity", "prediction", "walked"]


def test_leaves_equal_the_models_own(grown):
    rows, model, nodes = grown
    # MLlib numbers leaves by themselves; the two numberings stand for each other
    got = with_leaves(model.setLeafCol("leaf").transform(rows), nodes, 6)
    model.setLeafCol("")
    both = F.arrays_zip("leaves", vector_to_array("leaf").alias("own"))
    pairs = got.select(F.posexplode(both).alias("tree", "pair")).select("tree", "pair.*").distinct()
    names = [c for c in pairs.columns if c != "tree"]
    assert pairs.count() == pairs.select("tree", names[0]).distinct().count() == pairs.select("tree", names[1]).distinct().count()


def test_importances_equal_the_models(grown):
    _, model, nodes = grown
    got = {r.feature: r.importance for r in importances(nodes).collect()}
    want = model.featureImportances.toArray()
    assert got.keys() == {i for i, x in enumerate(want) if x}
    assert all(abs(got[i] - want[i]) < 1e-9 for i in got)


def test_a_tree_without_resampling_scores_the_means_of_its_leaves(spark, grown, tmp_path):
    rows, _, _ = grown
    model = RandomForestRegressor(
        featuresCol="scaledFeatures", labelCol="Quantity", numTrees=1, maxDepth=4, bootstrap=False
    ).fit(rows)
    model.write().save(str(tmp_path / "one"))
    leaves = leaf_means(rows, forest_nodes(spark, str(tmp_path / "one")), 4, "Quantity").collect()
    assert len(leaves) > 4 and sum(r.seen for r in leaves) == 800
    assert all(r.seen == r.rows and abs(r.mean - r.value) < 1e-9 for r in leaves)


def test_a_forest_beyond_the_bound_and_a_broken_table_are_refused(grown):
    rows, _, nodes = grown
    with pytest.raises(ValueError, match="more than 3"):
        with_walked_score(rows, nodes, 6, most_nodes=3)
    with pytest.raises(ValueError, match="each node once"):
        with_walked_score(rows, nodes.union(nodes), 6)


def test_a_forest_of_single_leaves(spark, tmp_path):
    rows = spark.createDataFrame([(Vectors.dense([1.0]), 5.0)] * 10, ["scaledFeatures", "Quantity"])
    model = RandomForestRegressor(featuresCol="scaledFeatures", labelCol="Quantity", numTrees=2, maxDepth=3).fit(rows)
    model.write().save(str(tmp_path / "m"))
    nodes = forest_nodes(spark, str(tmp_path / "m"))
    assert {r.walked for r in with_walked_score(rows, nodes, 3).collect()} == {5.0}
    assert importances(nodes).collect() == []


@pytest.mark.parametrize("add", [with_walked_score, with_leaves])
def test_no_row_carries_the_forest(grown, add):
    rows, _, nodes = grown
    plan = add(rows, nodes, 6)._jdf.queryExecution().optimizedPlan().toString()
    assert "AS _trees" not in plan and "scalar-subquery" in plan
