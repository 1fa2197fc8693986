"""A fitted forest as a table of nodes, and scoring by walking it.

The model directory that MLlib writes holds one row per node. As a flat table
(tree, node, feature, threshold, children, value) it can be queried, compared
and scored without the model class: rows go down the trees by a higher-order
function over their depth, inside the scan's stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SAVED_DDL = (
    "treeID int, nodeData struct<id:int, prediction:double, impurity:double, rawCount:bigint, gain:double, "
    "leftChild:int, rightChild:int, split:struct<featureIndex:int, leftCategoriesOrThreshold:array<double>, "
    "numCategories:int>>"
)
MOST_NODES = 5_000_000


def forest_nodes(spark: SparkSession, model_path: str) -> DataFrame:
    """(tree, node, feature, threshold, below, above, value, rows, gain) of a saved forest; leaves have no feature.

    ``below`` takes values up to the threshold. ``rows`` counts the training rows that reached the node and
    ``gain`` is how much its split lowered their variance; both are what importances are made of.
    """
    saved = spark.read.schema(_SAVED_DDL).parquet(f"{model_path}/data")
    n = "nodeData"
    inner = F.col(f"{n}.leftChild") >= 0
    return saved.select(
        F.col("treeID").alias("tree"),
        F.col(f"{n}.id").alias("node"),
        F.when(inner, F.col(f"{n}.split.featureIndex")).alias("feature"),
        F.when(inner, F.get(f"{n}.split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(inner, F.col(f"{n}.leftChild")).alias("below"),
        F.when(inner, F.col(f"{n}.rightChild")).alias("above"),
        F.col(f"{n}.prediction").alias("value"),
        F.col(f"{n}.rawCount").alias("rows"),
        F.when(inner, F.col(f"{n}.gain")).alias("gain"),
        F.col(f"{n}.split.numCategories").alias("categories"),
    )


def _trees(nodes: DataFrame, most_nodes: int) -> tuple[Column, int]:
    """All trees as one value, tree by tree and node by node, as a scalar subquery; and their number.

    Like MLlib's own scoring this hands every executor the whole forest, whose size follows the number of trees and
    their depth, not the rows. It is checked nevertheless, and so is the numbering that the walk relies on.
    """
    checks = nodes.agg(
        F.count(F.lit(1)).alias("nodes"),
        F.count_distinct("tree", "node").alias("names"),
        F.count_if(F.col("categories") >= 0).alias("categorical"),
        F.count_distinct("tree").alias("trees"),
    ).first()
    if checks["nodes"] > most_nodes:
        raise ValueError(f"the forest has {checks['nodes']} nodes, more than {most_nodes}; score it with the model itself")
    if checks["nodes"] != checks["names"] or checks["categorical"]:
        raise ValueError("a walk needs each node once and splits on numbers only")
    node = F.struct("node", "feature", "threshold", "below", "above", "value")
    trees = nodes.groupBy("tree").agg(F.array_sort(F.collect_list(node)).alias("nodes"))
    value = trees.agg(F.array_sort(F.collect_list(F.struct("tree", "nodes"))).alias("trees")).scalar()
    return value, checks["trees"]


def _with_walk(rows: DataFrame, nodes: DataFrame, features: str, output: str, most_nodes: int, walk: Callable) -> DataFrame:
    """rows with a column made by ``walk`` of the trees, a row's feature values and the number of trees.

    The values are bound by a function over an array of one, so they are unpacked once a row and not at every step.
    ``walk`` has to name the trees once: the optimizer then puts the subquery's value in their place, whereas named
    twice they would become a column, a copy of the forest in every row.
    """
    trees, n = _trees(nodes, most_nodes)
    values = F.array(vector_to_array(F.col(features)))
    found = F.get(F.transform(values, lambda v: walk(F.col("_trees"), v, n)), F.lit(0))
    return rows.withColumn("_trees", trees).withColumn(output, found).drop("_trees")


def _leaf(nodes: Column, values: Column, max_depth: int) -> Column:
    """Where a row ends in one tree; nodes are numbered from 0 without gaps."""

    def step(at: Column, _: Column) -> Column:
        node = F.get(nodes, at)
        onward = F.when(F.get(values, node["feature"]) <= node["threshold"], node["below"]).otherwise(node["above"])
        return F.when(node["feature"].isNull(), at).otherwise(onward)

    return F.aggregate(F.sequence(F.lit(1), F.lit(max_depth)), F.lit(0), step) if max_depth else F.lit(0)


def with_walked_score(
    rows: DataFrame,
    nodes: DataFrame,
    max_depth: int,
    features: str = "scaledFeatures",
    output: str = "walked",
    most_nodes: int = MOST_NODES,
) -> DataFrame:
    """Add the mean of the trees' leaf values, equal to the model's own prediction."""

    def walk(trees: Column, values: Column, n: int) -> Column:
        scores = F.transform(trees, lambda tree: F.get(tree["nodes"], _leaf(tree["nodes"], values, max_depth))["value"])
        return F.aggregate(scores, F.lit(0.0), lambda total, x: total + x) / n

    return _with_walk(rows, nodes, features, output, most_nodes, walk)


def with_leaves(
    rows: DataFrame,
    nodes: DataFrame,
    max_depth: int,
    features: str = "scaledFeatures",
    output: str = "leaves",
    most_nodes: int = MOST_NODES,
) -> DataFrame:
    """Add the node that a row ends in, one per tree."""

    def walk(trees: Column, values: Column, _: int) -> Column:
        return F.transform(trees, lambda tree: _leaf(tree["nodes"], values, max_depth))

    return _with_walk(rows, nodes, features, output, most_nodes, walk)


def leaf_means(rows: DataFrame, nodes: DataFrame, max_depth: int, label: str, features: str = "scaledFeatures") -> DataFrame:
    """(tree, node, value, rows, seen, mean): what each leaf holds beside the rows given that end in it."""
    ends = with_leaves(rows, nodes, max_depth, features, "leaves").select(F.col(label).alias("y"), F.posexplode("leaves").alias("tree", "node"))
    seen = ends.groupBy("tree", "node").agg(F.count("y").alias("seen"), F.avg("y").alias("mean"))
    leaves = nodes.where("feature is null").select("tree", "node", "value", "rows")
    return leaves.join(seen, ["tree", "node"], "left").withColumn("seen", F.coalesce("seen", F.lit(0)))


def importances(nodes: DataFrame) -> DataFrame:
    """(feature, importance): each tree's gains weighted by rows and brought to a sum of 1, then those of all trees.

    A tree without a split has none. Features that no tree splits on are left out.
    """
    gains = nodes.where("feature is not null").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("gain"))
    totals = gains.groupBy("tree").agg(F.sum("gain").alias("total")).where("total > 0")
    shares = gains.join(totals, "tree").groupBy("feature").agg(F.sum(F.col("gain") / F.col("total")).alias("share"))
    whole = shares.agg(F.sum("share")).scalar()
    return shares.select("feature", (F.col("share") / whole).alias("importance"))
