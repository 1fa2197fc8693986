"""Connected components of a link table, as a loop of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstone.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(v, label): the smallest vertex that each vertex of links (a, b) reaches.

    A round takes the least label among a vertex and its neighbours and then the label of that label, so
    paths shrink at least by half. Only minima are formed, never lists; each round is a stored table.
    """
    edges = scratch.store(
        links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            links.select(F.col("b").alias("u"), F.col("a").alias("v"))
        ),
        f"{name}-edges",
    )
    labels = scratch.store(
        edges.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("label"), F.lit(True).alias("moved")),
        f"{name}-0",
    )
    turn = 0
    while labels.filter("moved").limit(1).count():
        near = (
            edges.join(labels.select(F.col("v").alias("u"), "label"), "u")
            .groupBy("v")
            .agg(F.min("label").alias("near"))
        )
        best = labels.join(near, "v").select("v", F.col("label").alias("old"), F.least("label", "near").alias("best"))
        jump = labels.select(F.col("v").alias("best"), F.col("label").alias("next"))
        turn += 1
        after = best.join(jump, "best").select(
            "v", F.least("best", "next").alias("label"), (F.least("best", "next") != F.col("old")).alias("moved")
        )
        labels = scratch.store(after, f"{name}-{turn}")
        scratch.drop(f"{name}-{turn - 1}")
    scratch.drop(f"{name}-edges")
    return labels.select("v", "label")
