from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tillstone.operators.gold import gold_by_country
from tillstone.operators.guards import MissingColumnsError
from tillstone.operators.sketches import HLL, PARTIAL_DDL, THETA, gold_from_partials, gold_partials, united
from tillstone.sources.layers import LayerStore

KEYS = "id string, Country string"


def _lines(spark, n, countries=3):
    return spark.range(n).select(
        F.concat(F.lit("I"), "id").alias("InvoiceNo"),
        F.concat(F.lit("S"), (F.col("id") % 700).cast("string")).alias("StockCode"),
        (F.col("id") % 9 + 1).cast("int").alias("Quantity"),
        F.lit(2.5).alias("UnitPrice"),
        (F.col("id") * 7 % 4000).alias("CustomerID"),
        F.concat(F.lit("C"), (F.col("id") % countries).cast("string")).alias("Country"),
        (F.col("id") % 5).cast("int").alias("batch"),
    )


@pytest.mark.parametrize("sketch", [THETA, HLL])
def test_estimates_are_near_and_sums_exact(spark, sketch):
    lines = _lines(spark, 20_000)
    exact = {r.Country: r for r in gold_by_country(lines).collect()}
    for got in gold_from_partials(gold_partials(lines, "batch", sketch=sketch), sketch=sketch).collect():
        want = exact[got.Country]
        assert got.asDict().keys() == want.asDict().keys()
        for name in ("TotalTransactions", "TotalRevenue", "TotalQuantitySold", "TotalItemsSold"):
            assert got[name] == want[name]
        for name in ("UniqueCustomers", "UniqueProductsSold"):
            assert abs(got[name] - want[name]) <= 0.05 * want[name]


def test_a_new_batch_is_added_without_the_old_lines(spark, tmp_path):
    lines, store = _lines(spark, 6000), LayerStore(spark, str(tmp_path))
    store.overwrite("batches", gold_partials(lines.where("batch < 4"), "batch"))
    old = store.read("batches", f"{PARTIAL_DDL}, batch int")
    grown = old.unionByName(gold_partials(lines.where("batch = 4"), "batch"))
    at_once = gold_from_partials(gold_partials(lines, "batch"))
    assert gold_from_partials(grown).exceptAll(at_once).count() == 0
    assert united(grown, "batch").count() == 15


def test_the_estimate_does_not_depend_on_the_batches(spark):
    lines = _lines(spark, 120_000, countries=2).withColumn("CustomerID", F.col("InvoiceNo"))  # more than a sketch holds
    assert lines.where("Country = 'C0'").select("CustomerID").distinct().count() > 1 << THETA.log_slots
    by_batch = gold_from_partials(gold_partials(lines, "batch"))
    assert by_batch.exceptAll(gold_from_partials(gold_partials(lines.repartition(7)))).count() == 0


def test_one_country_with_nearly_all_lines_and_nulls(spark):
    lines = _lines(spark, 5000, countries=1).withColumn("CustomerID", F.when(F.col("CustomerID") > 2000, F.col("CustomerID")))
    got = gold_from_partials(gold_partials(lines)).collect()
    assert len(got) == 1
    exact = lines.agg(F.count_distinct("CustomerID")).first()[0]
    assert abs(got[0].UniqueCustomers - exact) <= 0.05 * exact


def test_empty_lines_and_missing_columns(spark):
    lines = _lines(spark, 10)
    assert gold_from_partials(gold_partials(lines.limit(0))).collect() == []
    with pytest.raises(MissingColumnsError):
        gold_partials(lines.drop("StockCode"))
    with pytest.raises(MissingColumnsError):
        gold_partials(lines, "day")
