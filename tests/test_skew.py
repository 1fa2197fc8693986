"""A key that holds a third of all rows: right results, and the work is split."""

from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tillstone.operators.clean import clean
from tillstone.operators.features import fit_labels, index_column
from tillstone.operators.gold import gold_by_country
from tillstone.sources.paths import scratch_dir
from tillstone.sources.star import retail_from_star

ORDERS, CUSTOMERS, PARTS, NATIONS = 6000, 400, 300, 6


@pytest.fixture
def shuffled_joins(conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="8KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="8KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    )


def _executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    """Customer 1 placed a third of the orders and part 1 is on a third of the lines."""
    root = tmp_path_factory.mktemp("star")
    orders = [(o, 1 if o % 3 == 0 else o % CUSTOMERS) for o in range(ORDERS)]
    lines = [
        (o, 1 if (o + n) % 3 == 0 else (o * 7 + n) % PARTS, n, float(o % 9 + 1), "R" if o % 11 == 0 else "N")
        for o in range(ORDERS)
        for n in (1, 7)
    ]
    customers = [(c, c % NATIONS) for c in range(CUSTOMERS)]
    nations = [(n, f"nation {n}") for n in range(NATIONS)]
    parts = [(p, f"part {p}", p / 2) for p in range(PARTS)]
    tables = {
        "orders": spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint").withColumn(
            "o_orderdate", F.lit("2024-01-01").cast("timestamp_ntz")
        ),
        "lineitem": spark.createDataFrame(
            lines, "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_returnflag string"
        ),
        "customer": spark.createDataFrame(customers, "c_custkey bigint, c_nationkey int"),
        "nation": spark.createDataFrame(nations, "n_nationkey int, n_name string"),
        "part": spark.createDataFrame(parts, "p_partkey bigint, p_name string, p_retailprice double"),
    }
    for name, df in tables.items():
        df.repartition(8).write.parquet(f"{root}/{name}.parquet")
    return str(root), dict(orders), lines


def test_gold_with_hot_customer_and_part(spark, star, shuffled_joins):
    root, buyer, lines = star
    expected = defaultdict(lambda: [0, 0.0, 0, set(), set()])
    for order, part, number, quantity, flag in lines:
        customer = buyer[order]
        if flag == "R" or number == 7 or part == 0 or customer % 10 == 0:
            continue
        group = expected[f"nation {customer % NATIONS}"]
        group[0] += 1
        group[1] += quantity * part / 2
        group[2] += int(quantity)
        group[3].add(customer)
        group[4].add(part)
    gold = gold_by_country(clean(retail_from_star(spark, root)))
    plan = _executed(gold)
    assert {
        r.Country: (
            r.TotalTransactions,
            r.TotalRevenue,
            r.TotalQuantitySold,
            r.TotalItemsSold,
            r.UniqueCustomers,
            r.UniqueProductsSold,
        )
        for r in gold.collect()
    } == {
        country: (lines, pytest.approx(revenue), quantity, lines, len(customers), len(parts))
        for country, (lines, revenue, quantity, customers, parts) in expected.items()
    }
    assert plan.count("SortMergeJoin(skew=true)") >= 2


def test_hot_label_is_split(spark, shuffled_joins):
    rows = spark.range(60000, numPartitions=8).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id"))).alias("v")
    )
    labels = fit_labels(rows, ["v"], scratch_dir(spark, "labels"))["v"]
    indexed = index_column(rows, labels, "v", "i")
    assert "SortMergeJoin(skew=true)" in _executed(indexed)
    assert indexed.where("i = 0").count() == 20000
    assert indexed.agg(F.count("i"), F.count_distinct("i"), F.max("i")).first() == (60000, 40001, 40000.0)
