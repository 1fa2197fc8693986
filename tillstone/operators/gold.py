"""Silver to gold: sales per country."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.operators.guards import require_columns
from tillstone.schema import GOLD_INPUT_COLUMNS


def line_revenue() -> Column:
    return F.col("Quantity") * F.col("UnitPrice")


def gold_by_country(silver: DataFrame, *, approx: bool = False) -> DataFrame:
    """One row per country. Transactions and items count lines, not distinct values.

    Both exact distinct counts shuffle on (country, value) after a map-side
    pass, so a country holding most of the rows is still spread over all tasks;
    only per-task partial sums meet on the country key. ``approx`` replaces the
    distinct counts with sketches, which leaves a single small shuffle.
    """
    require_columns(silver, GOLD_INPUT_COLUMNS, "gold")
    distinct = F.approx_count_distinct if approx else F.count_distinct
    return silver.groupBy("Country").agg(
        F.count("InvoiceNo").alias("TotalTransactions"),
        F.sum(line_revenue()).alias("TotalRevenue"),
        F.sum("Quantity").alias("TotalQuantitySold"),
        F.count("StockCode").alias("TotalItemsSold"),
        distinct(F.col("CustomerID")).alias("UniqueCustomers"),
        distinct(F.col("StockCode")).alias("UniqueProductsSold"),
    )


def sort_gold(gold: DataFrame) -> DataFrame:
    """Report order: country ascending, null first. A stored table keeps no order."""
    return gold.orderBy("Country")
