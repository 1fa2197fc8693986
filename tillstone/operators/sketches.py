"""Distinct counts per country from stored sketches that can be united later.

Exact distinct counts need all values again whenever lines are added. A sketch
of bounded size per country and batch can be stored instead: a new batch adds
its own row, and the counts of any set of batches come from uniting rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstone.operators.gold import line_revenue
from tillstone.operators.guards import require_columns
from tillstone.schema import GOLD_INPUT_COLUMNS

@dataclass(frozen=True)
class Sketch:
    """How distinct values are sketched.

    ``THETA`` keeps the least 2**log_slots hashes (8 bytes each): exact up to that many values, a standard error of
    1.1 percent beyond, and the same estimate however the values were dealt to batches. ``HLL`` takes an eighth of
    the room for 0.8 percent, but its estimate of united sketches moves a little with the order of uniting.
    """

    log_slots: int
    build: Callable
    unite: Callable
    estimate: Callable


THETA = Sketch(13, F.theta_sketch_agg, lambda c, slots: F.theta_union_agg(c, F.lit(slots)), F.theta_sketch_estimate)
HLL = Sketch(14, F.hll_sketch_agg, lambda c, slots: F.hll_union_agg(c), F.hll_sketch_estimate)
_SUMS = ("TotalTransactions", "TotalRevenue", "TotalQuantitySold", "TotalItemsSold")
PARTIAL_DDL = (
    "Country string, TotalTransactions bigint, TotalRevenue double, TotalQuantitySold bigint, TotalItemsSold bigint, "
    "Customers binary, Products binary"
)


def gold_partials(silver: DataFrame, *by: str, sketch: Sketch = THETA) -> DataFrame:
    """One row per country and values of ``by`` (a batch, a day): sums, and sketches of customers and stock codes.

    Sketches are built on the map side, so one shuffle of one sketch per task and country is all that moves,
    however many lines a country has. Nulls are not counted, as in an exact distinct count.
    """
    require_columns(silver, (*GOLD_INPUT_COLUMNS, *by), "gold partials")
    return silver.groupBy("Country", *by).agg(
        F.count("InvoiceNo").alias("TotalTransactions"),
        F.sum(line_revenue()).alias("TotalRevenue"),
        F.sum("Quantity").alias("TotalQuantitySold"),
        F.count("StockCode").alias("TotalItemsSold"),
        sketch.build("CustomerID", F.lit(sketch.log_slots)).alias("Customers"),
        sketch.build("StockCode", F.lit(sketch.log_slots)).alias("Products"),
    )


def united(partials: DataFrame, *by: str, sketch: Sketch = THETA) -> DataFrame:
    """Partials added up and their sketches united, to one row per country and values of ``by``."""
    return partials.groupBy("Country", *by).agg(
        *[F.sum(c).alias(c) for c in _SUMS],
        sketch.unite("Customers", sketch.log_slots).alias("Customers"),
        sketch.unite("Products", sketch.log_slots).alias("Products"),
    )


def gold_from_partials(partials: DataFrame, *, sketch: Sketch = THETA) -> DataFrame:
    """The gold table out of partials: exact sums, estimated distinct counts."""
    return united(partials, sketch=sketch).select(
        "Country",
        *_SUMS,
        sketch.estimate("Customers").alias("UniqueCustomers"),
        sketch.estimate("Products").alias("UniqueProductsSold"),
    )
