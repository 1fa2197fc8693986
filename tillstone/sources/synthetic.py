"""Seeded retail rows in the raw file's shape, for any number of row ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.functions.hashing import hash_bucket

# The domains of the generated columns.
COUNTRIES = ("United Kingdom", "France", "Germany", "Spain")
FIRST_STOCK_CODE, STOCK_CODES = 100, 899
PRODUCTS = 49
MAX_QUANTITY = 99
DAYS_BACK = 364
MIN_PRICE_CENTS, MAX_PRICE_CENTS = 50, 5000
FIRST_CUSTOMER, CUSTOMERS = 10000, 10000


# Which digest and which part of it each field is drawn from.
_DRAWS = {
    "stock": (0, 0),
    "product": (0, 1),
    "quantity": (0, 2),
    "day": (0, 3),
    "price": (1, 0),
    "customer": (1, 1),
    "country": (1, 2),
}


def retail_from_ids(
    ids: DataFrame, id_column: str = "id", seed: int = 42, anchor: str = "2024-01-01 12:00:00"
) -> DataFrame:
    """One raw retail row per id, each value drawn from an MD5 of (seed, digest number, id).

    No shuffle and no random state: the rows do not depend on how ids are partitioned.
    Dates lie within the year before ``anchor`` and carry its time of day.
    """
    row_id = F.col(id_column).cast("string")

    def draw(field: str, size: int) -> Column:
        digest, part = _DRAWS[field]
        return hash_bucket(F.concat(F.lit(f"{seed}|{digest}|"), row_id), size, part)

    day = F.date_sub(F.lit(anchor).cast("date"), (draw("day", DAYS_BACK) + 1).cast("int"))
    country = F.element_at(F.array(*(F.lit(c) for c in COUNTRIES)), (draw("country", len(COUNTRIES)) + 1).cast("int"))
    return ids.select(
        F.concat(F.lit("I"), F.lpad(row_id, F.greatest(F.lit(6), F.length(row_id)), F.lit("0"))).alias("InvoiceNo"),
        F.concat(F.lit("S"), draw("stock", STOCK_CODES) + FIRST_STOCK_CODE).alias("StockCode"),
        F.concat(F.lit("Product "), draw("product", PRODUCTS) + 1).alias("Description"),
        (draw("quantity", MAX_QUANTITY) + 1).cast("int").alias("Quantity"),
        F.concat(F.date_format(day, "dd/MM/yyyy "), F.lit(anchor[11:16])).alias("InvoiceDate"),
        ((draw("price", MAX_PRICE_CENTS - MIN_PRICE_CENTS + 1) + MIN_PRICE_CENTS) / 100).alias("UnitPrice"),
        (draw("customer", CUSTOMERS) + FIRST_CUSTOMER).alias("CustomerID"),
        country.alias("Country"),
    )


def synthetic_retail(spark: SparkSession, rows: int = 1000, seed: int = 42) -> DataFrame:
    """``rows`` generated transactions with ids from zero."""
    return retail_from_ids(spark.range(rows), "id", seed)
