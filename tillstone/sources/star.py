"""Raw retail transactions derived from star-schema order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Only the columns that are used; a declared schema also saves reading footers up front.
_TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_returnflag string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string, p_retailprice double",
}


def star_table(spark: SparkSession, tables_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_TABLES[name]).parquet(f"{tables_dir}/{name}.parquet")


def retail_from_star(spark: SparkSession, tables_dir: str) -> DataFrame:
    """One raw retail row per order line, with the defects real exports have.

    Stock codes are padded, returned lines have a negative quantity, lines
    numbered 7 are free, and every tenth customer is a guest without an id.

    The order-sized joins run first, so the line-sized table is shuffled once
    for its orders and once for its parts however large the dimensions are.
    Broadcasts are left to Catalyst, which checks the size of each side.
    """

    def table(name: str) -> DataFrame:
        return star_table(spark, tables_dir, name)

    buyers = (
        table("orders")
        .join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    lines = (
        table("lineitem")
        .join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    signed_quantity = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    price = F.when(F.col("l_linenumber") == 7, F.lit(0.0)).otherwise(F.col("p_retailprice"))
    buyer_id = F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey"))
    return lines.select(
        F.col("l_orderkey").cast("string").alias("InvoiceNo"),
        F.concat(F.lit("  "), F.col("l_partkey").cast("string"), F.lit(" ")).alias("StockCode"),
        F.col("p_name").alias("Description"),
        signed_quantity.cast("int").alias("Quantity"),
        F.date_format("o_orderdate", "dd/MM/yyyy HH:mm").alias("InvoiceDate"),
        price.cast("float").alias("UnitPrice"),
        buyer_id.cast("float").alias("CustomerID"),
        F.col("n_name").alias("Country"),
        F.col("l_linenumber"),
    )
