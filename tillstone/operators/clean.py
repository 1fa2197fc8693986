"""Bronze to silver: type, filter, trim and project."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.operators.guards import require_any_column, require_columns
from tillstone.schema import SILVER_COLUMNS, TRIMMED_COLUMNS

_REQUIRED = ("Quantity", "UnitPrice", "CustomerID")


def drop_invoice_date(df: DataFrame) -> DataFrame:
    return df.drop("InvoiceDate")


def _quantity_ok() -> Column:
    return F.col("Quantity").isNotNull() & (F.col("Quantity") > 0)


def _price_ok(reject_nan: bool) -> Column:
    # NaN sorts above every number, so a NaN price passes "> 0" unless rejected.
    positive = F.col("UnitPrice").isNotNull() & (F.col("UnitPrice") > 0)
    return positive & ~F.isnan("UnitPrice") if reject_nan else positive


def _customer_given(df: DataFrame) -> Column:
    # Two plain predicates rather than na.drop, so that the null test reaches the scan.
    given = F.col("CustomerID").isNotNull()
    return given & ~F.isnan("CustomerID") if dict(df.dtypes)["CustomerID"] in ("float", "double") else given


def _customer_castable() -> Column:
    # An infinite or out-of-range id has no bigint value.
    return F.col("CustomerID").try_cast("bigint").isNotNull()


def filter_quantity(df: DataFrame) -> DataFrame:
    """Keep lines with a positive quantity; this is also what removes cancellations."""
    return df.where(_quantity_ok())


def filter_price(df: DataFrame, *, reject_nan: bool = False) -> DataFrame:
    return df.where(_price_ok(reject_nan))


def filter_customer(df: DataFrame) -> DataFrame:
    """Keep lines whose customer id is neither null nor NaN. Run before casting the id."""
    return df.where(_customer_given(df))


def cast_measures(df: DataFrame) -> DataFrame:
    """Quantity to int and UnitPrice to double; values without one become null."""
    return df.withColumns(
        {"Quantity": F.col("Quantity").try_cast("int"), "UnitPrice": F.col("UnitPrice").try_cast("double")}
    )


def cast_customer(df: DataFrame) -> DataFrame:
    return df.withColumn("CustomerID", F.col("CustomerID").try_cast("bigint"))


def trim_strings(df: DataFrame, columns: Sequence[str] = TRIMMED_COLUMNS) -> DataFrame:
    """Strip spaces (U+0020 only) from those of ``columns`` that exist and hold strings."""
    types = dict(df.dtypes)
    return df.withColumns({c: F.trim(c) for c in columns if types.get(c) == "string"})


def select_silver(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Project to the silver columns that exist, in order, then ``extra``."""
    kept = [c for c in (*SILVER_COLUMNS, *extra) if c in df.columns]
    if not kept:
        raise ValueError(f"silver: none of {SILVER_COLUMNS} is present, found {df.columns}")
    return df.select(*kept)


def clean(df: DataFrame, *, reject_nan_price: bool = False, extra: Sequence[str] = ()) -> DataFrame:
    """Bronze rows to silver rows; one scan, no shuffle."""
    require_any_column(df, "clean")
    require_columns(df, _REQUIRED, "clean")
    return (
        df.transform(drop_invoice_date)
        .transform(cast_measures)
        .transform(filter_quantity)
        .transform(filter_price, reject_nan=reject_nan_price)
        .transform(filter_customer)
        .where(_customer_castable())
        .transform(cast_customer)
        .transform(trim_strings)
        .transform(select_silver, extra)
    )


def funnel_metrics(df: DataFrame, *, reject_nan_price: bool = False) -> list[Column]:
    """Row counts left after each cleaning step, as aggregates over typed bronze rows."""
    quantity = _quantity_ok()
    price = quantity & _price_ok(reject_nan_price)
    customer = price & _customer_given(df)
    return [
        F.count(F.lit(1)).alias("bronze_rows"),
        F.count_if(quantity).alias("after_quantity"),
        F.count_if(price).alias("after_price"),
        F.count_if(customer).alias("after_customer"),
        F.count_if(customer & _customer_castable()).alias("silver_rows"),
    ]


def cleaning_funnel(df: DataFrame, *, reject_nan_price: bool = False) -> DataFrame:
    """All stage counts in one aggregation that reads three columns."""
    require_columns(df, _REQUIRED, "cleaning_funnel")
    typed = df.select(*_REQUIRED).transform(cast_measures)
    return typed.agg(*funnel_metrics(typed, reject_nan_price=reject_nan_price))
