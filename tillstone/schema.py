"""Declared schemas of every layer, as Spark DDL strings."""

from __future__ import annotations

# Column names and order are part of the data contract.
RAW_COLUMNS = (
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "UnitPrice",
    "CustomerID",
    "Country",
)
AUDIT_COLUMN = "ingestion_timestamp"
REJECT_COLUMN = "rejected_line"
TRIMMED_COLUMNS = ("InvoiceNo", "StockCode", "Description", "Country")
SILVER_COLUMNS = (
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "UnitPrice",
    "CustomerID",
    "Country",
    AUDIT_COLUMN,
)
GOLD_INPUT_COLUMNS = ("Country", "InvoiceNo", "Quantity", "UnitPrice", "CustomerID", "StockCode")

SILVER_DDL = (
    "InvoiceNo string, StockCode string, Description string, Quantity int, UnitPrice double, "
    f"CustomerID bigint, Country string, {AUDIT_COLUMN} timestamp"
)
GOLD_DDL = (
    "Country string, TotalTransactions bigint, TotalRevenue double, TotalQuantitySold bigint, "
    "TotalItemsSold bigint, UniqueCustomers bigint, UniqueProductsSold bigint"
)


def raw_ddl(price_type: str = "float", id_type: str = "float") -> str:
    """Schema of the raw file.

    Prices and customer ids are float32 by default: 2.55 is stored as
    2.549999952316284 and ids are exact only up to 2^24. Pass ``"double"`` /
    ``"bigint"`` to keep them exact.
    """
    return (
        "InvoiceNo string, StockCode string, Description string, Quantity int, "
        f"InvoiceDate string, UnitPrice {price_type}, CustomerID {id_type}, Country string"
    )


def bronze_ddl(price_type: str = "float", id_type: str = "float") -> str:
    return f"{raw_ddl(price_type, id_type)}, {AUDIT_COLUMN} timestamp"
