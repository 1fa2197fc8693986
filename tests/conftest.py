from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tillstone.schema import raw_ddl  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    changed = {}

    def set_all(**options):
        for name, value in options.items():
            key = name.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_all
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


SILVER = (
    "InvoiceNo string, StockCode string, Description string, Quantity int, "
    "UnitPrice double, CustomerID bigint, Country string"
)


@pytest.fixture
def bronze(spark):
    """Build bronze rows from the fields that matter to a test."""

    def build(*rows: dict):
        base = {
            "InvoiceNo": "1",
            "StockCode": "A",
            "Description": "thing",
            "Quantity": 1,
            "InvoiceDate": "01/01/2011 10:00",
            "UnitPrice": 1.0,
            "CustomerID": 7.0,
            "Country": "France",
        }
        return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], raw_ddl())

    return build


@pytest.fixture
def silver(spark):
    def build(*rows: dict):
        base = {
            "InvoiceNo": "1",
            "StockCode": "A",
            "Description": "thing",
            "Quantity": 1,
            "UnitPrice": 1.0,
            "CustomerID": 7,
            "Country": "France",
        }
        return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], SILVER)

    return build
