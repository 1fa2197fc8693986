"""Schema and emptiness checks."""

from __future__ import annotations

import logging

import pytest
from pyspark.sql.types import StructType

from tillstone.operators.clean import clean, select_silver
from tillstone.operators.guards import MissingColumnsError, require_any_column, require_columns, warn_if_empty


def test_table_without_columns(spark):
    empty = spark.createDataFrame([], StructType([]))
    with pytest.raises(ValueError, match="no columns"):
        require_any_column(empty, "bronze")
    with pytest.raises(ValueError, match="no columns"):
        clean(empty)


def test_empty_input_warns_and_goes_on(spark, caplog):
    with caplog.at_level(logging.WARNING):
        assert warn_if_empty(spark.range(0), "bronze")
        assert not warn_if_empty(spark.range(1), "silver")
    assert [r.getMessage().split(":")[0] for r in caplog.records] == ["bronze"]


def test_no_silver_column_left(spark):
    with pytest.raises(ValueError, match="none of"):
        select_silver(spark.range(1))


def test_missing_columns_are_listed(spark):
    with pytest.raises(MissingColumnsError, match=r"\['a', 'b'\]"):
        require_columns(spark.range(1), ("a", "id", "b"), "stage")
