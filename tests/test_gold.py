"""Per-country aggregation."""

from __future__ import annotations

import pytest

from tillstone.operators.gold import gold_by_country, sort_gold
from tillstone.operators.guards import MissingColumnsError
from tillstone.schema import GOLD_DDL
from pyspark.sql.types import StructType


def test_gold_values_and_types(silver):
    rows = silver(
        {"Quantity": 2, "UnitPrice": 1.5},
        {"Quantity": 3, "UnitPrice": 2.0, "StockCode": "B"},
        {"InvoiceNo": None, "StockCode": None, "CustomerID": 8},
    )
    gold = gold_by_country(rows)
    assert [(f.name, f.dataType) for f in gold.schema] == [(f.name, f.dataType) for f in StructType.fromDDL(GOLD_DDL)]
    # Transactions and items count lines with a value, so invoice "1" counts twice.
    assert gold.first() == ("France", 2, 10.0, 6, 2, 2, 2)


def test_null_and_empty_country_are_separate_groups(silver):
    gold = sort_gold(gold_by_country(silver({"Country": None}, {"Country": ""}, {"Country": "B"}, {"Country": "A"})))
    assert [r.Country for r in gold.collect()] == [None, "", "A", "B"]


def test_no_rows_give_no_groups(silver):
    assert gold_by_country(silver({}).limit(0)).count() == 0


def test_approximate_distinct(silver):
    rows = silver(*({"CustomerID": i} for i in range(50)))
    assert abs(gold_by_country(rows, approx=True).first().UniqueCustomers - 50) <= 5


@pytest.mark.parametrize("column", ["Country", "InvoiceNo", "StockCode"])
def test_missing_input(silver, column):
    with pytest.raises(MissingColumnsError, match=column):
        gold_by_country(silver({}).drop(column))


def test_transactions_add_up(silver):
    rows = silver(*({"Country": f"C{i % 5}", "InvoiceNo": str(i) if i % 3 else None} for i in range(60)))
    total = sum(r.TotalTransactions for r in gold_by_country(rows).collect())
    assert total == rows.where("InvoiceNo is not null").count() == 40
