"""Generated rows: domains and repeatability."""

from __future__ import annotations

from datetime import datetime, timedelta

from tillstone.schema import RAW_COLUMNS
from tillstone.sources.synthetic import COUNTRIES, retail_from_ids, synthetic_retail


def test_domains(spark):
    rows = synthetic_retail(spark, 4000).collect()
    assert list(rows[0].asDict()) == list(RAW_COLUMNS)
    assert [r.InvoiceNo for r in sorted(rows)][:2] == ["I000000", "I000001"]
    assert {r.StockCode for r in rows} <= {f"S{i}" for i in range(100, 999)}
    assert {r.Description for r in rows} == {f"Product {i}" for i in range(1, 50)}
    assert {r.Quantity for r in rows} == set(range(1, 100))
    assert {r.Country for r in rows} == set(COUNTRIES)
    assert all(10000 <= r.CustomerID < 20000 for r in rows)
    assert all(0.5 <= r.UnitPrice <= 50.0 and round(r.UnitPrice, 2) == r.UnitPrice for r in rows)
    days = {datetime(2024, 1, 1, 12) - datetime.strptime(r.InvoiceDate, "%d/%m/%Y %H:%M") for r in rows}
    assert min(days) == timedelta(days=1) and max(days) == timedelta(days=364)


def test_long_ids_are_not_cut(spark):
    ids = spark.createDataFrame([(12345678,), (7,)], "id bigint")
    assert [r.InvoiceNo for r in retail_from_ids(ids).collect()] == ["I12345678", "I000007"]


def test_rows_do_not_depend_on_partitions(spark):
    rows = [sorted(retail_from_ids(spark.range(500).repartition(n)).collect()) for n in (1, 7)]
    assert rows[0] == rows[1]


def test_seed_changes_rows(spark):
    assert synthetic_retail(spark, 50, seed=1).collect() != synthetic_retail(spark, 50, seed=2).collect()
