"""Every query against DuckDB on the given tables. TEST_SF picks the scale."""

from __future__ import annotations

import os
from pathlib import Path

import pytest

import __spark_entry__ as driver
from checks.oracle import ORACLE
from checks.queries import QUERIES

duckdb = pytest.importorskip("duckdb")
TABLES = Path("/root/testdata") / os.environ.get("TEST_SF", "sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in TABLES.glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def _sorted_rows(rows, columns):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(r[i] for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", ORACLE)
def test_matches_sql(spark, duck, name):
    df = driver.queries()[name](spark, str(TABLES))
    expected = duck.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    assert sorted(df.columns) == sorted(columns)
    assert _sorted_rows(df.collect(), df.columns) == _sorted_rows(expected.fetchall(), columns)


def test_every_query_but_the_forest_has_sql():
    assert set(QUERIES) - set(ORACLE) == {"forest_predictions"}
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())


def test_forest_scores_every_test_row(spark):
    from checks import queries as q

    scored = driver.queries()["forest_predictions"](spark, str(TABLES))
    held_out = q.split_train_test(spark, str(TABLES)).where("not is_train")
    assert scored.where("prediction is not null").count() == held_out.count() > 0


def test_gold_sorted_is_in_country_order(spark):
    countries = [r.Country for r in driver.queries()["gold_sorted"](spark, str(TABLES)).collect()]
    assert countries == sorted(countries)


def test_entry_runs(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["gold_country", "index_stock", "scale_features", "eval_r2"])
def test_matches_sql_without_broadcasts(spark, duck, conf, name):
    """The plans a cluster uses once no side is small enough to broadcast."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    test_matches_sql(spark, duck, name)
