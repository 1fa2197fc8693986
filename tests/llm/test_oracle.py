"""The queries that SQL can express, beside DuckDB on the given tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from tillstone.llm.oracle import ORACLE
from tillstone.llm.queries import QUERIES

TABLES = Path("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", ORACLE)
def test_equals_duckdb(spark, name):
    con = duckdb.connect()
    for path in TABLES.glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    got = QUERIES[name](spark, str(TABLES))
    found = con.execute(ORACLE[name])  # as Python values: a data frame would make floats of integers beside nulls
    order = [[c[0] for c in found.description].index(c) for c in got.columns]
    want = [tuple(row[i] for i in order) for row in found.fetchall()]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
