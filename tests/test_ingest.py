"""Raw file reading: binding, bad cells, quoting, number types."""

from __future__ import annotations

import math
from datetime import datetime

import pytest

from tillstone.schema import RAW_COLUMNS
from tillstone.sources.csv_files import read_retail_csv, with_audit, write_retail_csv

HEADER = ",".join(RAW_COLUMNS)


@pytest.fixture
def csv(tmp_path):
    def write(*lines: str, header: str = HEADER) -> str:
        path = tmp_path / "raw.csv"
        path.write_text("\n".join((header, *lines)) + "\n")
        return str(path)

    return write


def test_columns_bind_by_position(spark, csv):
    header = ",".join(reversed(RAW_COLUMNS))
    row = read_retail_csv(spark, csv("536365,A1,mug,6,01/12/2010 08:26,2.5,17850,France", header=header)).first()
    assert (row.InvoiceNo, row.Quantity, row.Country) == ("536365", 6, "France")


def test_strict_header_rejects_other_order(spark, csv):
    path = csv("536365,A1,mug,6,01/12/2010 08:26,2.5,17850,France", header=",".join(reversed(RAW_COLUMNS)))
    with pytest.raises(Exception, match="(?i)header"):
        read_retail_csv(spark, path, strict_header=True).collect()


def test_strict_header_accepts_declared_order(spark, csv):
    assert read_retail_csv(spark, csv("1,A,x,6,d,2.5,1,F"), strict_header=True).first().Quantity == 6


@pytest.mark.parametrize("cell", ["abc", "99999999999", "6.0"])
def test_bad_quantity_becomes_null_and_row_stays(spark, csv, cell):
    row = read_retail_csv(spark, csv(f"1,A,x,{cell},d,2.5,1,France")).first()
    assert row.Quantity is None and row.Country == "France"


def test_short_row_is_filled_with_nulls(spark, csv):
    row = read_retail_csv(spark, csv("1,A,x")).first()
    assert row.asDict() == dict.fromkeys(RAW_COLUMNS) | {"InvoiceNo": "1", "StockCode": "A", "Description": "x"}


QUOTED = '1,A,"HEART ""LOVE"" X",6,d,2.5,1,France'


def test_default_dialect_keeps_doubled_quotes_as_written(spark, csv):
    assert '""LOVE""' in read_retail_csv(spark, csv(QUOTED)).first().Description


def test_rfc4180_reads_doubled_quotes(spark, csv):
    assert read_retail_csv(spark, csv(QUOTED), dialect="rfc4180").first().Description == 'HEART "LOVE" X'


def test_line_break_in_quotes(spark, csv):
    path = csv('1,A,"line1\nline2",6,d,2.5,1,France')
    assert read_retail_csv(spark, path).count() == 2
    rows = read_retail_csv(spark, path, dialect="rfc4180").collect()
    assert [r.Description for r in rows] == ["line1\nline2"]


def test_unknown_dialect(spark):
    with pytest.raises(ValueError, match="dialect"):
        read_retail_csv(spark, "/nowhere", dialect="tsv")


def test_numbers_are_float32_unless_asked_otherwise(spark, csv):
    path = csv("1,A,x,6,d,2.55,16777217,France")
    row = read_retail_csv(spark, path).first()
    assert (row.UnitPrice, row.CustomerID) == (2.549999952316284, 16777216.0)
    exact = read_retail_csv(spark, path, price_type="double", id_type="bigint").first()
    assert (exact.UnitPrice, exact.CustomerID) == (2.55, 16777217)


def test_nan_text_is_parsed(spark, csv):
    assert math.isnan(read_retail_csv(spark, csv("1,A,x,6,d,2.5,NaN,France")).first().CustomerID)


@pytest.mark.parametrize("dialect", ["spark", "rfc4180"])
def test_written_rows_read_back(spark, bronze, tmp_path, dialect):
    rows = bronze({"StockCode": "  1616 "}, {"Description": 'a "b", c'}, {"CustomerID": None})
    write_retail_csv(rows, str(tmp_path / "out"), dialect=dialect)
    back = read_retail_csv(spark, str(tmp_path / "out"), dialect=dialect)
    assert sorted(back.collect(), key=str) == sorted(rows.collect(), key=str)


def test_audit_time_is_one_value_per_query(spark):
    assert with_audit(spark.range(1000, numPartitions=4)).select("ingestion_timestamp").distinct().count() == 1


def test_audit_time_can_be_fixed(spark):
    assert with_audit(spark.range(1), datetime(2024, 1, 2)).first().ingestion_timestamp == datetime(2024, 1, 2)
