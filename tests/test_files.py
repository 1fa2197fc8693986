"""File ranges, placement, reads by range, rejects and quoting dialects."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tillstone.plans.medallion import FlowConfig, build_silver, ingest, read_bronze, read_rejects
from tillstone.schema import RAW_COLUMNS, REJECT_COLUMN
from tillstone.sources.csv_files import read_retail_csv, write_retail_csv
from tillstone.sources.layers import LayerStore, clustered, overlapping

DDL = "k int, country string"


@pytest.fixture
def ranged(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    rows = spark.range(1000).select((F.col("id") * 37 % 1000).cast("int").alias("k"), F.lit("x").alias("country"))
    store.overwrite("t", clustered(rows.repartition(5), ("k",), files=8))
    store.index_files("t", DDL, ("k",))
    return store


def test_clustered_files_do_not_overlap_and_plain_ones_do(spark, ranged):
    ranges = ranged.file_ranges("t", DDL, ("k",))
    assert ranges.count() > 4 and ranges.agg(F.sum("rows")).first()[0] == 1000
    assert overlapping(ranges, "k").count() == 0
    ranged.overwrite("u", ranged.read("t", DDL).repartition(4))
    assert overlapping(ranged.file_ranges("u", DDL, ("k",)), "k").count() == 3


@pytest.mark.parametrize("low, high, n", [(0, 0, 1), (120, 340, 221), (990, 5000, 10), (-5, 2000, 1000), (5000, 6000, 0)])
def test_a_read_by_range_opens_the_files_of_that_range_alone(ranged, low, high, n):
    got = ranged.read_within("t", DDL, "k", low, high)
    assert got.columns == ["k", "country"] and got.count() == n
    assert sorted(r.k for r in got.collect()) == [k for k in range(1000) if low <= k <= high]
    files = ranged.files_within("t", "k", low, high)
    assert len(got.inputFiles()) == files.count()
    assert n > 300 or files.count() < ranged.file_ranges("t", DDL, ()).count()


def test_the_index_is_no_part_of_the_layer(ranged):
    assert ranged.read("t", DDL).count() == 1000
    ranged.index_files("t", DDL, ("k",))  # again, in place
    assert ranged.read("t", DDL).count() == 1000


def test_ranges_of_partitions_whose_names_need_escapes(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    rows = spark.range(60).select(F.col("id").cast("int").alias("k"), F.when(F.col("id") < 30, "United Kingdom").otherwise("A+B%c").alias("country"))
    store.overwrite("t", rows, partition_by=("country",))
    store.index_files("t", DDL, ("k",))
    got = store.read_within("t", DDL, "k", 5, 35).collect()
    assert {(r.k, r.country) for r in got} == {(k, "United Kingdom" if k < 30 else "A+B%c") for k in range(5, 36)}


def test_placement_tells_values_in_one_file_from_split_ones(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    rows = spark.range(90).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("c"), (F.col("id") % 3).cast("string")).alias("country"))
    store.overwrite("together", rows.repartition(4), rebalance_by=("country",))
    store.overwrite("apart", rows.repartition(4))
    assert {(r.rows, r.files) for r in store.placement("together", DDL, "country").collect()} == {(30, 1)}
    assert all(r.rows == 30 and r.files > 1 for r in store.placement("apart", DDL, "country").collect())


def test_clustered_ignores_absent_columns(spark):
    rows = spark.range(3)
    assert clustered(rows, ("nothing",)) is rows


@pytest.fixture
def spoiled(tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        ",".join(RAW_COLUMNS)
        + "\nI1,S1,thing,5,01/01/2011 10:00,2.5,7,France\nI2,S1,thing,five,01/01/2011 10:00,2.5,7,France\n"
        + "I3,S1,thing,5,01/01/2011 10:00,,7,France\nI4,S1,thing,5,01/01/2011 10:00,2.5\n"
        + "I5,S1,thing,99999999999,01/01/2011 10:00,x,y,France\n"
    )
    return str(path)


def test_rejects_keep_the_row_and_its_line(spark, tmp_path, spoiled):
    store = LayerStore(spark, str(tmp_path / "lake"))
    cfg = FlowConfig(spoiled, store.root, ingested_at=datetime(2024, 1, 1), keep_rejects=True)
    funnel = ingest(store, cfg)
    assert funnel["bronze_rows"] == 5 and REJECT_COLUMN not in read_bronze(store, cfg).columns
    rejects = {r.InvoiceNo: r[REJECT_COLUMN] for r in read_rejects(store, cfg).collect()}
    assert rejects.keys() == {"I2", "I4", "I5"}
    assert rejects["I2"] == "I2,S1,thing,five,01/01/2011 10:00,2.5,7,France"
    kept = {r.InvoiceNo: (r.Quantity, r.UnitPrice, r.CustomerID) for r in read_bronze(store, cfg).collect()}
    assert kept["I2"] == (None, 2.5, 7.0) and kept["I3"] == (5, None, 7.0)
    assert kept["I5"] == (None, None, None) and kept["I4"] == (5, 2.5, None)
    assert build_silver(store, cfg) == funnel["silver_rows"] == 1


def test_rejects_are_skipped_by_statistics(spark, tmp_path, spoiled):
    store = LayerStore(spark, str(tmp_path / "lake"))
    cfg = FlowConfig(spoiled, store.root, keep_rejects=True)
    ingest(store, cfg)
    plan = read_rejects(store, cfg)._jdf.queryExecution().toString()
    assert f"PushedFilters: [IsNotNull({REJECT_COLUMN})]" in plan


def test_without_rejects_nothing_changes(spark, spoiled):
    assert read_retail_csv(spark, spoiled).columns == list(RAW_COLUMNS)
    assert read_retail_csv(spark, spoiled).count() == 5


def test_doubled_quotes_are_read_by_several_tasks_of_one_file(spark, tmp_path, conf):
    path = tmp_path / "raw.csv"
    line = 'I{},S1,"HEART ""LOVE"" X, {}",5,01/01/2011 10:00,2.5,7,France\n'
    path.write_text(",".join(RAW_COLUMNS) + "\n" + "".join(line.format(i, i) for i in range(4000)))
    conf(spark__sql__files__maxPartitionBytes="40000", spark__sql__files__openCostInBytes="0", spark__sql__files__minPartitionNum="8")
    rows = read_retail_csv(spark, str(path), dialect="doubled")
    assert rows.rdd.getNumPartitions() > 3
    assert {r.Description for r in rows.collect()} == {f'HEART "LOVE" X, {i}' for i in range(4000)}
    assert read_retail_csv(spark, str(path), dialect="rfc4180").rdd.getNumPartitions() == 1
    plain = read_retail_csv(spark, str(path)).select("InvoiceNo", "Description")
    assert plain.where(F.col("Description").contains('""LOVE""')).count() > 0


@pytest.mark.parametrize("dialect", ["doubled", "rfc4180"])
def test_quotes_survive_a_round_trip(spark, tmp_path, bronze, dialect):
    rows = bronze(*[{"Description": d} for d in ('a "b" c', '"', "x, y", '""', "back\\slash")])
    write_retail_csv(rows, str(tmp_path / "csv"), dialect=dialect)
    got = read_retail_csv(spark, str(tmp_path / "csv"), dialect=dialect)
    assert sorted(r.Description for r in got.collect()) == sorted(r.Description for r in rows.collect())
