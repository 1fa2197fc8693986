from __future__ import annotations

import pytest
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tillstone.operators.features import assemble
from tillstone.operators.moments import MomentStore, deviation, merged, part_moments

COLUMNS = ("a", "b", "c")


def _rows(spark, n=300):
    return spark.range(n).select(
        (F.col("id") * 1.5).alias("a"),
        (1e9 + F.col("id") % 7).alias("b"),  # a mean that is large against the spread
        F.lit(4.0).alias("c"),
        (F.col("id") % 6).cast("int").alias("part"),
    )


def test_merged_parts_equal_the_whole(spark):
    rows = _rows(spark)
    got = {r.feature: r for r in merged(part_moments(rows, COLUMNS, "part")).collect()}
    for c in COLUMNS:
        want = rows.agg(F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("s")).first()
        assert got[c].n == want.n and abs(got[c].mean - want.mean) <= 1e-9 * abs(want.mean)
        assert abs((got[c].squares / (want.n - 1)) ** 0.5 - want.s) <= 1e-6


def test_scaler_equals_a_fit_on_all_rows(spark, tmp_path):
    rows = _rows(spark)
    store = MomentStore(spark, str(tmp_path / "m"), COLUMNS)
    store.add_all(rows.where("part < 4"), "part")
    store.add(rows.where("part = 4"), "4")
    store.add(rows.where("part = 5"), "5")
    table = assemble(rows, COLUMNS)
    model = StandardScaler(inputCol="features", outputCol="own", withStd=True, withMean=False).fit(table)
    both = store.scaler().transform(model.transform(table))
    both = both.select(vector_to_array("own").alias("x"), vector_to_array("scaledFeatures").alias("y"))
    for row in both.collect():
        assert all(abs(x - y) <= 1e-6 * max(1, abs(x)) for x, y in zip(row.x, row.y))
        assert row.y[2] == 0.0


def test_a_part_is_recorded_once(spark, tmp_path):
    store = MomentStore(spark, str(tmp_path / "m"), COLUMNS)
    store.add(_rows(spark), "day 1")
    with pytest.raises(ValueError, match="day 1"):
        store.add(_rows(spark), "day 1")


def test_nulls_single_values_and_empty_parts(spark, tmp_path):
    rows = spark.createDataFrame([(1.0, None, 5.0), (3.0, None, None)], "a double, b double, c double")
    found = {r.feature: r for r in part_moments(rows, COLUMNS).collect()}
    assert found.keys() == {"a", "c"} and (found["c"].n, found["c"].squares) == (1, 0.0)
    assert part_moments(rows.limit(0), COLUMNS).collect() == []
    one = merged(part_moments(rows, COLUMNS)).select("feature", deviation(F.col("n"), F.col("squares")).alias("s"))
    assert {r.feature: r.s for r in one.collect()} == {"a": 2**0.5, "c": None}
    store = MomentStore(spark, str(tmp_path / "m"), COLUMNS)
    store.add(rows, "x")
    assert list(store.scaler().getScalingVec()) == [1 / 2**0.5, 0.0, 0.0]
