"""Label indexing, assembling, scaling and the split."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks import queries as q
from tillstone.operators import features
from tillstone.operators.features import (
    FeatureModel,
    assemble,
    fit_features,
    fit_labels,
    fit_scaler,
    index_column,
    with_split,
)
from tillstone.sources.paths import scratch_dir

SF = "/root/testdata/sf0.001"


def _labels(spark, df, column):
    rows = fit_labels(df, [column], scratch_dir(spark, "labels"))[column].collect()
    return [r.label for r in sorted(rows, key=lambda r: r.label_index)], sorted(r.label_index for r in rows)


def _values(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def test_labels_by_frequency_then_name(spark):
    assert _labels(spark, _values(spark, "b", "a", "c", "c", None), "v") == (["c", "a", "b"], [0.0, 1.0, 2.0])


def test_no_rows_fit_no_labels(spark):
    assert _labels(spark, _values(spark, "a").limit(0), "v") == ([], [])


@pytest.mark.parametrize("column", ["Country", "StockCode"])
def test_same_labels_as_mllib(spark, column):
    rows = q.silver(spark, SF)
    expected = StringIndexer(inputCol=column, outputCol="i").fit(rows).labels
    assert _labels(spark, rows, column) == (expected, [float(i) for i in range(len(expected))])


def test_labels_over_many_sort_partitions(spark, conf, monkeypatch):
    """The index runs on across partitions, also where equal counts straddle them."""
    conf(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="7")
    monkeypatch.setattr(features, "remove", lambda *_: None)
    rows = spark.range(3000).select(F.concat(F.lit("s"), F.col("id") % F.lit(997)).alias("v"))
    path = scratch_dir(spark, "labels")
    labels = fit_labels(rows, ["v"], path)["v"]
    places = spark.read.parquet(f"{path}/sorted").select(F.shiftright("place", 33).alias("part")).distinct()
    assert places.count() > 1
    expected = StringIndexer(inputCol="v", outputCol="i").fit(rows).labels
    assert [r.label for r in labels.orderBy("label_index").collect()] == expected
    assert labels.select(F.min("label_index"), F.max("label_index"), F.count_distinct("label_index")).first() == (
        0.0,
        996.0,
        997,
    )


def test_columns_are_indexed_apart(spark, conf):
    """Two columns share the sort, and one sort partition may hold labels of both."""
    conf(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="5")
    rows = spark.range(600).select(
        F.concat(F.lit("a"), F.col("id") % 101).alias("a"), F.concat(F.lit("b"), F.col("id") % 67).alias("b")
    )
    both = fit_labels(rows, ["a", "b"], scratch_dir(spark, "labels"))
    for column in ("a", "b"):
        expected = StringIndexer(inputCol=column, outputCol="i").fit(rows).labels
        found = both[column].orderBy("label_index").collect()
        assert [r.label for r in found] == expected
        assert [r.label_index for r in found] == [float(i) for i in range(len(expected))]


@pytest.fixture
def abc(spark):
    return fit_labels(_values(spark, "b", "a", "c", "c"), ["v"], scratch_dir(spark, "labels"))["v"]


@pytest.mark.parametrize("value, shown", [(None, "null"), ("zz", "'zz'")])
def test_null_and_unseen_values_raise(spark, abc, value, shown):
    with pytest.raises(Exception, match=f"v value {shown} was not indexed"):
        index_column(_values(spark, "a", value), abc, "v", "i").collect()


def test_null_and_unseen_values_can_be_skipped_or_kept(spark, abc):
    rows = _values(spark, "a", None, "zz", "c")
    assert sorted(index_column(rows, abc, "v", "i", "skip").collect()) == [("a", 1.0), ("c", 0.0)]
    kept = index_column(rows, abc, "v", "i", "keep").collect()
    assert sorted(kept, key=str) == [("a", 1.0), ("c", 0.0), ("zz", 3.0), (None, 3.0)]


def test_unknown_handling(spark, abc):
    with pytest.raises(ValueError, match="handle_invalid"):
        index_column(_values(spark, "a"), abc, "v", "i", "ignore")


def test_hot_label_without_broadcast(spark, conf):
    """One label holds half of all rows and the label table is joined by a shuffle."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    rows = spark.range(40000, numPartitions=8).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("v")
    )
    labels = fit_labels(rows, ["v"], scratch_dir(spark, "labels"))["v"]
    indexed = index_column(rows, labels, "v", "i")
    assert indexed.where("i = 0").count() == 20000
    assert indexed.agg(F.count_distinct("i")).first()[0] == 20001
    assert indexed.count() == 40000


def _matrix(*rows, spark):
    ddl = "CustomerID bigint, UnitPrice double, CountryIndex double, StockCodeIndex double"
    return spark.createDataFrame(list(rows), ddl)


def test_assemble_order(spark):
    out = assemble(_matrix((7, 2.5, 0.0, 3.0), spark=spark))
    assert out.select(vector_to_array("features")).first()[0] == [7.0, 2.5, 0.0, 3.0]


def test_assembling_null_raises(spark):
    with pytest.raises(Exception, match="(?i)null"):
        assemble(_matrix((7, None, 0.0, 3.0), spark=spark)).collect()


def test_scaling(spark):
    df = assemble(_matrix((1, 5.0, 0.0, 0.0), (3, 5.0, 1.0, 0.0), spark=spark))
    scaled = fit_scaler(df).transform(df).select(vector_to_array("scaledFeatures").alias("s")).collect()
    deviation = 2**0.5
    # Not centred, divided by the sample deviation, and 0 where there is none.
    assert sorted(r.s for r in scaled) == [
        pytest.approx([1 / deviation, 0.0, 0.0, 0.0]),
        pytest.approx([3 / deviation, 0.0, 2**0.5, 0.0]),
    ]


def test_feature_model_reloads(spark, silver):
    rows = silver(*({"StockCode": f"S{i % 4}", "CustomerID": i, "UnitPrice": i / 3} for i in range(1, 20)))
    path = scratch_dir(spark, "features")
    fitted = fit_features(rows, path)
    fitted.save(path)
    again = FeatureModel.load(spark, path)
    columns = ("CustomerID", "CountryIndex", "StockCodeIndex", "scaledFeatures")
    expected = fitted.transform(rows).select(*columns).collect()
    assert sorted(again.transform(rows).select(*columns).collect(), key=str) == sorted(expected, key=str)


def test_null_stock_code_stops_feature_fitting(spark, silver):
    with pytest.raises(Exception, match="StockCode value null"):
        fit_features(silver({}, {"StockCode": None}), scratch_dir(spark, "features"))


def test_split_does_not_depend_on_partitioning(spark):
    rows = q.silver(spark, SF)
    parts = [
        {(r.InvoiceNo, r.l_linenumber, r.StockCode): r.is_train for r in with_split(df, q.SPLIT_KEYS).collect()}
        for df in (rows.repartition(2), rows.repartition(5, "Country"))
    ]
    assert parts[0] == parts[1]
    share = sum(parts[0].values()) / len(parts[0])
    assert 0.77 < share < 0.83


def test_random_split_does_depend_on_partitioning(spark):
    rows = spark.range(1000)
    splits = [{r.id for r in rows.repartition(n).randomSplit([0.8, 0.2], 42)[0].collect()} for n in (2, 5)]
    assert splits[0] != splits[1]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.sampled_from(["a", "b", "bb", "", " "])), max_size=30))
def test_labels_are_a_permutation_in_frequency_order(spark, values):
    df = _values(spark, *values) if values else _values(spark, "x").limit(0)
    labels, index = _labels(spark, df, "v")
    present = [v for v in values if v is not None]
    assert labels == sorted(set(present), key=lambda v: (-present.count(v), v))
    assert index == [float(i) for i in range(len(labels))]


def test_a_split_seed_divides_the_same_rows_anew(spark):
    rows = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    sides = {}
    for seed in (None, 1, 2):
        marked = with_split(rows, ["k"], 80, seed)
        sides[seed] = {r.k for r in marked.where("is_train").collect()}
        assert sides[seed] == {r.k for r in with_split(rows.repartition(7), ["k"], 80, seed).where("is_train").collect()}
        assert 1500 < len(sides[seed]) < 1700
    assert len({frozenset(s) for s in sides.values()}) == 3
