"""Feature engineering for the quantity model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstone.functions.hashing import hash_bucket
from tillstone.operators.guards import require_columns
from tillstone.sources.paths import remove

LABEL = "Quantity"
INDEXED = {"Country": "CountryIndex", "StockCode": "StockCodeIndex"}
MODEL_INPUTS = (LABEL, "CustomerID", "UnitPrice", *INDEXED)
FEATURE_COLUMNS = ("CustomerID", "UnitPrice", "CountryIndex", "StockCodeIndex")

_SORTED_DDL = "source string, label string, rows bigint, place bigint"
_LABELS_DDL = "label string, rows bigint, label_index double, source string"


def recast_measures(df: DataFrame) -> DataFrame:
    """Make sure the label is an int and the price a double before training; text that is neither becomes null."""
    return df.withColumns(
        {"Quantity": F.col("Quantity").try_cast("int"), "UnitPrice": F.col("UnitPrice").try_cast("double")}
    )


def read_labels(spark: SparkSession, path: str, column: str) -> DataFrame:
    labels = spark.read.schema(_LABELS_DDL).parquet(f"{path}/labels")
    return labels.where(F.col("source") == column).drop("source")


def fit_labels(df: DataFrame, columns: Sequence[str], path: str) -> dict[str, DataFrame]:
    """Index the values of each column by falling frequency, ties in ascending order; nulls are left out.

    The same numbers as MLlib's ``StringIndexer``, which gathers every label on
    the driver. Here the labels of all columns are range-sorted across the
    cluster and written under ``path``. A label's index is its distance from the
    first label of its column in its sort partition, plus that column's labels in
    the partitions before it. Both reads must see the same partitions, so the
    sorted table is written and not recomputed.
    """
    spark = df.sparkSession
    counts = [
        df.where(F.col(c).isNotNull())
        .groupBy(F.col(c).cast("string").alias("label"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(c).alias("source"), "label", "rows")
        for c in columns
    ]
    (
        reduce(DataFrame.unionAll, counts)
        .orderBy("source", F.desc("rows"), "label")
        # The partition number above bit 33, the row number in the partition below it.
        .withColumn("place", F.monotonically_increasing_id())
        .write.parquet(f"{path}/sorted")
    )
    placed = spark.read.schema(_SORTED_DDL).parquet(f"{path}/sorted").withColumn("part", F.shiftright("place", 33))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("source", "part")
        .agg(F.count(F.lit(1)).alias("size"), F.min("place").alias("first"))
        .withColumn("start", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    )
    (
        placed.join(starts, ["source", "part"])
        .withColumn("label_index", (F.col("start") + F.col("place") - F.col("first")).cast("double"))
        .select("source", "label", "rows", "label_index")
        .write.partitionBy("source")
        .parquet(f"{path}/labels")
    )
    remove(spark, f"{path}/sorted")
    return {c: read_labels(spark, path, c) for c in columns}


def index_column(
    df: DataFrame, labels: DataFrame, column: str, output: str, handle_invalid: str = "error"
) -> DataFrame:
    """Add a label's index. Null and unseen values raise, are dropped (``skip``) or share one extra index (``keep``).

    The stored label table has a known size: Catalyst broadcasts a small one and
    sort-merges a large one, where adaptive execution splits a hot label (the
    label side holds each value once).
    """
    lookup = labels.select(F.col("label").alias(column), F.col("label_index").alias(output))
    order = [*df.columns, output]
    if handle_invalid == "skip":
        return df.join(lookup, column).select(*order)
    joined = df.join(lookup, column, "left")
    if handle_invalid == "keep":
        missing = F.lit(float(labels.count()))
    elif handle_invalid == "error":
        message = F.concat(
            F.lit(f"{column} value "),
            F.coalesce(F.concat(F.lit("'"), F.col(column), F.lit("'")), F.lit("null")),
            F.lit(" was not indexed; drop such rows or pass handle_invalid='skip' or 'keep'"),
        )
        missing = F.raise_error(message).cast("double")
    else:
        raise ValueError(f"unknown handle_invalid {handle_invalid!r}")
    return joined.withColumn(output, F.coalesce(output, missing)).select(*order)


def index_all(df: DataFrame, labels: dict[str, DataFrame], handle_invalid: str = "error") -> DataFrame:
    for column, output in INDEXED.items():
        df = index_column(df, labels[column], column, output, handle_invalid)
    return df


def assemble(df: DataFrame, columns: Sequence[str] = FEATURE_COLUMNS, output: str = "features") -> DataFrame:
    """Gather numeric columns into one vector; a null among them raises."""
    require_columns(df, columns, "assemble")
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


def fit_scaler(assembled: DataFrame) -> StandardScalerModel:
    """Unit sample deviation without centring; a constant feature becomes 0."""
    return StandardScaler(
        inputCol="features", outputCol="scaledFeatures", withStd=True, withMean=False
    ).fit(assembled)


@dataclass(frozen=True)
class FeatureModel:
    """Fitted labels and scaler.

    The indexes are plain numbers without category metadata, and scaling would
    drop such metadata too. So a forest splits on them as numbers; declared as
    categories they would have to fit into ``maxBins``.
    """

    labels: dict[str, DataFrame]
    scaler: StandardScalerModel
    handle_invalid: str = "error"

    def transform(self, df: DataFrame) -> DataFrame:
        return self.scaler.transform(assemble(index_all(recast_measures(df), self.labels, self.handle_invalid)))

    def save(self, path: str) -> None:
        """Store the scaler next to the label tables, which fitting wrote under ``path``."""
        self.scaler.write().overwrite().save(f"{path}/scaler")

    @staticmethod
    def load(spark: SparkSession, path: str, handle_invalid: str = "error") -> FeatureModel:
        labels = {column: read_labels(spark, path, column) for column in INDEXED}
        return FeatureModel(labels, StandardScalerModel.load(f"{path}/scaler"), handle_invalid)


def fit_features(df: DataFrame, path: str, handle_invalid: str = "error") -> FeatureModel:
    """Fit both label tables and the scaler on ``df``, keeping the tables under ``path``."""
    require_columns(df, MODEL_INPUTS, "features")
    df = recast_measures(df)
    labels = fit_labels(df, tuple(INDEXED), path)
    scaler = fit_scaler(assemble(index_all(df, labels, handle_invalid)))
    return FeatureModel(labels, scaler, handle_invalid)


def with_split(
    df: DataFrame, key_columns: Sequence[str], train_percent: int = 80, seed: int | None = None
) -> DataFrame:
    """Mark training rows by a hash of their content: repeatable on any partitioning, no shuffle.

    Rows with equal keys fall on the same side. Each ``seed`` gives another division of the same rows.
    """
    lead = [] if seed is None else [F.lit(str(seed))]
    key = F.concat_ws("|", *lead, *(F.col(c).cast("string") for c in key_columns))
    return df.withColumn("is_train", hash_bucket(key, 100) < train_percent)
