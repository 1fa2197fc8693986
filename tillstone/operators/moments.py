"""Mergeable moments, so that a scaler is refitted without reading old rows again.

Each stored part of a table leaves one row per column: count, mean and the sum
of squared deviations from that mean. Rows of any parts merge into the moments
of their union.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.operators.guards import require_columns
from tillstone.sources.paths import exists

MOMENTS_DDL = "feature string, n bigint, mean double, squares double, part string"


def part_moments(rows: DataFrame, columns: Sequence[str], by: str | None = None) -> DataFrame:
    """(feature, n, mean, squares) and ``by``: the moments of the columns, nulls left out, for each value of ``by``.

    One aggregation with partial sums on the map side; a column without values has no row.
    """
    require_columns(rows, columns, "moments")
    n = [F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)]
    mean = [F.avg(c).alias(f"mean_{i}") for i, c in enumerate(columns)]
    spread = [F.var_pop(c).alias(f"spread_{i}") for i, c in enumerate(columns)]
    keys = [by] if by else []
    told = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("feature"),
                    F.col(f"n_{i}").alias("n"),
                    F.col(f"mean_{i}").alias("mean"),
                    (F.col(f"spread_{i}") * F.col(f"n_{i}")).alias("squares"),
                )
                for i, c in enumerate(columns)
            ]
        )
    )
    return rows.groupBy(*keys).agg(*n, *mean, *spread).select(*keys, told.alias("m")).select(*keys, "m.*").where("n > 0")


def merged(parts: DataFrame) -> DataFrame:
    """(feature, n, mean, squares) of all parts together.

    Deviations of the parts' means are taken from the common mean, not from zero, so large means cost no digits.
    """
    means = parts.groupBy("feature").agg(F.sum("n").alias("all_n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("all_mean"))
    between = F.col("n") * F.pow(F.col("mean") - F.col("all_mean"), 2)
    return (
        parts.join(means, "feature")
        .groupBy("feature")
        .agg(
            F.first("all_n").alias("n"),
            F.first("all_mean").alias("mean"),
            F.sum(F.col("squares") + between).alias("squares"),
        )
    )


def deviation(n: Column, squares: Column) -> Column:
    """Sample standard deviation; null for fewer than two values."""
    return F.when(n > 1, F.sqrt(squares / (n - 1)))


class MomentStore:
    """Moments of the parts of a growing table, kept as a table at ``path``."""

    def __init__(self, spark: SparkSession, path: str, columns: Sequence[str]):
        self.spark, self.path, self.columns = spark, path, tuple(columns)

    def parts(self) -> DataFrame:
        return self.spark.read.schema(MOMENTS_DDL).parquet(self.path)

    def add(self, rows: DataFrame, part: str) -> None:
        """Record a new part from its rows alone; a part that is known already is refused."""
        if exists(self.spark, self.path) and not self.parts().where(F.col("part") == part).isEmpty():
            raise ValueError(f"part {part!r} is recorded already")
        self._append(part_moments(rows, self.columns).withColumn("part", F.lit(part)))

    def add_all(self, rows: DataFrame, by: str) -> None:
        """Record every value of the column ``by`` as a part, in one pass over the rows."""
        self._append(part_moments(rows, self.columns, by).withColumn("part", F.col(by).cast("string")))

    def _append(self, moments: DataFrame) -> None:
        columns = [c.split()[0] for c in MOMENTS_DDL.split(", ")]
        moments.select(*columns).coalesce(1).write.mode("append").parquet(self.path)

    def scaler(self, input_col: str = "features", output_col: str = "scaledFeatures") -> ElementwiseProduct:
        """Scale to unit sample deviation without centring, a constant feature to 0: what a fit on all rows gives.

        Only one row per column reaches the driver.
        """
        found = {r["feature"]: r["s"] for r in merged(self.parts()).select("feature", deviation(F.col("n"), F.col("squares")).alias("s")).collect()}
        factors = [1 / found[c] if found.get(c) else 0.0 for c in self.columns]
        return ElementwiseProduct(scalingVec=Vectors.dense(factors), inputCol=input_col, outputCol=output_col)
