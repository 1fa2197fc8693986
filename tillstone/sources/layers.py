"""Stored layers: full-replace tables that can be rewritten while being read."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillstone.operators.guards import MissingColumnsError
from tillstone.sources.paths import child_names, exists

_VERSION_NAME = re.compile(r"v(\d{5,})$")


class LayerStore:
    """Layers under one root, each replace written to a new ``v00001``-style directory.

    Plain files can not be overwritten while a plan still reads them, and have
    no atomic replace. A version counts once its ``_SUCCESS`` marker exists, so
    a job that dies half way leaves the previous version in force. One writer
    per layer is assumed.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt

    def _versions(self, layer: str) -> list[int]:
        names = child_names(self.spark, f"{self.root}/{layer}")
        return sorted(int(m.group(1)) for m in map(_VERSION_NAME.match, names) if m)

    def version_path(self, layer: str, version: int) -> str:
        return f"{self.root}/{layer}/v{version:05d}"

    def next_path(self, layer: str) -> str:
        """Where the next version goes; directories of failed writes are not reused."""
        return self.version_path(layer, max(self._versions(layer), default=0) + 1)

    def current_path(self, layer: str) -> str:
        for version in reversed(self._versions(layer)):
            path = self.version_path(layer, version)
            if exists(self.spark, f"{path}/_SUCCESS"):
                return path
        raise FileNotFoundError(f"layer {layer!r} under {self.root} has no finished version")

    def has(self, layer: str) -> bool:
        try:
            return bool(self.current_path(layer))
        except FileNotFoundError:
            return False

    def stored_schema(self, layer: str) -> StructType | None:
        """What the current version's files hold; none if it has no file, as an empty partitioned table."""
        path = self.current_path(layer)
        try:
            return self.spark.read.format(self.fmt).load(path).schema
        except AnalysisException as error:
            if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
                return None
            raise

    def read(
        self, layer: str, schema: str | StructType, *, missing: str = "error", stored_types: bool = False
    ) -> DataFrame:
        """Current version under a declared schema, which also types partition values.

        A declared column that the files lack raises MissingColumnsError; with ``missing="drop"`` it is left
        out and with ``missing="null"`` it reads as null. ``stored_types`` takes the files' types instead of the
        declared ones. Null and empty partition values both read back as null. Columns come in the declared
        order wherever the files keep them.
        """
        declared = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        stored = self.stored_schema(layer)
        if stored is not None:
            absent = [c for c in declared.names if c not in stored.names]
            if absent and missing == "error":
                raise MissingColumnsError(f"{layer}: the stored table lacks {absent}, it has {stored.names}")
            if missing == "drop":
                declared = StructType([f for f in declared if f.name not in absent])
            if stored_types:
                declared = StructType([stored[f.name] if f.name in stored.names else f for f in declared])
        rows = self.spark.read.schema(declared).format(self.fmt).load(self.current_path(layer))
        return rows.select(*declared.names)

    def overwrite(
        self,
        layer: str,
        df: DataFrame,
        *,
        partition_by: Sequence[str] = (),
        rebalance_by: Sequence[str] = (),
        rebalance_parts: int | None = None,
    ) -> str:
        """Replace the layer; columns that ``df`` lacks are left out of the layout.

        ``rebalance_by`` brings equal values together and lets adaptive
        execution split a value that is too large for one task, which a plain
        hash repartition would not. ``rebalance_parts`` sets how many parts it
        starts from, instead of the session's number of shuffle partitions.
        """
        together = [c for c in rebalance_by if c in df.columns]
        split = [c for c in partition_by if c in df.columns]
        if together:
            df = df.hint("rebalance", *([rebalance_parts] if rebalance_parts else []), *together)
        path = self.next_path(layer)
        writer = df.write.format(self.fmt)
        (writer.partitionBy(*split) if split else writer).save(path)
        return path

    def cluster(
        self,
        layer: str,
        schema: str | StructType,
        by: Sequence[str],
        *,
        partition_by: Sequence[str] = (),
        files: int | None = None,
    ) -> str | None:
        """Compact the layer into files that cover narrow ranges of ``by``.

        With ``partition_by`` the ranges lie within partitions. Without
        ``files`` adaptive execution picks their number from the data size.
        Does nothing when none of ``by`` exists.
        """
        df = self.read(layer, schema)
        if not any(c in df.columns for c in by):
            return None
        return self.overwrite(layer, clustered(df, by, partition_by, files), partition_by=partition_by)

    def _rows_with_files(self, layer: str, schema: str | StructType) -> DataFrame:
        named = {"file": F.col("_metadata.file_path"), "bytes": F.col("_metadata.file_size")}
        return self.read(layer, schema).select("*", *[c.alias(name) for name, c in named.items()])

    def file_ranges(self, layer: str, schema: str | StructType, columns: Sequence[str]) -> DataFrame:
        """(file, rows, bytes) and ``least_c``, ``most_c`` for each of the columns, for every file that has rows."""
        named = self._rows_with_files(layer, schema)
        ends = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("least", F.min), ("most", F.max))]
        return named.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.first("bytes").alias("bytes"), *ends)

    def placement(self, layer: str, schema: str | StructType, column: str) -> DataFrame:
        """(column, rows, files, bytes): how many files hold a value's rows, and how large these files are together.

        Rows are counted per value and file before they are shuffled, so a value with most of the rows costs no more.
        """
        per_file = self._rows_with_files(layer, schema).groupBy(column, "file").agg(F.count(F.lit(1)).alias("rows"), F.first("bytes").alias("bytes"))
        return per_file.groupBy(column).agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))

    def index_files(self, layer: str, schema: str | StructType, columns: Sequence[str]) -> None:
        """Store the file ranges of the current version beside its files, where a scan of the layer does not see them."""
        ranges = self.file_ranges(layer, schema, columns)
        ranges.coalesce(1).write.mode("overwrite").parquet(f"{self.current_path(layer)}/_ranges")

    def files_within(self, layer: str, column: str, low, high) -> DataFrame:
        """The indexed files of the current version that may hold values from ``low`` to ``high``, both included."""
        ranges = self.spark.read.parquet(f"{self.current_path(layer)}/_ranges")
        return ranges.where((F.col(f"most_{column}") >= low) & (F.col(f"least_{column}") <= high))

    def read_within(self, layer: str, schema: str | StructType, column: str, low, high) -> DataFrame:
        """The layer's rows from ``low`` to ``high``, opening only the files whose range the index says may hold them.

        A plain filtered scan lists every file and reads its footer to skip it; here the others are not touched. Only
        the names of the files to open reach the driver, which plans a scan from such a list in any case.
        """
        declared = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        wanted = [unquote(r["file"]) for r in self.files_within(layer, column, low, high).select("file").collect()]
        if not wanted:
            return self.spark.createDataFrame([], declared)
        reader = self.spark.read.schema(declared).option("basePath", self.current_path(layer)).format(self.fmt)
        rows = reader.load(wanted).select(*declared.names)
        return rows.where(F.col(column).between(low, high))


def clustered(df: DataFrame, by: Sequence[str], partition_by: Sequence[str] = (), files: int | None = None) -> DataFrame:
    """Rows dealt to narrow ranges of ``by`` (within ``partition_by``) and sorted, for a write that needs no rewrite.

    Columns that ``df`` lacks are ignored; without any of ``by`` the rows stay as they are.
    """
    ranges = [c for c in by if c in df.columns]
    if not ranges:
        return df
    keys = [*(c for c in partition_by if c in df.columns), *ranges]
    placed = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    return placed.sortWithinPartitions(*keys)


def overlapping(ranges: DataFrame, column: str) -> DataFrame:
    """The files of ``file_ranges`` whose range of ``column`` begins before all files that begin earlier have ended.

    The window sees one row per file, not the rows of the files.
    """
    order = Window.orderBy(f"least_{column}", f"most_{column}", "file")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    ended = F.max(f"most_{column}").over(earlier)
    return ranges.withColumn("_ended", ended).where(F.col(f"least_{column}") <= F.col("_ended")).drop("_ended")
