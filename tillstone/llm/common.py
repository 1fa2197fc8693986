"""What several operators share: stored intermediate tables and checked broadcasts."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.sources.paths import remove, scratch_dir


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Bounds of what a task holds of a table of whole texts at a time: rows and bytes handed to Python, rows read.
SMALL_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "2m",
    "spark.sql.parquet.columnarReaderBatchSize": "512",
}
_SCOPES: list[list["Scratch"]] = []


@contextmanager
def passing_tables() -> Iterator[None]:
    """Remove at the end what operators called inside have stored: their results must have been written by then."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for scratch in _SCOPES.pop():
            scratch.drop(*list(scratch.paths))


class Scratch:
    """Intermediate tables of one operator call, in the folder that all executors share.

    A stored table cuts lineage: a lost executor costs its running tasks, not
    the steps before. ``drop`` removes the tables that the result no longer reads.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, {}
        if _SCOPES:
            _SCOPES[-1].append(self)

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_dir(self.spark, f"{self.label}-{name}")
        df.write.parquet(path)
        self.paths[name] = path
        return self.spark.read.parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self.paths:
                remove(self.spark, self.paths.pop(name))


def numbered_columns(docs: DataFrame, *wanted: str) -> tuple:
    """docs with columns named by number, the new names of ``wanted``, and the columns that give the old names back.

    A step can then add columns of its own without hiding one of docs that has the same name.
    """
    renamed = [f"_c{i}" for i in range(len(docs.columns))]
    back = [F.col(r).alias(c) for r, c in zip(renamed, docs.columns)]
    return docs.toDF(*renamed), *[renamed[docs.columns.index(c)] for c in wanted], back


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Mark a stored table for broadcast when it has at most max_rows rows; otherwise leave the join to shuffle."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def small_batches(spark: SparkSession) -> None:
    """Have Spark read rows and hand them to Python in small batches, where the session does not say otherwise.

    Whole texts make large Arrow buffers, which an executor's JVM holds outside its heap, and large column vectors,
    each a huge object of the heap: the collector starts anew for these and takes more heap the more often it runs.
    """
    for name, value in SMALL_BATCHES.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)


def parts(batches, rows: int = 1000):
    """Arrow batches in slices, so that a task holds Python objects for a few rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def lower_ascii(column):
    """Lower-case A-Z and nothing else."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def in_fold(doc_id: str, folds: int, fold: int):
    """Whether crc32 of the id as text leaves this remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))
