"""The training-data pipeline over documents: drop toxic texts, exact and near copies and benchmark leaks, then pack.

``run`` writes each stage as Parquet under the shared folder and rereads it, so
a lost executor repeats one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.llm.common import SMALL_BATCHES, Scratch, documents, passing_tables, small_batches
from tillstone.llm.decontaminate import without_contaminated
from tillstone.llm.exact_dedup import without_copies
from tillstone.llm.near_dedup import without_near_copies
from tillstone.llm.packing import pack, token_pieces
from tillstone.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.3; the model learns from labelled rows outside the held-out fold."""
    small_batches(spark)
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal but for white space, the longest stays."""
    small_batches(spark)
    return without_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of 85 percent common five-word shingles join, the one with the smallest id stays.

    Rows that share an id are judged each by its own text.
    """
    small_batches(spark)
    return without_near_copies(docs, words=5, percent=85, whole_ids=False)  # the number that tests/llm/test_pipeline.py holds it to


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lie in a benchmark window."""
    small_batches(spark)
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents that are left, with their places in sequences of at most 1024 tokens."""
    small_batches(spark)
    return pack(token_pieces(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("decontamination", decontamination),
    ("packing", best_fit_packing),
]

#: SQL can't express the trained filter and the packing; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in a row. What a stage stores on its way is removed once its result is written."""
    docs = documents(spark, sf_dir)
    scratch = Scratch(spark, "pipeline")
    before = {name: spark.conf.get(name, None) for name in SMALL_BATCHES}
    try:
        for k, (name, stage) in enumerate(STAGES):
            with passing_tables():
                docs = scratch.store(stage(spark, docs, sf_dir), name)
            if k:
                scratch.drop(STAGES[k - 1][0])
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    return docs
