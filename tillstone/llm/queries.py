"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.llm import pii, quality, toxicity
from tillstone.llm.common import documents, in_fold
from tillstone.llm.decontaminate import contamination
from tillstone.llm.exact_dedup import patricia_dedup
from tillstone.llm.licenses import licences
from tillstone.llm.near_dedup import near_duplicates
from tillstone.llm.packing import pack, token_pieces
from tillstone.llm.prefix_trie import PrefixTrie, branched, digested
from tillstone.llm.repair import damaged, repaired_conversations
from tillstone.llm.repeats import repeated_bytes
from tillstone.llm.secrets import secrets, written
from tillstone.llm.simhash import simhash_classes


def op1_patricia_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = patricia_dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_additive_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = quality.quality_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.scored(docs, model).select(
        "doc_id",
        in_fold("doc_id", 3, 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op4_gated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.toxicity_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.scored(docs, model).select(
        "doc_id",
        in_fold("doc_id", 4, 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op3_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(documents(spark, sf_dir), benchmark, slack=2).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
        "n_near",
    )


def op5_randomness_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(written(F.filter("spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def op6_sentence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences(documents(spark, sf_dir))


def op7_coordinate_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), percent=85)


def op8_span_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = pii.personal_data(docs, pii.pii_model(docs))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)],
        F.sha2(pii.written(base), 256).alias("base_sha256"),
        pii.written(F.col("spans")).alias("spans"),
    )


def op9_sampled_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda s, r: s + r["end"] - r["start"])
    return repeated_bytes(documents(spark, sf_dir)).select(
        "doc_id",
        (F.col("n_kept") + n_removed).alias("n_bytes"),
        n_removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        "kept_sha256",
    )


def op10_residual_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_pieces(documents(spark, sf_dir))
    return pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


def op11_block_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _conversations(spark, sf_dir)
    return repaired_conversations(conversations, damaged(conversations))


def op12_sequence_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PrefixTrie(branched(digested(_conversations(spark, sf_dir)))).nodes()


def op13_segment_popcounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_classes(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_patricia_owners, op2_additive_model, op4_gated_windows, op3_positional_index, op5_randomness_battery, op6_sentence_rules, op7_coordinate_join, op8_span_field, op9_sampled_suffixes, op10_residual_packing, op11_block_tables, op12_sequence_collapse, op13_segment_popcounts)
}
