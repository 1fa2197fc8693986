"""Conversation prefix trie by whole-sequence collapse.

A turn's digest is bound to its place by hashing both, and a prefix is named by
its depth and two sums of 60-bit hashes of its turns (exact up to clashes of
120 bits). Sums need no order, so whole conversations are named by one
aggregation. Identical ones collapse into one weighted sequence that the
smallest of them stands for; only its turns go on. Prefix names are running
sums along a sequence, and the name of the prefix before is the same sum less
the turn's own hash.

A sequence whose name is that of a shorter prefix of another one is dropped by
an anti-join: what is left are the leaves. Weighted prefixes are aggregated by
name. What lies below a node is summed up without walking the trie: each node
belongs to one leaf below it, a running sum from the leaf up gives what its
path holds from every depth on, and these sums are aggregated by node.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.llm.common import Scratch
from tillstone.llm.sequences import BLOCK, numbered, running

BITS = 60
WORD = r"[^\x20\x09-\x0D]+"
NAME = ["depth", "s1", "s2"]
NONE = hashlib.sha256(b"").hexdigest()


def digested(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """(conv, place, said, words): each turn's place from 1, the SHA-256 of role and text, and the words of the text.

    Turns go null first, rows of one turn by role and text; null roles and texts count as empty. Rows without a
    conversation id belong to no conversation and are left out.
    """
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), filled(role_col).alias("role"), filled(text_col).alias("text")
    )
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    return numbered(rows, "conv", "turn", ["role", "text"], block=block).select(
        "conv", "place", said.alias("said"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words")
    )


def branched(digests: DataFrame, siblings: int = 20, heads: int = 4) -> DataFrame:
    """The contract's rebuilt conversations, as (conv, place, said, words), and every conversation at place 0.

    Conversation c begins with the first h turns of c - c % siblings and goes on with its own after its first h;
    h is the unsigned crc32 of its decimal id modulo ``heads``. A conversation heads at most ``siblings`` others.
    """
    h = F.crc32(F.col("conv").cast("string")) % heads
    convs = digests.select("conv").distinct().select("conv", h.alias("h"), (F.col("conv") - F.col("conv") % siblings).alias("base"))
    top = digests.filter(F.col("place") < heads).withColumnRenamed("conv", "base")
    copied = convs.join(top, "base").filter(F.col("place") <= F.col("h")).select("conv", "place", "said", "words")
    given = F.least("h", F.coalesce("given", F.lit(0)))
    heads_of = top.groupBy("base").agg(F.max("place").alias("given"))
    shift = convs.join(heads_of, "base", "left").select("conv", "h", (given - F.col("h")).alias("shift"))
    own = (
        digests.join(shift, "conv")
        .filter(F.col("place") > F.col("h"))
        .select("conv", (F.col("place") + F.col("shift")).alias("place"), "said", "words")
    )
    empty = convs.select("conv", F.lit(0).cast("long").alias("place"), F.lit("").alias("said"), F.lit(0).cast("long").alias("words"))
    return copied.unionByName(own).unionByName(empty)


def _hash(part: int):
    """60 bits of a turn at its place as a decimal; place 0, which every conversation has, adds nothing."""
    digest = F.sha2(F.concat(F.col("place").cast("string"), F.lit(":"), "said"), 256)
    bits = F.conv(F.substring(digest, 1 + 15 * part, 15), 16, 10).cast("decimal(20,0)")
    return F.when(F.col("place") > 0, bits).otherwise(F.lit(0).cast("decimal(20,0)"))


def _modulo(total):
    return (total % F.lit(1 << BITS).cast("decimal(20,0)")).cast("long")


def _end_lists(key: str, member: str):
    def run(batches):
        """SHA-256 of each key's members, ascending and joined by commas, one member at a time."""
        last, digest, kind = None, None, None
        for batch in batches:
            kind, keys, found = batch.schema.field(key).type, [], []
            for k, m in zip(batch.column(key).to_pylist(), batch.column(member).to_pylist()):
                if digest is None or k != last:
                    if digest is not None:
                        keys.append(last)
                        found.append(digest.hexdigest())
                    last, digest = k, hashlib.sha256(str(m).encode())
                else:
                    digest.update(f",{m}".encode())
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(found, pa.string())], names=[key, "ends"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([last], kind), pa.array([digest.hexdigest()], pa.string())], names=[key, "ends"]
            )

    return run


class PrefixTrie:
    """The trie of a table (conv, place, said, words), as ``digested`` gives it.

    Conversations without turns are known by a row at place 0. Copies may hold any share of the rows: they are
    counted before a shuffle. A conversation of any length is numbered and summed in blocks of ``block`` turns.
    """

    def __init__(self, turns: DataFrame, block: int = BLOCK):
        self.scratch, self.block = Scratch(turns.sparkSession, "trie"), block
        rows = turns.select("conv", "place", "words", _hash(0).alias("h1"), _hash(1).alias("h2"))
        self.rows = self.scratch.store(rows, "rows")
        wholes = self.rows.groupBy("conv").agg(
            F.max("place").alias("depth"), _modulo(F.sum("h1")).alias("s1"), _modulo(F.sum("h2")).alias("s2")
        )
        self.wholes = self.scratch.store(wholes, "wholes")
        groups = self.wholes.groupBy(*NAME).agg(F.min("conv").alias("first"), F.count(F.lit(1)).alias("weight"))
        self.sequences = self.scratch.store(groups, "sequences")

    def ends(self) -> DataFrame:
        """(first, conv): every conversation beside the smallest one that is identical to it."""
        return self.wholes.join(self.sequences, NAME).select("first", "conv")

    def _prefixes(self) -> DataFrame:
        """Every prefix of every sequence: its name, the name before it, whose it is, its weight and its last turn's words."""
        of = self.sequences.select(F.col("first").alias("conv"), "weight")
        rows = self.rows.filter(F.col("place") > 0).join(of, "conv")
        longest = self.sequences.agg(F.max("depth")).first()[0] or 0
        summed = running(rows, "conv", "place", {"t1": F.col("h1"), "t2": F.col("h2")}, longest, block=self.block)
        named = summed.select(
            F.col("conv").alias("first"),
            F.col("place").alias("depth"),
            _modulo(F.col("t1")).alias("s1"),
            _modulo(F.col("t2")).alias("s2"),
            _modulo(F.col("t1") - F.col("h1")).alias("p1"),
            _modulo(F.col("t2") - F.col("h2")).alias("p2"),
            "weight",
            "words",
        )
        zero = F.lit(0).cast("long")
        root = self.sequences.select(
            "first", zero.alias("depth"), zero.alias("s1"), zero.alias("s2"), zero.alias("p1"), zero.alias("p2"), "weight", zero.alias("words")
        )
        return named.unionByName(root)

    def nodes(self) -> DataFrame:
        """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

        A node's last turn is the one at place ``depth`` of conversation ``conv_id``. No conversations, no nodes.
        """
        prefixes = self.scratch.store(self._prefixes(), "prefixes")
        lengths = self.sequences.select("first", F.col("depth").alias("length"))
        proper = prefixes.join(lengths, "first").filter(F.col("depth") < F.col("length")).select(*NAME).distinct()
        leaves = self.scratch.store(self.sequences.join(proper, NAME, "left_anti").select("first"), "leaves")
        marked = prefixes.join(leaves.withColumn("leaf", F.lit(True)), "first", "left")
        marked = self.scratch.store(marked.withColumn("leaf", F.coalesce("leaf", F.lit(False))), "marked")
        self.scratch.drop("prefixes")
        nodes = marked.groupBy(*NAME).agg(
            F.min("p1").alias("p1"),
            F.min("p2").alias("p2"),
            F.min("first").alias("conv_id"),
            F.sum("weight").alias("n_convs"),
            F.count_if("leaf").alias("n_leaves"),
            F.min(F.when(F.col("leaf"), F.col("first"))).alias("owner"),
            ((F.sum("weight") - 1) * F.max("words")).alias("saving"),
        )
        nodes = self.scratch.store(nodes, "nodes")
        # a node's owner and depth are its alone, so this join has no hot key
        savings = nodes.select(F.col("owner").alias("first"), "depth", "saving")
        paths = marked.filter("leaf").join(savings, ["first", "depth"], "left")
        paths = paths.select("first", (F.col("depth") + 1).alias("at"), *NAME, F.coalesce("saving", F.lit(0)).alias("saving"))
        longest = (self.sequences.agg(F.max("depth")).first()[0] or 0) + 1
        below = running(paths, "first", "at", {"below": F.col("saving")}, longest, backward=True, block=self.block)
        saved = below.groupBy(*NAME).agg(F.sum("below").alias("saved_tokens"))
        children = (
            nodes.filter(F.col("depth") > 0)
            .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("s1"), F.col("p2").alias("s2"))
            .agg(F.count(F.lit(1)).alias("n_children"))
        )
        parents = nodes.select(
            (F.col("depth") + 1).alias("depth"), F.col("s1").alias("p1"), F.col("s2").alias("p2"), F.col("conv_id").alias("parent_conv_id")
        )
        kind = self.wholes.schema["conv"].dataType
        lists = self.ends().repartition("first").sortWithinPartitions("first", "conv")
        schema = T.StructType([T.StructField("first", kind), T.StructField("ends", T.StringType())])
        ends = lists.mapInArrow(_end_lists("first", "conv"), schema).join(self.sequences, "first").select(*NAME, "ends")
        whole = (
            nodes.join(saved, NAME)
            .join(children, NAME, "left")
            .join(ends, NAME, "left")
            .join(parents, ["depth", "p1", "p2"], "left")
        )
        long = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
        return whole.select(
            "conv_id",
            F.col("depth").cast("long").alias("depth"),
            "parent_conv_id",
            *[long(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
            F.coalesce("ends", F.lit(NONE)).alias("ends_sha256"),
        )
