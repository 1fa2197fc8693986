"""Benchmark decontamination by a distributed positional inverted index, in DataFrame operations only.

Benchmark items are cut into windows of words. One pass over the documents
counts the windows' terms. A second pass stores the postings (document,
position, term) of each window's rarest terms. Postings shifted by the term's
place in the window meet at one start; where all of a window's rare terms meet,
the document's words are compared with the whole window. The same postings
within some slack of each other give proximity matches. Common terms are never
looked up, no list is gathered per term, and rows are hashed by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tillstone.llm.common import Scratch, broadcast_if_small, lower_ascii, numbered_columns

WORD = r"[0-9A-Za-z\u0080-\x{10FFFF}]+"


def words_of(text: Column) -> Column:
    """Runs of ASCII letters, digits and all characters beyond ASCII; A-Z in lower case. Null has none."""
    text = F.coalesce(text, F.lit(""))
    lowered = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(lower_ascii(text))
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _key(id_col: str, text_col: str) -> Column:
    """One row's name: id and text hash. Rows equal in both are one; null ids are fine."""
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"))


class PositionalIndex:
    """Windows of a benchmark and the postings of their rarest terms in docs.

    ``rare`` terms of each window are looked up; ``small`` bounds the rows of a table that is broadcast.
    Null and wordless texts have no windows and no postings; rows of docs that are equal in id and text are
    treated as one. Other columns of either table are not read.
    """

    def __init__(
        self,
        docs: DataFrame,
        benchmark: DataFrame,
        window: int = 13,
        rare: int = 3,
        small: int = 500_000,
        id_col: str = "doc_id",
        text_col: str = "text",
        item_col: str = "item_id",
        item_text: str = "text",
    ):
        self.docs, self.id_col, self.text_col, self.small = docs, id_col, text_col, small
        self.scratch = scratch = Scratch(docs.sparkSession, "index")
        items = benchmark.select(F.col(item_col).alias("item"), words_of(F.col(item_text)).alias("words")).filter(
            F.size("words") > 0
        )
        cut = F.transform(
            F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1))),
            lambda i: F.slice("words", i, window),
        )
        pairs = scratch.store(items.select("item", F.explode(cut).alias("w")).distinct(), "pairs")
        phrases = scratch.store(
            pairs.select("w").distinct().withColumn("wid", F.monotonically_increasing_id()), "windows"
        )
        self.windows = broadcast_if_small(phrases, small)
        self.items = scratch.store(pairs.join(phrases, "w").select("wid", "item"), "items")
        terms = phrases.select("wid", F.posexplode("w").alias("off", "term"))
        vocabulary = scratch.store(terms.select("term").distinct(), "vocabulary")
        counts = scratch.store(
            self.tokens().join(broadcast_if_small(vocabulary, small), "term").groupBy("term").agg(F.count("*").alias("c")),
            "counts",
        )
        ranked = (
            terms.join(broadcast_if_small(counts, small), "term", "left")
            .groupBy("wid")
            .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "off", "term"))).alias("t"))
            .filter(F.col("t")[0]["c"] > 0)  # a term that no document has rules the window out
            .select("wid", F.slice("t", 1, rare).alias("t"))
        )
        probes = ranked.select("wid", F.size("t").alias("need"), F.posexplode("t").alias("rank", "x"))
        self.probes = scratch.store(
            probes.select(
                "wid", F.col("x.off").alias("off"), F.col("x.term").alias("term"),
                F.expr("shiftleft(1, rank)").alias("bit"), F.expr("shiftleft(1, need) - 1").alias("full"),
            ),
            "probes",
        )
        rare_terms = scratch.store(self.probes.select("term").distinct(), "rare")
        self.postings = scratch.store(
            self.tokens().join(broadcast_if_small(rare_terms, small), "term"), "postings"
        )

    def tokens(self) -> DataFrame:
        """(k, pos, term) of every word of docs."""
        return self.docs.select(
            _key(self.id_col, self.text_col).alias("k"), F.posexplode(words_of(F.col(self.text_col))).alias("pos", "term")
        )

    def _shifted(self) -> DataFrame:
        probes = broadcast_if_small(self.probes, self.small)
        return self.postings.join(probes, "term").select(
            "k", "wid", (F.col("pos") - F.col("off")).alias("start"), "bit", "full"
        )

    def phrases(self) -> DataFrame:
        """(k, hits): exact occurrences in each document that has any; hits are (start, length, wid), from 0."""
        found = (
            self._shifted().groupBy("k", "wid", "start")
            .agg(F.bit_or("bit").alias("bits"), F.first("full").alias("full"))
            .filter("bits = full AND start >= 0")
        )
        # a document has at most one candidate for each start and window length that passes
        listed = self.scratch.store(
            found.join(self.windows, "wid").groupBy("k").agg(F.collect_list(F.struct("start", "w", "wid")).alias("found")),
            "found",
        )
        keys = broadcast_if_small(listed.select("k"), self.small)
        read = (
            self.docs.select(_key(self.id_col, self.text_col).alias("k"), F.col(self.text_col).alias("text"))
            .join(keys, "k", "left_semi")
            .select("k", words_of(F.col("text")).alias("words"))
            .dropDuplicates(["k"])
        )
        same = F.filter("found", lambda x: F.slice(F.col("words"), x["start"] + 1, F.size(x["w"])) == x["w"])
        hits = F.transform(same, lambda x: F.struct(x["start"].alias("start"), F.size(x["w"]).alias("length"), x["wid"].alias("wid")))
        return self.scratch.store(
            read.join(listed, "k").select("k", hits.alias("hits")).filter(F.size("hits") > 0), "hits"
        )

    def near(self, slack: int) -> DataFrame:
        """(k, wid, start): places where all rare terms of a window lie within ``slack`` words of their places in it."""
        span = Window.partitionBy("k", "wid").orderBy("start").rangeBetween(0, slack)
        return (
            self._shifted().distinct()
            .withColumn("bits", F.bit_or("bit").over(span))
            .filter("bits = full").select("k", "wid", "start").distinct()
        )


def contamination(docs: DataFrame, benchmark: DataFrame, slack: int | None = None, **options) -> DataFrame:
    """One row per row of docs: id, ``n_words``, ``n_hit`` (words inside an occurrence of a benchmark window),
    ``items`` (ids as strings, sorted), ``contaminated`` (a twentieth of the words or more are hit). With ``slack``
    also ``n_near``: windows that do not occur but whose rare terms lie within so many words of their places.

    Empty tables give no rows or no hits; see PositionalIndex for options and odd rows. Texts of any length are read
    whole, as rows of words.
    """
    index = PositionalIndex(docs, benchmark, **options)
    hits = index.phrases()
    near = None
    if slack is not None:
        exact = hits.select("k", F.explode("hits.wid").alias("wid")).distinct()
        close = index.near(slack).select("k", "wid").distinct().join(exact, ["k", "wid"], "left_anti")
        near = index.scratch.store(close.groupBy("k").agg(F.count(F.lit(1)).alias("n_near")), "near")
    covered = F.array_distinct(
        F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["length"] - 1)))
    )
    named = (
        hits.select("k", F.explode("hits").alias("hit")).select("k", "hit.wid").distinct()
        .join(broadcast_if_small(index.items, index.small), "wid")
        .groupBy("k").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    )
    found = hits.select("k", F.size(covered).cast("long").alias("n_hit")).join(named, "k", "left")
    n_words = F.regexp_count(F.coalesce(F.col(index.text_col), F.lit("")), F.lit(WORD)).cast("long")
    out = docs.select(
        F.col(index.id_col), _key(index.id_col, index.text_col).alias("k"), n_words.alias("n_words")
    ).join(found, "k", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items = F.coalesce("items", F.array().cast(T.ArrayType(T.StringType())))
    columns = [
        "k", index.id_col, "n_words", n_hit.alias("n_hit"), items.alias("items"),
        ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"),
    ]
    if near is not None:
        out = out.join(near, "k", "left")
        columns.append(F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"))
    return out.select(*columns)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, small: int = 500_000) -> DataFrame:
    """The rows of docs that are not contaminated, with all their columns as they were, whatever these are called."""
    bad = contamination(docs, benchmark, small=small).filter("contaminated").select(F.col("k").alias("_k")).distinct()
    bad = Scratch(docs.sparkSession, "index").store(bad, "contaminated")
    docs, id_col, text_col, named = numbered_columns(docs, "doc_id", "text")
    rest = docs.withColumn("_k", _key(id_col, text_col)).join(broadcast_if_small(bad, small), "_k", "left_anti")
    return rest.select(*named)
