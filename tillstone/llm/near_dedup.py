"""MinHash near duplicates by a signature-coordinate inverted join.

A document's signature is the least hash of its shingles under each of K hash
functions. Every (coordinate, value) is a posting key. Two documents that
agree in at least T of K coordinates share a key among the K - T + 1 rarest
of each, whatever order is called rare, so only these are posted (prefix) and
the long lists behind them are never merged (skip). Pairs found in a list are
kept when their whole signatures agree in T places and then confirmed on the
full shingle sets.

Lists are not paired out. Rows with one word sequence are one class. In a
list, all members are first held against one pivot. Lists that then still
span several components are open. For their members the shingles that no
other member has are counted: they bound a pair's common part from above, so
most pairs of a large group are ruled out by two numbers. A second pivot, the
member with the smallest such share, joins the rest of a group of copies to
its original. Members outside the largest component around a pivot are at last
held against the pivot's other members in the size bands that the bound
allows. Each side carries only how its set differs from the pivot's, which is
short among copies and gives the pair's exact overlap, so that the join puts
out links alone. A pair that was never tested lies in one component or can't
be a link: components are those of the full link graph.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstone.llm.bytehash import SpanHash, mix, slices
from tillstone.llm.common import Scratch, broadcast_if_small, numbered_columns, parts
from tillstone.llm.graph import components

BLOCK = 1 << 19
BUCKETS = 1 << 18
#: Words of so many bytes are hashed by xxh3. Sums modulo 2**64 clash for built words of about a thousand bytes.
LONG_WORD = 256
MISS = 2e-6  # bound of the probability that a pair at the threshold agrees in too few coordinates


def _normal(batch: pa.RecordBatch, text_col: str) -> list[bytes]:
    """Words of each text, ASCII letters in lower case, with one space between them."""
    text = pc.fill_null(batch.column(text_col).cast(pa.large_string()), "").cast(pa.large_binary())
    return [b" ".join(data.lower().split()) for data in text.to_pylist()]


def _shingles(texts: list[bytes], words: int, hasher: SpanHash) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of non-empty normal texts, sorted within each text, and each text's first index."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.flatnonzero((data == 32) | (data == 10))
    starts = np.concatenate([[0], ends[:-1] + 1])
    word = mix(hasher.spans(hasher.prefix(data), starts, ends))
    for i in np.flatnonzero(ends - starts >= LONG_WORD).tolist():
        word[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    last = np.flatnonzero(data[ends] == 10)  # index of the last word of each text
    count = np.diff(np.concatenate([[-1], last]))
    first = last - count + 1
    # a window of the smaller of `words` and the text's length starts at each word but the last few
    own = np.minimum(count, words)
    n = count - own + 1
    doc = np.repeat(np.arange(len(texts)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - first, n)
    width = own[doc]
    out = width.astype(np.uint64)
    for k in range(words):
        out = np.where(width > k, mix(out ^ word[np.minimum(at + k, len(word) - 1)]), out)
    order = np.lexsort((out, doc))
    out, doc = out[order], doc[order]
    fresh = np.ones(len(out), bool)
    fresh[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    out, doc = out[fresh], doc[fresh]
    return out, np.searchsorted(doc, np.arange(len(texts)))


def _signatures(id_col: str, text_col: str, words: int, coordinates: int):
    def run(batches):
        hasher, rng = SpanHash(7), np.random.default_rng(11)
        factors = rng.integers(0, 1 << 64, coordinates, dtype=np.uint64) | np.uint64(1)
        shifts = rng.integers(0, 1 << 64, coordinates, dtype=np.uint64)
        for batch in parts(batches):
            normal = _normal(batch, text_col)
            n = np.zeros(len(normal), np.int64)
            signature = np.zeros((len(normal), coordinates), np.int32)
            full = [i for i, t in enumerate(normal) if t]
            for a, b in slices([len(normal[i]) for i in full], BLOCK):
                rows = full[a:b]
                hashes, first = _shingles([normal[i] for i in rows], words, hasher)
                n[rows] = np.diff(np.append(first, len(hashes)))
                for k in range(coordinates):
                    least = np.minimum.reduceat((hashes * factors[k] + shifts[k]) >> np.uint64(32), first)
                    signature[rows, k] = least.astype(np.uint32).view(np.int32)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(normal) + 1, dtype=np.int32) * coordinates), pa.array(signature.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(id_col),
                    batch.column("_h"),
                    pa.array([xxhash.xxh3_128_digest(t) for t in normal], pa.binary()),
                    pa.array(n),
                    lists,
                ],
                names=["id", "h", "cls", "n", "sig"],
            )

    return run


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("sig")
    return column.flatten().to_numpy().reshape(batch.num_rows, -1).view(np.uint32)


def _bucket(signature: np.ndarray) -> np.ndarray:
    """A frequency bucket for each (coordinate, value)."""
    place = np.arange(signature.shape[1], dtype=np.uint64) << np.uint64(32)
    return (mix(signature.astype(np.uint64) | place) & np.uint64(BUCKETS - 1)).astype(np.int64)


def _bucket_counts(batches):
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        if batch.num_rows:
            total += np.bincount(_bucket(_matrix(batch)).ravel(), minlength=BUCKETS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "count"])


def _postings(counts, prefix: int, longest: int):
    """Each class's rarest (coordinate, value) pairs, with the number of tasks that their list is dealt to.

    A frequency bucket's count is no less than the length of any list in it.
    """

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            signature = _matrix(batch)
            place = np.arange(signature.shape[1], dtype=np.uint64) << np.uint64(32)
            token = (signature.astype(np.uint64) | place).view(np.int64)
            # rarest first; the mixed token breaks ties the same way in every document
            common = counts.value[_bucket(signature)]
            rank = np.lexsort((mix(token.view(np.uint64)), common), axis=1)[:, :prefix]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.take_along_axis(token, rank, 1).ravel()),
                    pa.array(np.repeat(batch.column("cid").to_numpy(), prefix)),
                    pa.array(np.repeat(batch.column("n").to_numpy(), prefix)),
                    pa.array(-(-np.take_along_axis(common, rank, 1).ravel() // longest)),
                ],
                names=["token", "cid", "n", "tasks"],
            )

    return run


def _sets(text_col: str, words: int):
    def run(batches):
        hasher = SpanHash(7)
        for batch in parts(batches):
            normal = [t for t in _normal(batch, text_col) if t]
            for a, b in slices([len(t) for t in normal], BLOCK):
                hashes, first = _shingles(normal[a:b], words, hasher)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.append(first, len(hashes)).astype(np.int32)), pa.array(hashes.view(np.int64))
                )
                keys = pa.array([xxhash.xxh3_128_digest(t) for t in normal[a:b]], pa.binary())
                yield pa.RecordBatch.from_arrays([keys, lists], names=["cls", "set"])

    return run


def agreeing(percent: int, coordinates: int) -> int:
    """The most coordinates, one at least, in which a pair at ``percent`` agrees but for a probability of MISS."""
    share, less = percent / 100, 0.0
    for k in range(coordinates):
        less += comb(coordinates, k) * share**k * (1 - share) ** (coordinates - k)
        if less > MISS:
            return max(k, 1)
    return coordinates


class _Search:
    """The tables of one call and the steps over them."""

    def __init__(self, docs, id_col, text_col, words, percent, coordinates, agree, small, longest):
        self.spark, self.docs = docs.sparkSession, docs
        self.id_col, self.text_col, self.words, self.percent = id_col, text_col, words, percent
        self.agree, self.small = agree, small
        self.scratch = Scratch(self.spark, "near")
        kind = docs.schema[id_col].dataType.simpleString()
        self.rows = self.scratch.store(
            docs.select(id_col, text_col, F.xxhash64(text_col).alias("_h")).mapInArrow(
                _signatures(id_col, text_col, words, coordinates), f"id {kind}, h long, cls binary, n long, sig array<int>"
            ),
            "rows",
        )
        grouped = self.rows.filter("n > 0 AND id IS NOT NULL").groupBy("cls")
        self.classes = self.scratch.store(
            grouped.agg(F.min("id").alias("first"), F.first("n").alias("n"), F.first("sig").alias("sig")).withColumn(
                "cid", F.monotonically_increasing_id()
            ),
            "classes",
        )
        counts = np.zeros(BUCKETS, np.int64)
        found = (
            self.classes.select("sig").mapInArrow(_bucket_counts, "bucket long, count long")
            .groupBy("bucket").agg(F.sum("count").alias("count")).toPandas()
        )  # at most BUCKETS rows at any input size
        counts[found["bucket"].to_numpy(np.int64)] = found["count"].to_numpy(np.int64)
        self.postings = self.scratch.store(
            self.classes.select("cid", "n", "sig").mapInArrow(
                _postings(
                    self.spark.sparkContext.broadcast(counts), coordinates - agree + 1, max(longest, 4 * int(counts.mean()))
                ),
                "token long, cid long, n long, tasks long",
            ),
            "postings",
        )

    def viable(self):
        """Whether a pair's common part, at most ``top`` for either side, can reach the threshold."""
        top = F.least("top", "ptop")
        return top * 100 >= (F.col("n") + F.col("pn") - top) * self.percent

    @staticmethod
    def joined(lists: DataFrame, keyed: DataFrame, how: str = "inner") -> DataFrame:
        """lists joined with rows keyed by token, a long list in several tasks that get a copy of its row each."""
        lists = lists.withColumn("task", F.pmod(F.xxhash64("cid"), "tasks"))
        first = F.lit(0).cast("long")
        keyed = keyed.withColumn("task", F.explode(F.sequence(first, F.col("tasks") - 1))).drop("tasks")
        return lists.join(keyed, ["token", "task"], how).drop("task")

    def with_pivots(self, lists: DataFrame) -> DataFrame:
        """Each list's rows beside its pivot, the member with the least share of private shingles."""
        best = F.struct(
            (-F.col("top") / F.col("n")).alias("share"), F.xxhash64("cid").alias("h"),
            F.col("cid").alias("p"), F.col("n").alias("pn"), F.col("top").alias("ptop"),
        )
        pivot = lists.groupBy("token").agg(F.min(best).alias("x"), F.count("*").alias("c"), F.max("tasks").alias("tasks"))
        return self.joined(lists, pivot.filter("c > 1").select("token", "tasks", "x.p", "x.pn", "x.ptop"))

    def star(self, lists: DataFrame) -> DataFrame:
        """Viable pairs of each list's pivot with its other members."""
        pairs = self.with_pivots(lists).filter((F.col("cid") != F.col("p")) & self.viable())
        return pairs.select(F.least("cid", "p").alias("a"), F.greatest("cid", "p").alias("b"))

    def rest(self, lists: DataFrame, sets: DataFrame, name: str) -> DataFrame:
        """Links across components among the members around one pivot, tested exactly."""
        low = F.col("n") * self.percent / 100
        high = F.col("top") * (100 / self.percent + 1) - F.col("n")
        # sizes of texts that a member could be linked with run from low to high; most members have none
        around = (
            self.with_pivots(lists).filter(high >= low)
            .select(F.col("p").alias("pivot"), "cid", "n", "top", "label").distinct()
        )
        spread = around.groupBy("pivot").agg((F.min("label") != F.max("label")).alias("open")).filter("open")
        around = self.scratch.store(around.join(spread.select("pivot"), "pivot", "left_semi"), f"{name}-some")
        differs = F.concat(F.array_except("set", "pset"), F.array_except("pset", "set"))
        around = self.scratch.store(
            around.join(sets, "cid").join(sets.toDF("pivot", "pset"), "pivot")
            .select("pivot", "cid", "n", "top", "label", differs.alias("d")),
            f"{name}-around",
        )
        largest = (
            around.groupBy("pivot", "label").agg(F.count("*").alias("c"))
            .groupBy("pivot").agg(F.max(F.struct("c", "label")).alias("x"))
            .select("pivot", F.col("x.label").alias("main"))
        )
        band = lambda size: F.floor(F.log(size) * 40)  # noqa: E731  bands of 2.5 percent
        left = (
            around.join(largest, "pivot")
            .filter(F.col("label") != F.col("main"))
            .select(
                "pivot", F.col("cid").alias("p"), F.col("n").alias("pn"), F.col("top").alias("ptop"),
                F.col("label").alias("plabel"), F.col("d").alias("pd"),
                F.explode(F.sequence(band(low) - 1, band(high) + 1)).alias("band"),
            )
        )
        apart = F.size("d") + F.size("pd") - 2 * F.size(F.array_intersect("d", "pd"))
        links = around.withColumn("band", band(F.col("n"))).join(left, ["pivot", "band"]).filter(
            (F.col("label") != F.col("plabel"))
            & self.viable()
            & ((F.col("n") + F.col("pn")) * (100 - self.percent) >= apart * (100 + self.percent))
        )
        links = links.select(F.least("cid", "p").alias("a"), F.greatest("cid", "p").alias("b")).distinct()
        return self.scratch.store(links, f"{name}-links")

    def tops(self, sets: DataFrame, name: str) -> DataFrame:
        """(cid, top): how many shingles of a set at least one other set has, or seems to have."""
        # 31 bits of a shingle's hash: a clash only makes the bound weaker
        each = sets.select("cid", F.explode("set").alias("h")).select(
            "cid", F.col("h").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("h")
        )
        private = (
            each.groupBy("h").agg(F.count("*").alias("c"), F.min("cid").alias("cid")).filter("c = 1")
            .groupBy("cid").agg(F.count("*").alias("private"))
        )
        return self.scratch.store(
            sets.select("cid", F.size("set").cast("long").alias("n")).join(private, "cid", "left")
            .select("cid", (F.col("n") - F.coalesce("private", F.lit(0))).alias("top")),
            name,
        )

    def open_lists(self, postings: DataFrame, links: DataFrame, name: str) -> DataFrame:
        """Postings, with their components, of lists of three and more that span several components."""
        labels = components(links, self.scratch, name)
        marked = postings.drop("label").join(labels.withColumnRenamed("v", "cid"), "cid", "left").withColumn(
            "label", F.coalesce("label", "cid")
        )
        spread = (
            marked.groupBy("token")
            .agg(
                F.count("*").alias("c"), F.min("label").alias("lo"), F.max("label").alias("hi"), F.max("tasks").alias("tasks")
            )
            .filter("c > 2 AND lo != hi")
            .select("token", "tasks")
        )
        return self.scratch.store(self.joined(marked, spread, "left_semi"), f"{name}-open")

    def full_sets(self, cids: DataFrame, name: str) -> DataFrame:
        """(cid, set): whole shingle sets of classes, computed from their texts."""
        keys = self.scratch.store(self.classes.select("cid", "cls", "first").join(cids, "cid"), f"{name}-keys")
        ids = broadcast_if_small(keys.select(F.col("first").alias(self.id_col)), self.small)
        sets = (
            self.docs.select(self.id_col, self.text_col)
            .join(ids, self.id_col, "left_semi")
            .mapInArrow(_sets(self.text_col, self.words), "cls binary, set array<long>")
            .join(keys.select("cid", "cls"), "cls")
            .dropDuplicates(["cid"])
            .select("cid", "set")
        )
        return self.scratch.store(sets, f"{name}-sets")

    def confirm(self, pairs: DataFrame, name: str, sets: DataFrame | None = None) -> DataFrame:
        """Links among pairs: those whose signatures agree and whose full sets then do."""
        pairs = pairs.distinct()
        sig = self.classes.select("cid", "n", "sig")
        for side in "ab":
            pairs = pairs.join(sig.toDF(side, f"n{side}", f"sig{side}"), side)
        same = F.aggregate(F.zip_with("siga", "sigb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
        pairs = self.scratch.store(pairs.filter(same >= self.agree).select("a", "b", "na", "nb"), f"{name}-pairs")
        if sets is None:
            keys = pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()
            sets = self.full_sets(keys, name)
        held = pairs
        for side in "ab":
            held = held.join(sets.toDF(side, f"set{side}"), side)
        both = F.size(F.array_intersect("seta", "setb"))
        links = held.filter(both * 100 >= (F.col("na") + F.col("nb") - both) * self.percent).select("a", "b")
        links = self.scratch.store(links, f"{name}-links")
        self.scratch.drop(f"{name}-sets", f"{name}-keys", f"{name}-pairs")
        return links


def _labelled(docs, id_col, text_col, words, percent, coordinates, agree, small, longest=1024) -> DataFrame:
    """(id, h, n, component, kept) of each row of docs, h the hash of its text; see near_duplicates."""
    agree = agreeing(percent, coordinates) if agree is None else agree
    search = _Search(docs, id_col, text_col, words, percent, coordinates, agree, small, longest)
    links = search.confirm(search.star(search.postings.withColumn("top", F.col("n"))), "star")
    lists = search.open_lists(search.postings, links, "open")
    if lists.limit(1).count():
        sets = search.full_sets(lists.select("cid").distinct(), "open")
        lists = lists.join(search.tops(sets, "tops"), "cid")
        links = links.unionByName(search.confirm(search.star(lists), "second", sets))
        links = links.unionByName(search.rest(search.open_lists(lists, links, "rest"), sets, "rest"))
        search.scratch.drop("open-sets", "open-keys", "rest-around")
    labels = components(links, search.scratch, "final").withColumnRenamed("v", "cid")
    classes = search.classes.select("cid", "cls", "first").join(labels, "cid", "left")
    linked = classes.filter("label IS NOT NULL")
    least = linked.groupBy("label").agg(F.min("first").alias("least"))
    named = search.scratch.store(
        linked.join(least, "label")
        .select("cls", F.col("least").alias("component"))
        .unionByName(classes.filter("label IS NULL").select("cls", F.col("first").alias("component"))),
        "named",
    )
    alone = search.rows.filter("n = 0 OR id IS NULL").select("id", "h", "n", F.col("id").alias("component"))
    others = search.rows.filter("n > 0 AND id IS NOT NULL").join(named, "cls").select("id", "h", "n", "component")
    return others.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component")))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 85,
    coordinates: int = 32,
    agree: int | None = None,
    small: int = 500_000,
    longest: int = 1024,
) -> DataFrame:
    """One row per row of docs: id, ``n_shingles``, ``component_id``, ``kept``.

    Two documents are linked when 100 times the common part of their shingle sets is at least ``percent`` times
    the union; ``component_id`` is the smallest id reachable. A pair must agree in ``agree`` coordinates, by default
    so many that one at the threshold is missed with a probability of at most 2e-6 and more alike ones with less:
    of 32 it is 16 at 85 percent (6e-7) and 14 at 80 (1.2e-6). Below 35 percent one of 32 is too much to ask for
    that; take more coordinates there. ``small`` bounds the rows that are broadcast. A list that may have more than
    ``longest`` members (or, in large tables, four times as many as the mean frequency bucket) is dealt to several
    tasks, with the same result. A text of fewer than ``words``
    words is one shingle; an empty or null text, or a null id, is linked with nothing and kept. Rows that share an
    id are one document with several texts. An empty table gives no rows and other columns are not read. Needs
    about 60 bytes of memory per byte of the longest text.
    """
    rows = _labelled(docs, id_col, text_col, words, percent, coordinates, agree, small, longest)
    return rows.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        "kept",
    )


def without_near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 80,
    small: int = 500_000,
    whole_ids: bool = True,
) -> DataFrame:
    """The rows of docs whose id is the smallest of its component; rows with a null id stay.

    Rows that share an id fall together, or each by its own text where ``whole_ids`` is false. All columns of docs
    come back as they were, whatever their names; an empty table gives no rows.
    """
    names = ["_id"] if whole_ids else ["_id", "_h"]
    docs, id_col, text_col, named = numbered_columns(docs, id_col, text_col)
    rows = _labelled(docs, id_col, text_col, words, percent, 32, None, small)
    out = rows.filter("NOT kept").select(F.col("id").alias("_id"), F.col("h").alias("_h")).select(*names).distinct()
    dropped = Scratch(docs.sparkSession, "near").store(out, "dropped")
    keyed = docs.withColumn("_id", F.col(id_col))
    keyed = keyed if whole_ids else keyed.withColumn("_h", F.xxhash64(text_col))
    return keyed.join(broadcast_if_small(dropped, small), names, "left_anti").select(*named)
