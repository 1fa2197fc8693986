"""Exact dedup by Patricia-trie owners.

Each map task inserts the normalised bytes of a batch into a compressed radix
trie and keeps one row per text, so a text that fills a third of the table
leaves a batch as a single row. These rows are partitioned by length and
content hash; the owner of a partition inserts the full byte strings into its
own trie. A terminal node holds the best row (most code points, then smallest
id) and the rows seen. Equality is decided by the trie, never by the hash.
A hash that comes from many batches is first dealt to about as many owners as
the root of their number, each of which passes on one row per text: neither
these nor the last owner see more than about that root of the text's copies.
A trie beyond its byte budget spills its largest subtree to an unnamed local
file and works it off afterwards; a retried task simply reads its shuffle input again.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tillstone.llm.common import Scratch, broadcast_if_small, numbered_columns

WHITE = b" \t\n\x0b\x0c\r"


class _Node:
    __slots__ = ("edge", "kids", "rows")

    def __init__(self, edge: bytes):
        self.edge, self.kids, self.rows = edge, {}, None


def _common(edge: bytes, data: bytes, at: int) -> int:
    """Length of the common prefix of edge and data[at:], by halving."""
    low, high = 0, min(len(edge), len(data) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if data.startswith(edge[low:mid], at + low):
            low = mid
        else:
            high = mid - 1
    return low


class _Spool:
    """Texts of one spilled subtree in an unnamed local file, and the prefix that they share."""

    def __init__(self):
        self.file, self.shared = tempfile.TemporaryFile(), None

    def add(self, data: bytes, rows: list) -> None:
        self.shared = data if self.shared is None else self.shared[: _common(self.shared, data, 0)]
        pickle.dump((data, rows), self.file)

    def read(self) -> Iterator[tuple[bytes, list]]:
        self.file.seek(0)
        with self.file:
            while True:
                try:
                    yield pickle.load(self.file)
                except EOFError:
                    return


class PatriciaTrie:
    """A compressed radix trie over byte strings that spills whole subtrees beyond ``budget`` bytes."""

    def __init__(self, budget: int = 64 << 20):
        self.root, self.budget = _Node(b""), budget
        self.held: dict[int, int] = {}
        self.spilled: dict[int, _Spool] = {}

    def insert(self, data: bytes, rows: list) -> None:
        if data and data[0] in self.spilled:
            self.spilled[data[0]].add(data, rows)
            return
        node, at = self.root, 0
        while at < len(data):
            kid = node.kids.get(data[at])
            if kid is None:
                kid = node.kids[data[at]] = _Node(data[at:])
                self.held[data[0]] = self.held.get(data[0], 0) + len(data) - at
                node, at = kid, len(data)
            elif data.startswith(kid.edge, at):
                node, at = kid, at + len(kid.edge)
            else:
                cut = _common(kid.edge, data, at)
                middle = _Node(kid.edge[:cut])
                kid.edge = kid.edge[cut:]
                middle.kids[kid.edge[0]] = kid
                node.kids[data[at]] = middle
                node, at = middle, at + cut
        if node.rows is None:
            node.rows = []
        node.rows.extend(rows)
        if sum(self.held.values()) > self.budget:
            branched = [first for first in self.held if self.root.kids[first].kids]
            if branched:  # a single text gains nothing from a spool
                self._spill(max(branched, key=self.held.get))

    def _spill(self, first: int) -> None:
        """Move the subtree below a first byte to a spool."""
        kid = self.root.kids[first]
        del self.root.kids[first], self.held[first]
        spool = self.spilled[first] = _Spool()
        for data, rows in self._walk(kid):
            spool.add(data, rows)

    @staticmethod
    def _walk(top: _Node) -> Iterator[tuple[bytes, list]]:
        stack = [(top, b"")]
        while stack:
            node, prefix = stack.pop()
            text = prefix + node.edge
            if node.rows is not None:
                yield text, node.rows
            stack.extend((kid, text) for kid in node.kids.values())

    def texts(self) -> Iterator[tuple[bytes, list]]:
        """Each distinct string with the rows inserted for it; spilled subtrees come last, each in a trie of its own."""
        yield from self._walk(self.root)
        self.root, spools, self.spilled = _Node(b""), self.spilled, {}
        for spool in spools.values():
            below, prefix = PatriciaTrie(self.budget), spool.shared
            for data, rows in spool.read():
                below.insert(data[len(prefix) :], rows)
            for data, rows in below.texts():
                yield prefix + data, rows


def _rank(row: tuple) -> tuple:
    """Order of preference: most code points, smallest id with nulls last, first row."""
    points, doc, key = row[:3]
    return (-points, doc is None, doc if doc is not None else 0, key)


def _local(id_col: str, text_col: str):
    def run(batches):
        base, at = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            text = pc.fill_null(batch.column(text_col).cast(pa.large_string()), "")
            points = pc.utf8_length(text).to_pylist()
            ids = batch.column(id_col).to_pylist()
            trie = PatriciaTrie(budget=1 << 62)
            sizes = np.zeros(batch.num_rows, np.int64)
            hashes = np.zeros(batch.num_rows, np.int64)
            for i, data in enumerate(text.cast(pa.large_binary()).to_pylist()):
                data = data.translate(None, WHITE)
                sizes[i] = len(data)
                hashes[i] = np.uint64(xxhash.xxh3_64_intdigest(data)).astype(np.int64)
                trie.insert(data, [(points[i], ids[i], base + at + i)])
            rep = np.zeros(batch.num_rows, np.int64)
            count = np.zeros(batch.num_rows, np.int64)
            for _, rows in trie.texts():
                best = min(rows, key=_rank)[2]
                for row in rows:
                    rep[row[2] - base - at] = best
                count[best - base - at] = len(rows)
            owner = pa.array(count > 0)
            columns = [
                pc.if_else(owner, column, pa.scalar(None, column.type)) if name == text_col else column
                for name, column in zip(batch.schema.names, batch.columns)
            ]
            key = np.arange(base + at, base + at + batch.num_rows, dtype=np.int64)
            extra = {"_key": key, "_rep": rep, "_n": count, "_points": np.array(points, np.int64), "_size": sizes, "_hash": hashes}
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(v) for v in extra.values()], names=[*batch.schema.names, *extra]
            )
            at += batch.num_rows

    return run


def _grown(batches, id_col: str, text_col: str, budget: int) -> PatriciaTrie:
    """A trie of all texts of a task, whose rows are (points, id, key, rows stood for)."""
    trie = PatriciaTrie(budget)
    for batch in batches:
        text = pc.fill_null(batch.column(text_col).cast(pa.large_string()), "").cast(pa.large_binary())
        rows = zip(*(batch.column(c).to_pylist() for c in ("_points", id_col, "_key", "_n")))
        for data, row in zip(text.to_pylist(), rows):
            trie.insert(data.translate(None, WHITE), [row])
    return trie


def _halfway(id_col: str, text_col: str, id_type: pa.DataType, budget: int):
    """Of each text of a task its best row, for all rows it stands for; of the others the key and the best row's."""
    kinds = {"_key": pa.int64(), "_via": pa.int64(), "_n": pa.int64(), "_points": pa.int64(), id_col: id_type, text_col: pa.binary()}

    def made(out: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * len(kinds), kinds.values())]
        columns[-1] = columns[-1].view(pa.string())
        return pa.RecordBatch.from_arrays(columns, names=list(kinds))

    def run(batches):
        out, size = [], 0
        for data, rows in _grown(batches, id_col, text_col, budget).texts():
            best = min(rows, key=_rank)
            out.append((best[2], best[2], sum(r[3] for r in rows), best[0], best[1], data))
            out.extend((r[2], best[2], 0, r[0], r[1], None) for r in rows if r is not best)
            size += len(data)
            if len(out) >= 20_000 or size >= 16 << 20:
                yield made(out)
                out, size = [], 0
        yield made(out)

    return run


def _owners(id_col: str, text_col: str, id_type: pa.DataType, budget: int):
    def run(batches):
        out: list[tuple] = []
        for data, rows in _grown(batches, id_col, text_col, budget).texts():
            best, total = min(rows, key=_rank), sum(r[3] for r in rows)
            digest = hashlib.sha256(data).hexdigest()
            out.extend((r[2], best[1], total, best[2], digest) for r in rows)
            if len(out) >= 20_000:
                yield _owned(out, id_type)
                out = []
        yield _owned(out, id_type)

    return run


def _owned(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    kinds = {"_rep": pa.int64(), "keep_id": id_type, "group_size": pa.int64(), "_win": pa.int64(), "text_sha256": pa.string()}
    columns = list(zip(*rows)) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values())], names=list(kinds))


def _hot(single: DataFrame, often: int, scratch: Scratch) -> DataFrame:
    """(_size, _hash, _salts) of texts that stand in more than ``often`` rows of single."""
    counts = single.groupBy("_size", "_hash").agg(F.count("*").alias("c")).filter(F.col("c") > often)
    return scratch.store(counts.select("_size", "_hash", F.ceil(F.sqrt("c")).alias("_salts")), "hot")


def patricia_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = 64 << 20, often: int = 64,
    small: int = 500_000,
) -> DataFrame:
    """Every row of docs with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when their bytes are, after all ASCII white space is deleted. Other columns are kept; the
    text itself stays on kept rows and is null on most dropped ones. Null text counts as empty, null ids lose
    ties, rows with equal id and text are told apart by position so that exactly one stays, an empty table
    gives no rows, and a column of docs that has the name of a result column is left out. A text that stands in more
    than ``often`` batches passes through a level of owners more, with the same result; ``small`` bounds the rows of
    the table of such texts that is broadcast. A task holds ``budget`` bytes of text, and its longest text whole.
    """
    spark = docs.sparkSession
    taken = {"keep_id", "group_size", "kept", "text_sha256", "_key", "_rep", "_n", "_points", "_size", "_hash", "_win"}
    docs = docs.select(*[c for c in docs.columns if c not in taken])
    scratch = Scratch(spark, "trie")
    fields = [T.StructField(f.name, f.dataType) for f in docs.schema.fields]  # all nullable: dropped rows lose their text
    added = [T.StructField(c, T.LongType()) for c in ("_key", "_rep", "_n", "_points", "_size", "_hash")]
    local = scratch.store(
        docs.mapInArrow(_local(id_col, text_col), T.StructType([*fields, *added])), "local"
    )
    id_type = docs.schema[id_col].dataType
    owners_schema = T.StructType(
        [
            T.StructField("_rep", T.LongType()),
            T.StructField("keep_id", id_type),
            T.StructField("group_size", T.LongType()),
            T.StructField("_win", T.LongType()),
            T.StructField("text_sha256", T.StringType()),
        ]
    )
    arrow_id = to_arrow_type(id_type)

    def owned(rows: DataFrame) -> DataFrame:
        return rows.repartition("_size", "_hash").mapInArrow(_owners(id_col, text_col, arrow_id, budget), owners_schema)

    single = local.filter("_n > 0").select("_key", "_n", "_points", id_col, text_col, "_size", "_hash")
    hot = _hot(single, often, scratch)
    if not hot.limit(1).count():
        owners = owned(single)
    else:
        hot = broadcast_if_small(hot, small)
        passed = T.StructType(
            [*[T.StructField(c, T.LongType()) for c in ("_key", "_via", "_n", "_points")], local.schema[id_col], local.schema[text_col]]
        )
        dealt = single.join(hot, ["_size", "_hash"]).repartition("_size", "_hash", F.pmod(F.xxhash64("_key"), "_salts"))
        halfway = scratch.store(
            dealt.select("_key", "_n", "_points", id_col, text_col)
            .mapInArrow(_halfway(id_col, text_col, arrow_id, budget), passed),
            "halfway",
        )
        # the row that stands for others still has the size and hash that it brought
        best = halfway.filter("_n > 0").drop("_via").join(single.select("_key", "_size", "_hash"), "_key")
        rare = single.join(hot, ["_size", "_hash"], "left_anti")
        found = scratch.store(owned(rare.unionByName(best)), "owners")
        stood_for = halfway.filter("_n = 0").select(F.col("_key").alias("_rep"), "_via")
        owners = found.unionByName(stood_for.join(found.withColumnRenamed("_rep", "_via"), "_via").drop("_via"))
    return (
        local.join(owners, "_rep")
        .withColumn("kept", F.col("_key") == F.col("_win"))
        .drop("_key", "_rep", "_n", "_points", "_size", "_hash", "_win")
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns as they were, whatever these are called."""
    docs, id_col, text_col, named = numbered_columns(docs, id_col, text_col)
    return patricia_dedup(docs, id_col, text_col).filter("kept").select(*named)
