"""Best-fit packing of token pieces by hierarchical residual packing.

Every task packs its own items best-fit decreasing and emits bins that are
full or nearly so. Underfull bins go on as items of the next round, in fewer
and larger groups, until one group is left or a round no longer joins bins.
A group holds a bounded number of bins, so no task grows with the input.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.llm.common import Scratch, parts

END = 2
PIECES = "piece int, start long, length long, ids binary"


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):
    """The byte-level vocabulary at path; its ids equal those of the JSON form of the same vocabulary (tested)."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": 50256})


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _ids(text: str, path: str, pattern: str, plain: str) -> np.ndarray:
    """Token ids of a text. A run of about a million white spaces is too deep for the fast encoder's pattern."""
    try:
        return _encoding(path, pattern).encode_to_numpy(text, allowed_special="all")
    except ValueError:
        return np.array(_tokenizer(plain).encode(text, add_special_tokens=False).ids, np.uint32)


def _pieces(path: str, pattern: str, plain: str, capacity: int, id_col: str, text_col: str, end: int):
    def run(batches):
        for batch in parts(batches):
            owner, piece, start, length, ids = [], [], [], [], []
            for i, text in enumerate(batch.column(text_col).to_pylist()):
                tokens = np.append(_ids(text or "", path, pattern, plain), end).astype("<u4")
                n = len(tokens)
                first = n if n <= capacity else n % capacity or capacity
                cuts = [0, *range(first, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    owner.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    ids.append(tokens[a:b].tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(id_col).take(pa.array(owner, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                names=[id_col, "piece", "start", "length", "ids"],
            )

    return run


def token_pieces(
    docs: DataFrame,
    capacity: int = 1024,
    vocabulary: str | None = None,
    pattern: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    end: int = END,
    plain: str | None = None,
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: id, piece, start, length, ids (little-endian unsigned 32-bit).

    A document is its token ids and then ``end``. Only longer documents are cut, and only the first piece may
    then be shorter. Null text counts as empty and gives the end id alone. A text of any length is encoded whole;
    one that ``vocabulary``'s encoder refuses, as it does runs of about a million white spaces, gets its ids from the
    JSON form ``plain`` of the same vocabulary. Memory per task follows the longest text.
    """
    import public_tokenizers

    path = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    pattern = pattern or public_tokenizers.PATTERN
    plain = plain or public_tokenizers.path("byte_bpe_50k.json")
    schema = T.StructType([docs.select(id_col).schema[0], *T._parse_datatype_string(PIECES).fields])
    return docs.select(id_col, text_col).mapInArrow(
        _pieces(path, pattern, plain, capacity, id_col, text_col, end), schema
    )


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-fit decreasing: items in bin order, and the first index of each bin in that order (and the end)."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    members: list[list[int]] = []
    open_rooms = 0  # bit r is set when some bin has r tokens of room
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = open_rooms >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            b = room[left].pop()
            if not room[left]:
                open_rooms &= ~(1 << left)
        else:
            left, b = capacity, len(members)
            members.append([])
        members[b].append(i)
        left -= size
        if left:
            room[left].append(b)
            open_rooms |= 1 << left
    order = np.fromiter((i for m in members for i in m), np.int64, len(sizes))
    bounds = np.concatenate([[0], np.cumsum([len(m) for m in members], dtype=np.int64)]).astype(np.int64)
    return order, bounds


def _pack(capacity: int, near: int, chunk: int):
    """Arrow function over rows (fill, items): packs up to ``chunk`` rows at a time."""

    def pack(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        fill, items = table.column("fill").to_numpy(), table.column("items").combine_chunks()
        order, bounds = best_fit(fill, capacity)
        items = items.take(pa.array(order))
        inner = np.concatenate([[0], np.cumsum(items.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)])
        offsets = pa.array(inner[bounds].astype(np.int32))
        total = np.add.reduceat(fill[order], bounds[:-1]) if len(fill) else fill
        return pa.RecordBatch.from_arrays(
            [pa.array(total.astype(np.int64)), pa.ListArray.from_arrays(offsets, items.flatten()), pa.array(total >= capacity - near)],
            names=["fill", "items", "closed"],
        )

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= chunk:
                yield pack(pa.Table.from_batches(held))
                held, rows = [], 0
        if rows:
            yield pack(pa.Table.from_batches(held))

    return run


def _unpack(size_col: str):
    def run(batches):
        base, at = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            items = batch.column("items")
            lengths = items.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = items.flatten()
            sizes = flat.field(size_col).to_numpy(zero_copy_only=False).astype(np.int64)
            before = np.cumsum(sizes) - sizes
            first = np.cumsum(lengths) - lengths
            sequence = np.repeat(np.arange(base + at, base + at + len(lengths), dtype=np.int64), lengths)
            yield pa.RecordBatch.from_arrays(
                [*flat.flatten(), pa.array(sequence), pa.array(before - np.repeat(before[first], lengths))],
                names=[*(f.name for f in flat.type), "sequence_id", "offset"],
            )
            at += batch.num_rows

    return run


def pack(
    items: DataFrame,
    size_col: str = "length",
    capacity: int = 1024,
    near: int = 0,
    chunk: int = 20_000,
    fan_in: int = 8,
) -> DataFrame:
    """All rows of items with ``sequence_id`` and ``offset`` in sequences of at most ``capacity``.

    Sizes must lie between 1 and capacity; a row with another size, or none, gets a null place. ``near`` is
    the room that a bin may keep and still count as full, ``chunk`` the most bins packed together and
    ``fan_in`` how many groups of one round meet in one of the next. Equal items are packed alike. An empty
    table gives no rows; columns named sequence_id or offset are replaced.
    """
    spark = items.sparkSession
    scratch = Scratch(spark, "pack")
    items = scratch.store(items.drop("sequence_id", "offset"), "items")
    size = F.col(size_col)
    alone = items.filter(size == capacity)
    odd = items.filter(size.isNull() | (size < 1) | (size > capacity))
    part = items.filter((size >= 1) & (size < capacity))
    bins = part.select(size.cast("long").alias("fill"), F.array(F.struct(*part.columns)).alias("items"))
    schema = T.StructType([*bins.schema.fields, T.StructField("closed", T.BooleanType())])
    step = _pack(capacity, near, chunk)

    done: list[DataFrame] = []
    packed = scratch.store(bins.mapInArrow(step, schema), "round0")
    before, groups, rounds = None, max(1, packed.rdd.getNumPartitions()), 0
    while True:
        done.append(packed.filter("closed"))
        rest = packed.filter("not closed").select("fill", "items")
        left = rest.count()
        useless = before is not None and left > 0.995 * before
        if left <= 1 or useless or (before is not None and groups == 1):
            break
        groups = max(1, -(-groups // fan_in), -(-left // chunk))
        before, rounds = left, rounds + 1
        packed = scratch.store(rest.repartition(groups).mapInArrow(step, schema), f"round{rounds}")
    done.append(packed.filter("not closed"))
    sequences = done[0]
    for more in done[1:]:
        sequences = sequences.unionByName(more)

    out = T.StructType(
        [*items.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    placed = sequences.select("items").mapInArrow(_unpack(size_col), out)
    full = alone.withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    nowhere = odd.withColumn("sequence_id", F.lit(None).cast("long")).withColumn("offset", F.lit(None).cast("long"))
    return placed.unionByName(full).unionByName(nowhere)
