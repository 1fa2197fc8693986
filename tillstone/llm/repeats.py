"""Removal of repeated byte strings by sampled suffixes with inherited extents.

Every window of ``width`` bytes names one of its inner grams, the least by
hash and leftmost, so equal windows name the same place in them. Neighbouring
windows mostly name the same gram: they form a run, the sampled suffix that
stands for all of them. A run is the tuple (gram, content of the whole run,
document, start). Runs with equal content settle all their windows at once:
the first occurrence stays, the others are covered. Only where one gram has
runs of different content, at the edges of a shared passage, are single
windows compared, and of these only those of each content's first occurrence:
within a task that gets the bytes of a gram's runs, or, for a gram with very
many of them, by a shuffle of the windows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.llm.bytehash import SpanHash, mix
from tillstone.llm.common import Scratch, broadcast_if_small, parts

GRAM = 32
BLOCK = 1 << 20
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _anchors(grams: np.ndarray, n: int) -> np.ndarray:
    """For each start, the place of the least of the n grams from there on; the leftmost of equal ones."""
    value, place, size = grams, np.arange(len(grams), dtype=np.int32), 1
    while size < n:
        step = min(size, n - size)
        right = value[step:]
        take = right < value[: len(right)]
        place = np.where(take, place[step:], place[: len(right)])
        value = np.where(take, right, value[: len(right)])
        size += step
    return place


def _blocks(texts: list[bytes], width: int):
    """Pieces of about BLOCK bytes: (text numbers, offsets in their texts, bytes); longer texts overlap by a window."""
    rows, size = [], 0
    for i, data in enumerate(texts):
        if len(data) < width:
            continue
        for at in range(0, len(data) - width + 1, BLOCK):
            part = data[at : at + BLOCK + width - 1]
            if rows and size + len(part) > BLOCK:
                yield rows
                rows, size = [], 0
            rows.append((i, at, part))
            size += len(part)
    if rows:
        yield rows


class _Runs:
    def __init__(self, width: int):
        self.width, self.gram, self.span = width, SpanHash(21), SpanHash(22)

    def block(self, rows):
        """Text number, first start in it, count of windows, gram hash and content hash of each run."""
        data = np.frombuffer(b"".join(part for _, _, part in rows), np.uint8)
        sizes = np.fromiter((len(part) for _, _, part in rows), np.int64, len(rows))
        first = np.cumsum(sizes) - sizes
        at = np.arange(len(data) - GRAM + 1)
        grams = mix(self.gram.spans(self.gram.prefix(data), at, at + GRAM))
        place = _anchors(grams, self.width - GRAM + 1)
        piece = np.repeat(np.arange(len(rows)), sizes)[: len(place)]
        start = np.flatnonzero(at[: len(place)] + self.width <= (first + sizes)[piece])
        new = np.ones(len(start), bool)
        new[1:] = (place[start[1:]] != place[start[:-1]]) | (np.diff(start) > 1)
        head = np.flatnonzero(new)
        count = np.diff(np.append(head, len(start)))
        p = start[head]
        q = place[p]
        sums = self.span.prefix(data)
        content = self.span.spans(sums, p, p + count - 1 + self.width)
        content = mix(content + (q - p).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + count.astype(np.uint64))
        owner = piece[p]
        text = np.fromiter((i for i, _, _ in rows), np.int64, len(rows))[owner]
        begin = p - first[owner] + np.fromiter((a for _, a, _ in rows), np.int64, len(rows))[owner]
        return text, begin, count, grams[q], content


def _binary(batch: pa.RecordBatch) -> list[bytes]:
    return pc.fill_null(batch.column("text").cast(pa.large_string()), "").cast(pa.large_binary()).to_pylist()


def _sample(width: int, whole: bool):
    """Runs of each text. Of runs alike within a batch the first goes on, the others are covered at once.

    Without ``whole`` only the gram hashes of the runs that go on are put out.
    """

    def run(batches):
        finder = _Runs(width)
        for batch in batches:
            found = [finder.block(rows) for rows in _blocks(_binary(batch), width)]
            if not found:
                continue
            text, begin, count, gram, content = (np.concatenate(c) for c in zip(*found))
            ids = batch.column("id").to_pylist()
            tids = batch.column("tid").to_numpy()
            order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0, tids[i]))
            same = np.array([ids[a] == ids[b] and tids[a] == tids[b] for a, b in zip(order, order[1:])], bool)
            rank = np.empty(len(ids), np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(~same)])
            by = np.lexsort((begin, rank[text], content, gram))
            g, c, key = gram[by], content[by], np.stack([rank[text][by], begin[by]], axis=1)
            head = np.ones(len(by), bool)
            head[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1])
            if not whole:
                # rows alike in id, text and place are one occurrence, and one gram needs to be counted once a kind
                yield pa.RecordBatch.from_arrays([pa.array(g[head].view(np.int64))], names=["gram"])
                continue
            lead = np.maximum.accumulate(np.where(head, np.arange(len(by)), 0))
            alike = (key == key[lead]).all(axis=1)  # the first itself, or a row that is equal to the first's row
            for part, done in ((by[alike], False), (by[~alike], True)):
                if done:
                    part = part[np.lexsort((begin[part], text[part]))]
                    stop = begin[part] + count[part] - 1 + width
                    # covered stretches that touch in one text become one row
                    high = np.maximum.accumulate(stop + text[part] * (1 << 40)) if len(part) else stop
                    fresh = np.ones(len(part), bool)
                    fresh[1:] = begin[part][1:] + text[part][1:] * (1 << 40) > high[:-1]
                    heads = np.flatnonzero(fresh)
                    last = np.append(heads[1:], len(part)) - 1 if len(part) else heads
                    end = high[last] - text[part][last] * (1 << 40) if len(part) else stop
                    part, n = part[heads], end - begin[part[heads]] - width + 1
                else:
                    n = count[part]
                owner = pa.array(text[part])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(gram[part].view(np.int64)),
                        pa.array(content[part].view(np.int64)),
                        batch.column("id").take(owner),
                        batch.column("tid").take(owner),
                        pa.array(begin[part]),
                        pa.array(n.astype(np.int64)),
                        pa.array(np.full(len(part), done)),
                    ],
                    names=["gram", "content", "id", "tid", "start", "n", "done"],
                )

    return run


def _edges(batches):
    """(gram, hot, id, tid, start, bytes) of listed runs."""
    for part in parts(batches):
        owner, columns = [], ([], [], [], [])
        for i, (data, runs) in enumerate(zip(_binary(part), part.column("runs").to_pylist())):
            for r in runs:
                owner.append(i)
                for column, value in zip(columns, (r["gram"], r["hot"], r["start"], data[r["start"] : r["end"]])):
                    column.append(value)
        if owner:
            owner = pa.array(owner)
            gram, hot, start, data = columns
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(gram, pa.int64()), pa.array(hot, pa.bool_()), part.column("id").take(owner),
                    part.column("tid").take(owner), pa.array(start, pa.int64()), pa.array(data, pa.binary()),
                ],
                names=["gram", "hot", "id", "tid", "start", "data"],
            )


def _exploded(finder: _Runs, data: list[bytes]):
    """Row number, place in the row and content hash of each window of these byte strings."""
    sizes = np.fromiter(map(len, data), np.int64, len(data))
    first = np.cumsum(sizes) - sizes
    count = sizes - finder.width + 1
    row = np.repeat(np.arange(len(data)), count)
    place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    at = first[row] + place
    sums = finder.span.prefix(np.frombuffer(b"".join(data), np.uint8))
    return row, place, mix(finder.span.spans(sums, at, at + finder.width))


def _windows(width: int):
    """(gram, window hash, id, tid, start) of the single windows of runs."""

    def run(batches):
        finder = _Runs(width)
        for batch in batches:
            row, place, window = _exploded(finder, batch.column("data").to_pylist())
            owner = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("gram").take(owner), pa.array(window.view(np.int64)), batch.column("id").take(owner),
                    batch.column("tid").take(owner), pa.array(batch.column("start").to_numpy()[row] + place),
                ],
                names=["gram", "window", "id", "tid", "start"],
            )

    return run


def _settled(width: int):
    """(id, tid, start, end) of covered stretches of runs that come grouped by gram; whole grams are held, a few at a time."""

    def settle(finder: _Runs, runs: pa.Table) -> pa.Table:
        runs = runs.take(pc.sort_indices(runs, [(k, "ascending") for k in ("id", "tid", "start")], null_placement="at_end"))
        row, place, window = _exploded(finder, runs.column("data").to_pylist())
        gram = runs.column("gram").to_numpy()[row]
        by = np.lexsort((window, gram))  # stable: of equal windows the earliest comes first
        again = np.zeros(len(by), bool)
        again[by[1:]] = (gram[by[1:]] == gram[by[:-1]]) & (window[by[1:]] == window[by[:-1]])
        joined = np.zeros(len(by), bool)
        joined[1:] = again[1:] & again[:-1] & (row[1:] == row[:-1])
        head = np.flatnonzero(again & ~joined)
        tail = np.flatnonzero(again & ~np.append(joined[1:], False))
        start = runs.column("start").to_numpy()[row[head]]
        owner = pa.array(row[head])
        return pa.table(
            [runs.column("id").take(owner), runs.column("tid").take(owner), pa.array(start + place[head]), pa.array(start + place[tail] + width)],
            names=["id", "tid", "start", "end"],
        )

    def run(batches):
        finder, held, last = _Runs(width), [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            gram = batch.column("gram").to_numpy()
            cut = int(np.searchsorted(gram, gram[-1]))  # the last gram may go on in the next batch
            held.append(batch.slice(0, cut))
            if cut or gram[0] != last:
                ready = pa.Table.from_batches(held)
                if ready.num_rows:
                    yield from settle(finder, ready).to_batches()
                held = []
            held.append(batch.slice(cut))
            last = gram[-1]
        if held:
            yield from settle(finder, pa.Table.from_batches(held)).to_batches()

    return run


def _merged(batches):
    """Covered stretches of each text as maximal disjoint ones in order."""
    for batch in parts(batches):
        merged = []
        for cover in batch.column("cover").to_pylist():
            out = []
            for start, end in sorted((c["start"], c["end"]) for c in cover):
                if out and start <= out[-1]["end"]:
                    out[-1]["end"] = max(out[-1]["end"], end)
                else:
                    out.append({"start": start, "end": end})
            merged.append(out)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("tid"), pa.array(merged, SPANS)], names=["id", "tid", "cover"]
        )


def _cut(batches):
    """Removed stretches of each text, and size and hash of what is left."""
    for batch in batches:
        spans, kept = [], []
        for data, cover in zip(_binary(batch), batch.column("cover").to_pylist()):
            spans.append(cover or [])
            edges = [0, *(x for c in spans[-1] for x in (c["start"], c["end"])), len(data)]
            kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                pa.array(spans, SPANS),
                pa.array([len(k) for k in kept], pa.int64()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
            ],
            names=["id", "removed", "n_kept", "kept_sha256"],
        )


def _lists_broadcast_if_small(df: DataFrame, column: str, entries: int) -> DataFrame:
    """Mark a stored table for broadcast when its lists have at most so many entries in all."""
    total = df.agg(F.sum(F.size(column))).first()[0] or 0
    return F.broadcast(df) if total <= entries else df


def repeated_bytes(
    docs: DataFrame,
    width: int = 100,
    id_col: str = "doc_id",
    text_col: str = "text",
    small: int = 2_000_000,
    group: int = 2_000,
) -> DataFrame:
    """One row per row of docs: id, ``removed`` (maximal byte ranges start, end), ``n_kept``, ``kept_sha256``.

    A byte is removed when a string of ``width`` bytes over it also starts earlier, in a smaller id or earlier in
    the same text, judged on the whole input in UTF-8. Null text is empty; null ids come last; rows that share an
    id are different texts in the order of their hash, unless the texts are equal too: then they are one row and
    fare alike. Shorter texts and empty tables lose nothing; other columns are not read. ``small`` bounds what is
    broadcast, in rows or list entries. Grams with up to ``group`` different runs are settled within a task, those
    with more by a shuffle of their windows, with equal results. Windows are told apart by 128 bits of hash. A text
    of any length is read whole, in blocks that overlap by a window.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeats")
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tid"), F.col(text_col).alias("text"))
    grams = texts.mapInArrow(_sample(width, False), "gram long").groupBy("gram").agg(F.count("*").alias("c"))
    grams = scratch.store(grams.filter("c > 1").select("gram"), "grams")
    schema = f"gram long, content long, id {kind}, tid long, start long, n long, done boolean"
    runs = texts.mapInArrow(_sample(width, True), schema)
    known = broadcast_if_small(grams.withColumn("again", F.lit(True)), small)
    runs = scratch.store(runs.join(known, "gram", "left").filter("done OR again").drop("again"), "runs")

    key = F.struct(F.col("id").isNull().alias("last"), "id", "tid", "start")
    # a run that many texts share is brought down to one row a task first, and its join can be split
    rest = runs.filter("NOT done").drop("done").withColumn("key", key)
    first = rest.groupBy("gram", "content").agg(F.min("key").alias("first"))
    runs_left = scratch.store(
        rest.join(first, ["gram", "content"]).withColumn("stays", F.col("key") == F.col("first")).drop("key", "first"), "judged"
    )
    kinds = runs_left.filter("stays").groupBy("gram").agg(F.countDistinct("content").alias("c")).filter("c > 1")
    kinds = kinds.select("gram", (F.col("c") > group).alias("hot"))
    stretch = F.struct("gram", "hot", "start", (F.col("start") + F.col("n") - 1 + width).alias("end"))
    edge = runs_left.filter("stays").join(kinds, "gram").groupBy("id", "tid").agg(F.collect_set(stretch).alias("runs"))
    edge = _lists_broadcast_if_small(scratch.store(edge, "listed"), "runs", small)
    same = lambda a, b: (a["id"].eqNullSafe(b["id"])) & (a["tid"] == b["tid"])
    listed = texts.join(edge, same(texts, edge)).select(texts["id"], texts["tid"], "text", "runs")
    edges = listed.mapInArrow(_edges, f"gram long, hot boolean, id {kind}, tid long, start long, data binary")
    edges = scratch.store(edges, "edges")
    cold = edges.filter("NOT hot").repartition("gram").dropDuplicates(["gram", "id", "tid", "start"]).sortWithinPartitions("gram")
    cold = cold.select("gram", "id", "tid", "start", "data").mapInArrow(_settled(width), f"id {kind}, tid long, start long, end long")
    windows = edges.filter("hot").mapInArrow(_windows(width), f"gram long, window long, id {kind}, tid long, start long")
    least = windows.groupBy("gram", "window").agg(F.min(key).alias("least"), F.count("*").alias("c")).filter("c > 1")
    again = windows.join(least, ["gram", "window"]).filter(key != F.col("least"))

    end = (F.col("start") + F.col("n") - 1 + width).alias("end")
    cover = (
        runs.filter("done").select("id", "tid", "start", end)
        .unionByName(runs_left.filter("NOT stays").select("id", "tid", "start", end))
        .unionByName(cold)
        .unionByName(again.select("id", "tid", "start", (F.col("start") + width).alias("end")))
    )
    cover = cover.groupBy("id", "tid").agg(F.collect_set(F.struct("start", "end")).alias("cover"))
    cover = scratch.store(cover.mapInArrow(_merged, f"id {kind}, tid long, cover array<struct<start:long,end:long>>"), "cover")
    cover = _lists_broadcast_if_small(cover, "cover", small)
    found = texts.join(cover, same(texts, cover), "left").select(texts["id"], "text", "cover")
    out = found.mapInArrow(_cut, f"id {kind}, removed array<struct<start:long,end:long>>, n_kept long, kept_sha256 string")
    scratch.drop("grams", "runs", "judged", "listed", "edges")
    return out.withColumnRenamed("id", id_col)
