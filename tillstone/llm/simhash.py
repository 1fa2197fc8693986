"""SimHash near duplicates by a segment-popcount embedding.

A fingerprint's 64 bits are cut into 32 segments of two bits, and the number
of set bits in each segment is its place in a 32-dimensional grid. One differing
bit moves a fingerprint by at most one step in one dimension, so the Manhattan
distance of two places never exceeds the number of differing bits. Segments are
dealt to d // 3 + 1 parts: of two fingerprints with at most d differing bits
the places differ by r = d // parts <= 2 steps at most in some part. Each
distinct fingerprint is posted, for each part, under its own cell and all cells
one step away; two places at most two steps apart have such a cell in common.
Pairs that meet are verified on their exact bits inside the join, which puts
out links alone.

Equal fingerprints are one vertex, so copies are never compared. Near copies are
first linked to pivots: of all fingerprints with one place in a part, or in half
of one, the one with the most neighbours of that kind is held against the
others. What pivots join need not be joined again, so the grid join only puts
out links between fingerprints of different groups. Cells that too many
fingerprints share are dealt to blocks, every pair of which is joined by itself:
no task gets more than two blocks, and no pair is left out.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.llm.common import Scratch, broadcast_if_small, parts
from tillstone.llm.graph import components

SEED = 42
SEGMENTS = 32
BLOCK = 1 << 20  # bytes of one text that are held as words at a time
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _word_blocks(data: bytes, words: int, size: int):
    """Lists of lower-cased words that follow each other, each list led by the last words - 1 of the one before."""
    at, kept = 0, []
    while at < len(data):
        gap = _SPACE.search(data, at + size) if at + size < len(data) else None
        end = gap.start() if gap else len(data)
        block = kept + data[at:end].lower().split()
        yield block
        kept, at = block[-(words - 1) :] if words > 1 else [], end


def _shingle_hashes(data: bytes, words: int, size: int):
    """Arrays of the hashes of all word shingles of a text, repeats included; of a shorter text, of all its words."""
    few = True
    block: list[bytes] = []
    for block in _word_blocks(data, words, size):
        if len(block) >= words:
            few = False
            joined = b" ".join(block)
            gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
            starts = np.concatenate([[0], gaps + 1])[: len(block) - words + 1].tolist()
            ends = np.append(gaps, len(joined))[words - 1 :].tolist()
            digest = xxhash.xxh64_intdigest
            yield np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, len(starts))
    if few and block:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(block), SEED)], np.uint64)


def fingerprint(data: bytes, words: int = 4, size: int = BLOCK) -> int:
    """Signed 64-bit fingerprint: a bit is set if more than half of the shingle hashes have it; 0 without words."""
    total, ones = 0, np.zeros(64, np.int64)
    for hashes in _shingle_hashes(data, words, size):
        for at in range(0, len(hashes), 1 << 16):
            some = hashes[at : at + (1 << 16)]
            total += len(some)
            ones += np.unpackbits(some.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
                0, dtype=np.int64
            )
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) of every row; one pass without a shuffle. Null text counts as empty and has fingerprint 0.

    A word is a run of characters other than ASCII white space, with A-Z in lower case; shingles are joined by one
    space. Very long texts are cut at white space into blocks, so that a task holds the words of one block.
    """
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])

    def run(batches):
        for batch in parts(batches):
            texts = pc.fill_null(batch.column("text").cast(pa.large_string()), "").cast(pa.large_binary())
            found = [fingerprint(t.as_py(), words) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.int64())], names=["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _masks(count: int) -> list[int]:
    """The 32 dimensions dealt to so many parts, each as a mask of the embedding."""
    ranges = [range(SEGMENTS * k // count, SEGMENTS * (k + 1) // count) for k in range(count)]
    return [sum(3 << 2 * i for i in dims) for dims in ranges]


def star_links(prints: DataFrame, distance: int) -> DataFrame:
    """(a, b): a pivot and a fingerprint within distance bits of it, for each place in a part and in half a part.

    The pivot is the fingerprint whose own places are the most crowded: among near copies it is near most of them.
    Linear in the number of fingerprints however many share a place. Spark sizes an exploded table by the row before,
    so joins of one are told to merge: they would broadcast it at a multiple of the threshold.
    """
    count = distance // 3 + 1
    masks = F.array(*[F.struct(F.lit(k).alias("part"), F.lit(_signed(m)).alias("mask")) for k, m in enumerate(_masks(count) + _masks(2 * count))])
    placed = prints.select("fp", embedded(F.col("fp")).alias("p"), F.explode(masks).alias("m"))
    placed = placed.select("fp", F.col("m.part").alias("part"), F.col("p").bitwiseAND(F.col("m.mask")).alias("own"))
    crowds = placed.groupBy("part", "own").agg(F.count(F.lit(1)).alias("n"))
    weights = placed.join(crowds.hint("merge"), ["part", "own"]).groupBy("fp").agg(F.sum("n").alias("weight"))
    heaviest = F.max(F.struct("weight", F.xxhash64("fp"), "fp"))["fp"]
    pivots = placed.join(weights.hint("merge"), "fp").groupBy("part", "own").agg(heaviest.alias("pivot"))
    near = (F.col("fp") != F.col("pivot")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("pivot"))) <= distance)
    return placed.join(pivots.hint("merge"), ["part", "own"]).filter(near).select(F.col("pivot").alias("a"), F.col("fp").alias("b")).distinct()


def _steps(distance: int):
    """An array literal of all moves by at most one step: the part's mask, the bits flipped and when that is a step.

    A dimension holds 0, 1 or 2 in two bits. Flipping the lower bit swaps 0 and 1 and needs a clear upper bit,
    flipping both swaps 1 and 2 and needs one of them set.
    """
    count = distance // 3 + 1
    radius = -(-(distance // count) // 2)  # both sides move by it, together by at least distance // count
    moves = []
    for part, mask in enumerate(_masks(count)):
        dims = [i for i in range(SEGMENTS) if mask >> 2 * i & 3]
        options = [(0, 0, True)]
        if radius:
            options += [x for i in dims for x in ((1 << 2 * i, 2 << 2 * i, True), (3 << 2 * i, 3 << 2 * i, False))]
        moves += [(part, mask, *option) for option in options]
    return F.array(
        *[
            F.struct(
                F.lit(part).alias("part"),
                F.lit(_signed(mask)).alias("mask"),
                F.lit(_signed(flip)).alias("flip"),
                F.lit(_signed(look)).alias("look"),
                F.lit(clear).alias("clear"),
            )
            for part, mask, flip, look, clear in moves
        ]
    )


def embedded(fp):
    """The set bits of each two-bit segment, in the two bits of that segment."""
    odd, even = fp.bitwiseAND(F.lit(0x5555555555555555)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(0x5555555555555555))
    return odd.bitwiseXOR(even).bitwiseOR(F.shiftleft(odd.bitwiseAND(even), 1))


def _cells(prints: DataFrame, distance: int) -> DataFrame:
    """(part, cell, own, fp, label): the cells within one step of each fingerprint's own, in every part."""
    moved = prints.select("fp", "label", embedded(F.col("fp")).alias("p"), F.explode(_steps(distance)).alias("m"))
    moved = moved.filter((F.col("p").bitwiseAND(F.col("m.look")) == 0) == F.col("m.clear"))
    own = F.col("p").bitwiseAND(F.col("m.mask"))
    return moved.select(F.col("m.part").alias("part"), own.bitwiseXOR(F.col("m.flip")).alias("cell"), own.alias("own"), "fp", "label")


def _pairs(cells: DataFrame, keys: list[str], distance: int, more=None) -> DataFrame:
    """The labels of cells that meet in all keys and are near; merged, because Spark sizes the exploded cells too low to broadcast."""
    a, b = cells.alias("a"), cells.alias("b")
    near = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= distance
    # places that are equal meet in all their cells; only the own one counts
    once = (F.col("a.own") != F.col("b.own")) | (F.col("a.cell") == F.col("a.own"))
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
    on = (F.col("a.fp") < F.col("b.fp")) & (F.col("a.label") != F.col("b.label")) & near & once
    for term in same:
        on = on & term
    joined = a.join(b.hint("merge"), on if more is None else on & more)
    return joined.select(F.least("a.label", "b.label").alias("a"), F.greatest("a.label", "b.label").alias("b")).distinct()


def links(prints: DataFrame, distance: int, scratch: Scratch, most: int = 5000, small: int = 1_000_000) -> DataFrame:
    """(a, b): all pairs a < b of labels of distinct fingerprints (fp, label) that differ in 1 to distance bits.

    Without a column label each fingerprint is its own label, and these are all links.
    ``most`` is the number of fingerprints of one cell that a task compares with each other. A cell has at most as
    many as the places within a step of it, 33 at most in a part, so only cells beside a place with over most / 33
    can have more; these are dealt to blocks.
    """
    if not 0 <= distance <= 8:
        raise ValueError(f"distance {distance} is not in 0 to 8")
    cells = _cells(prints if "label" in prints.columns else prints.withColumn("label", F.col("fp")), distance)
    full = cells.filter(F.col("cell") == F.col("own")).groupBy("part", "own").agg(F.count(F.lit(1)).alias("n"))
    full = scratch.store(full.filter(F.col("n") > max(1, most // 33)), "full")
    if full.limit(1).count() == 0:
        return _pairs(cells, ["part", "cell"], distance)
    # a place of a part is embedded already: move it as _cells does, and bound what its cells hold
    moved = full.select("part", "own", "n", F.explode(_steps(distance)).alias("m")).filter(F.col("m.part") == F.col("part"))
    moved = moved.filter((F.col("own").bitwiseAND(F.col("m.look")) == 0) == F.col("m.clear"))
    hot = (
        moved.groupBy("part", F.col("own").bitwiseXOR(F.col("m.flip")).alias("cell"))
        .agg(F.sum("n").alias("n"))
        .select("part", "cell", F.ceil((F.col("n") + most) / most).cast("int").alias("blocks"))
    )
    hot = broadcast_if_small(scratch.store(hot, "hot"), small)
    dealt = cells.join(hot, ["part", "cell"], "left")
    dealt = dealt.select("part", "cell", "own", "fp", "label", F.coalesce("blocks", F.lit(1)).alias("blocks"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "part", "cell", "own", "fp", "label", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )
    # rows of one block meet in the key of that block with itself alone
    apart = (F.col("a.block") != F.col("b.block")) | (F.col("a.i") == F.col("a.j"))
    return _pairs(dealt, ["part", "cell", "i", "j"], distance, apart)


def simhash_classes(
    docs: DataFrame,
    words: int = 4,
    distance: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    most: int = 5000,
) -> DataFrame:
    """(id, fingerprint, component_id) of every row, rows linked at ``distance`` or fewer differing bits.

    ``fingerprint`` is 16 lowercase hex digits, ``component_id`` the smallest id of all rows that links join to the
    row, itself included (a null id is never the smallest; a component of null ids has a null one). Rows without
    words, null texts among them, have fingerprint zero and are linked like any other. Rows that share an id are
    judged each by its own text. Other columns of docs are not read. An empty table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    prints = scratch.store(fingerprints(docs, words, id_col, text_col), "prints")
    firsts = scratch.store(prints.groupBy("fp").agg(F.min("id").alias("first")), "firsts")
    stars = scratch.store(star_links(firsts.select("fp"), distance), "stars")
    joined = components(stars, scratch, "groups").select(F.col("v").alias("fp"), "label")
    joined = firsts.join(joined, "fp", "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    joined = scratch.store(joined, "joined")
    pairs = scratch.store(links(joined.select("fp", "label"), distance, scratch, most), "links")
    merged = components(pairs, scratch, "components").select(F.col("v").alias("label"), F.col("label").alias("whole"))
    grouped = joined.join(merged, "label", "left").select("fp", "first", F.coalesce("whole", "label").alias("label"))
    least = grouped.groupBy("label").agg(F.min("first").alias("component_id"))
    whole = grouped.join(least, "label").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(whole, "fp").select(F.col("id").alias(id_col), digits.alias("fingerprint"), "component_id")
