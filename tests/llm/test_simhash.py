from __future__ import annotations

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tillstone.llm.common import Scratch
from tillstone.llm.queries import QUERIES
from tillstone.llm.simhash import embedded, fingerprint, links, simhash_classes, star_links

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text, words=4):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, distance=4):
    """Fingerprints of (id, text) rows, and the smallest id that links of distinct fingerprints reach."""
    prints = [plain(t) for _, t in rows]
    names = sorted(set(prints))
    root = {p: p for p in names}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(names):
        for b in names[:i]:
            if (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    least = {}
    for (doc, _), p in zip(rows, prints):
        if doc is not None:
            least[find(p)] = min(least.get(find(p), doc), doc)
    return [(doc, f"{p:016x}", least.get(find(p))) for (doc, _), p in zip(rows, prints)]


def test_query_equals_brute_force(spark):
    got = QUERIES["op13_segment_popcounts"](spark, SF)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, got.collect())) == sorted(brute(docs))


def test_nulls_repeats_shared_ids_and_clashing_columns(spark):
    words = [f"w{i}" for i in range(300)]
    base = " ".join(words)
    rows = [(9, None), (3, ""), (8, " \t\n"), (5, base), (4, base.upper() + " end"), (5, base), (6, "a b"), (6, "A\x0bB"), (7, "a b c d e")]
    rows += [(None, "alone among nulls"), (None, base), (2, "cafÉ  x")]
    docs = spark.createDataFrame([(*r, 1, 2, "z") for r in rows], "doc_id long, text string, fp long, id long, fingerprint string")
    got = simhash_classes(docs.repartition(3)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows), key=str)
    assert simhash_classes(docs.limit(0)).collect() == []


def test_long_texts_are_hashed_in_blocks():
    draw = random.Random(1)
    text = "".join(draw.choice(["Ab", "c", "éÉ", " ", "  ", "\n"]) for _ in range(3000))
    for size in (1, 3, 7, 50, 100_000):
        assert fingerprint(text.encode(), 4, size) % (1 << 64) == plain(text)
    assert fingerprint(b"x" * 5000, 4, 10) % (1 << 64) == plain("x" * 5000)
    assert fingerprint(b"one two", 4, 2) % (1 << 64) == plain("one two")


def _prints(seed, n):
    """Random fingerprints with neighbours at 1 to 9 bits, and the sign bit among those that differ."""
    draw = random.Random(seed)
    out = set()
    while len(out) < n:
        p = draw.getrandbits(64)
        out.add(p)
        for _ in range(draw.choice([0, 1, 5])):
            q = p
            for b in draw.sample(range(64), draw.randint(1, 9)):
                q ^= 1 << b
            out.add(q)
    return sorted(out)


def _signed(p):
    return p - (1 << 64) if p >> 63 else p


@pytest.mark.parametrize("distance, most", [(0, 5000), (1, 5000), (3, 5000), (4, 5000), (4, 3), (8, 5000)])
def test_links_are_all_pairs_within_the_distance(spark, distance, most):
    values = _prints(distance, 400)
    table = spark.createDataFrame([(_signed(p),) for p in values], "fp long").repartition(3)
    got = links(table, distance, Scratch(spark, "test"), most)
    want = {
        tuple(sorted((_signed(a), _signed(b))))
        for i, a in enumerate(values)
        for b in values[:i]
        if (a ^ b).bit_count() <= distance
    }
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want
    assert distance == 0 or len(want) > 30


def test_crowded_cells_are_dealt_to_blocks(spark):
    draw = random.Random(3)
    centre, values = draw.getrandbits(64), set()
    while len(values) < 400:  # all within a few bits of the upper half, so that the lower half's cell is shared
        values.add(centre ^ sum(1 << b for b in draw.sample(range(32, 64), draw.randint(0, 6))))
    table = spark.createDataFrame([(_signed(p),) for p in sorted(values)], "fp long").repartition(3)
    want = {tuple(sorted((_signed(a), _signed(b)))) for a in values for b in values if a < b and (a ^ b).bit_count() <= 4}
    got = links(table, 4, Scratch(spark, "test"), most=40)
    assert {tuple(r) for r in got.collect()} == want


def test_no_exploded_table_is_broadcast(spark):
    """A stored table's size is known, and so small that Spark would broadcast what is exploded from it."""
    scratch = Scratch(spark, "test")
    prints = scratch.store(spark.createDataFrame([(_signed(p),) for p in _prints(5, 300)], "fp long"), "prints")
    for found in (star_links(prints, 4), links(prints, 4, scratch), links(prints, 4, scratch, most=3)):
        assert found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and not re.search(r"(Broadcast|Shuffled)HashJoin .*, Inner", plan)


def test_embedding_bounds_the_differing_bits(spark):
    values = _prints(7, 60)
    table = spark.createDataFrame([(_signed(p),) for p in values], "fp long").select("fp", embedded(F.col("fp")).alias("e"))
    lanes = {r.fp % (1 << 64): [(r.e % (1 << 64)) >> 2 * i & 3 for i in range(32)] for r in table.collect()}
    for p, lane in lanes.items():
        assert lane == [(p >> 2 * i & 3).bit_count() for i in range(32)]
        for q, other in lanes.items():
            assert sum(abs(x - y) for x, y in zip(lane, other)) <= (p ^ q).bit_count()


def test_a_distance_beyond_the_embedding_is_refused(spark):
    with pytest.raises(ValueError, match="distance 9"):
        links(spark.createDataFrame([(1,)], "fp long"), 9, Scratch(spark, "test"))
