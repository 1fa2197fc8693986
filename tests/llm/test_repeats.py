from __future__ import annotations

import hashlib
import random

import pytest

from tillstone.llm import repeats
from tillstone.llm.repeats import repeated_bytes


def brute(rows, width):
    """removed ranges and kept hash of each row; rows equal in id and text are one"""
    order = sorted({(doc, text or "") for doc, text in rows}, key=lambda r: (r[0] is None, r[0] or 0, tid(r[1])))
    seen, out = set(), {}
    for doc, text in order:
        data, gone = text.encode(), set()
        for p in range(len(data) - width + 1):
            window = data[p : p + width]
            if window in seen:
                gone.update(range(p, p + width))
            seen.add(window)
        runs = [p for p in sorted(gone) if p - 1 not in gone]
        kept = bytes(b for i, b in enumerate(data) if i not in gone)
        out[doc, text] = (len(runs), len(gone), hashlib.sha256(kept).hexdigest())
    return sorted(((doc, *out[doc, text or ""]) for doc, text in rows), key=str)


HASH = {}


def tid(text):
    return HASH.get(text, 0)


def check(spark, rows, width=40, parts=4, **options):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, gram int")
    HASH.update({r.text: r.h for r in df.select(F.coalesce("text", F.lit("")).alias("text")).select("text", F.xxhash64("text").alias("h")).distinct().collect()})
    got = repeated_bytes(df.repartition(parts), width, **options).collect()
    got = sorted(((r.doc_id, len(r.removed), sum(x.end - x.start for x in r.removed), r.kept_sha256) for r in got), key=str)
    assert got == brute(rows, width)


def corpus():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(rng.randint(6, 60)) for _ in range(5)]
    rows = []
    for i in range(70):
        parts = []
        for _ in range(rng.randint(0, 4)):
            text = rng.choice(shared)
            a = rng.randint(0, len(text) // 2)
            parts += [prose(rng.randint(0, 15)), text[a : a + rng.randint(1, len(text))]]
        rows.append((i * 3 % 71, prose(3).join(parts)))
    rows += [(200 + i, shared[0]) for i in range(30)] + [(300, "x" * 900), (301, "ab" * 400), (302, "x" * 39), (303, "x" * 40)]
    rows += [(None, shared[1]), (None, None), (304, None), (305, ""), (5, shared[2]), (5, shared[2]), (5, shared[2] + "!")]
    rng.shuffle(rows)
    return rows


def test_equals_brute_force(spark):
    check(spark, corpus())
    check(spark, corpus(), width=100, parts=9)


def test_windows_of_hot_grams_are_shuffled(spark):
    check(spark, corpus(), group=1)
    check(spark, corpus(), group=4)


def test_grams_that_span_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        check(spark, corpus())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_without_broadcasts(spark):
    check(spark, corpus(), small=0)


def test_blocks_overlap_by_a_window(monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", 64)
    rng = random.Random(1)
    texts = [bytes(rng.choice(b"ab") for _ in range(n)) for n in (10, 40, 64, 103, 104, 500)]
    finder = repeats._Runs(40)
    starts = [set() for _ in texts]
    for rows in repeats._blocks(texts, 40):
        for text, begin, count, *_ in zip(*finder.block(rows)):
            new = set(range(begin, begin + count))
            assert not new & starts[text]
            starts[text] |= new
    assert starts == [set(range(max(0, len(t) - 39))) for t in texts]


@pytest.mark.parametrize("text", [None, "", "short"])
def test_little_or_nothing(spark, text):
    check(spark, [(1, text)])
    df = spark.createDataFrame([], "doc_id long, text string")
    assert repeated_bytes(df).count() == 0
