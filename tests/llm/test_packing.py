from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillstone.llm.packing import best_fit, pack, token_pieces
from tillstone.llm.queries import QUERIES


def expected_tokens(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=80))
def test_best_fit_fills_bins_once_each(sizes):
    order, bounds = best_fit(np.array(sizes, np.int64), 30)
    assert sorted(order.tolist()) == list(range(len(sizes)))
    fills = [sum(sizes[i] for i in order[a:b]) for a, b in zip(bounds, bounds[1:])]
    assert all(0 < f <= 30 for f in fills)
    assert len([f for f in fills if f <= 15]) <= 1


def test_pieces_round_trip(spark):
    texts = ["Hello world", "", None, "a <|endoftext|> b", "wörter\n\n  und 12345!" * 400, "x" * 50_000, "don't 'S\t\r\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit(1))
    rows = token_pieces(df, capacity=64).collect()
    for doc, ids in enumerate(expected_tokens(texts)):
        own = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.piece)
        assert b"".join(bytes(r.ids) for r in own) == np.array(ids, "<u4").tobytes()
        assert [r.start for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist()
        assert all(r.length == 64 for r in own[1:]) and own[0].length <= 64


def check(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packs_gapless_and_tight(spark):
    rng = np.random.default_rng(1)
    sizes = [int(x) for x in rng.integers(1, 101, 5000)] + [100] * 7
    df = spark.createDataFrame(list(enumerate(sizes)), "doc_id long, length long").repartition(16)
    out = pack(df, capacity=100, chunk=200).collect()
    assert sorted((r.doc_id, r.length) for r in out) == list(enumerate(sizes))
    assert check(out, 100) <= 1.02 * sum(sizes) / 100 + 1


def test_large_items_that_cannot_share(spark):
    df = spark.createDataFrame([(i, 60) for i in range(500)], "doc_id long, length long").repartition(8)
    assert check(pack(df, capacity=100, chunk=50).collect(), 100) == 500


def test_odd_rows_and_empty(spark):
    df = spark.createDataFrame([(1, 0, 5), (2, 11, 5), (3, None, 5), (None, 4, 5), (None, 4, 5)], "doc_id long, length long, offset int")
    out = pack(df, capacity=10).collect()
    assert len(out) == 5 and sum(r.sequence_id is None for r in out) == 3
    assert pack(df.filter("false"), capacity=10).count() == 0


def test_long_runs_of_white_space_have_the_tokenizers_ids(spark):
    n = 1_100_000
    texts = ["a" + " " * n + "b", "\n" * n, "x " + "\t \n" * (n // 3) + " y", " " * 2_000_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = token_pieces(df).collect()
    for doc, ids in enumerate(expected_tokens(texts)):
        own = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.piece)
        assert b"".join(bytes(r.ids) for r in own) == np.array(ids, "<u4").tobytes()


def test_query_columns_follow_from_the_ids(spark):
    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op10_residual_packing"](spark, path).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for doc, ids in zip(docs, expected_tokens([d.text for d in docs])):
        data = np.array(ids, "<u4").tobytes()
        own = sorted(by.pop(doc.doc_id), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and own[-1].start + own[-1].length == len(ids)
        assert all(r.ids_crc32 == zlib.crc32(data[4 * r.start : 4 * (r.start + r.length)]) for r in own)
        assert len(own) == -(-len(ids) // 1024)
    assert not by
    assert check(rows, 1024) <= 1.02 * sum(r.length for r in rows) / 1024 + 1
