from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_decontaminate import brute as leaked
from tests.llm.test_near_dedup import brute as linked
from tillstone.llm.common import SMALL_BATCHES
from tillstone.sources.paths import child_names

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns
        docs = spark.createDataFrame(after.collect(), after.schema)
        kept[name] = (before, {r.doc_id for r in docs.collect()})
    before, after = kept["exact_dedup"]
    best = {}
    for doc, text in before:
        norm = "".join(c for c in text if c not in " \t\n\x0b\x0c\r")
        best[norm] = min(best.get(norm, (1, 0)), (-len(text), doc))
    assert after == {doc for _, doc in best.values()}
    before, after = kept["near_dedup"]
    assert after == {doc for doc, _, least in linked(before) if doc == least}
    before, after = kept["decontamination"]
    assert after == {r[0] for r in leaked(before, items) if not r[-1]}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == after
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0


def test_run_equals_the_stages_in_order(spark):
    first = corpus_pipeline.run(spark, SF)
    assert first.select("doc_id", "piece", "length").exceptAll(corpus_pipeline.run(spark, SF).select("doc_id", "piece", "length")).count() == 0


def test_a_clean_text_stays_where_its_id_also_stands_on_a_near_copy(spark):
    copied = " ".join(f"w{i}" for i in range(60))
    rows = [(1, copied, "x"), (3, copied + " end", "y"), (3, "quite another text", "z"), (3, None, "n"), (4, copied.upper(), "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, SF).collect()
    assert sorted(map(tuple, got), key=str) == sorted([rows[0], rows[2], rows[3]], key=str)


#: names that stages use for columns of their own, in results and on the way
TAKEN = [
    "score", "kept", "keep_id", "group_size", "text_sha256", "_key", "_rep", "_n", "_points", "_size", "_hash", "_win",
    "_id", "_h", "_k", "id", "h", "k", "component", "cls", "n_shingles", "component_id", "_c0", "_c5",
]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Tables with null and empty texts, repeated rows, shared ids and clashing columns."""
    folder = tmp_path_factory.mktemp("tables")
    calm = [f"A calm line number {i} about rivers, hills and the slow morning walk of cloud {i * i}." for i in range(30)]
    rows = [(i, t) for i, t in enumerate(calm)] + [(100, None), (101, ""), (102, " \n"), (3, calm[3]), (3, calm[3]), (7, calm[20] + " x")]
    rows += [(None, None), (None, "a text without an id that is unlike the others"), (103, "word " * 50_000)]
    extra = ", ".join(f"`{c}` string" for c in TAKEN) + ", n_chars long"
    docs = spark.createDataFrame([(*r, *[f"{i} {c}" for c in TAKEN], i) for i, r in enumerate(rows)], f"doc_id long, text string, {extra}")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, i % 7 == 0) for i in range(30)], "doc_id long, t boolean").selectExpr(
        "doc_id", "0 as quality", "cast(t as int) as toxic"
    ).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "nothing of the kind stands in any of these documents at all, not one word after another")], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    return str(folder), spark.read.parquet(f"{folder}/documents.parquet")


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_columns_of_the_input_come_out_of_a_stage_as_they_went_in(spark, odd, name):
    folder, docs = odd
    after = dict(corpus_pipeline.STAGES)[name](spark, docs, folder)
    assert after.columns == docs.columns
    before = {r.n_chars: r for r in docs.collect()}
    rows = after.collect()
    assert len(rows) > 20 and len({r.n_chars for r in rows}) == len(rows)
    assert all(r == before[r.n_chars] for r in rows)
    assert dict(corpus_pipeline.STAGES)[name](spark, docs.limit(0), folder).collect() == []


def test_run_on_odd_tables(spark, odd):
    folder, docs = odd
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in rows} >= {0, 1, 2, 29, 103}
    assert sum(r.doc_id == 103 for r in rows) > 40


def test_run_on_an_empty_table(spark, odd, tmp_path):
    folder, docs = odd
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_a_stage_hands_whole_texts_on_in_small_batches(spark, odd, conf, name):
    folder, docs = odd
    conf(**{k.replace(".", "__"): "1" for k in SMALL_BATCHES})  # to be set back afterwards
    for k in SMALL_BATCHES:
        spark.conf.unset(k)
    dict(corpus_pipeline.STAGES)[name](spark, docs.limit(0), folder)

    def held(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    texts = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 4000).alias("text"))
    assert texts.mapInArrow(held, "n long").agg(F.max("n")).first()[0] < 3_000_000
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 512


def test_a_stage_leaves_batches_alone_that_the_session_sets(spark, odd, conf):
    folder, docs = odd
    conf(**{k.replace(".", "__"): "7" for k in SMALL_BATCHES})
    dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs.limit(0), folder)
    assert {spark.conf.get(k) for k in SMALL_BATCHES} == {"7"}


def test_run_leaves_its_result_alone_behind_and_the_session_as_it_was(spark, odd):
    folder, _ = odd
    shared, option = spark.conf.get("spark.checkpoint.dir"), "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, rows = set(child_names(spark, shared)), spark.conf.get(option)
    assert corpus_pipeline.run(spark, folder).count() > 20
    left = set(child_names(spark, shared)) - before
    assert len(left) == 1 and left.pop().startswith("pipeline-packing")
    assert spark.conf.get(option) == rows
