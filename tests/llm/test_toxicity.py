from __future__ import annotations

import random
import subprocess
import sys
import tracemalloc
import zlib
from pathlib import Path

import numpy as np

from tillstone.llm import toxicity
from tillstone.llm.learning import brought_within
from tillstone.llm.toxicity import Evidence, Network, Options, scored, toxicity_model, train, without_toxic

CLEAN = "the stone river walks under bright morning clouds and green hills carry quiet songs über été".split()
BAD = ["idiot", "worthless", "scum"]


def sample(n, seed):
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        words = [rng.choice(CLEAN) + rng.choice(["", "s", "ing"]) for _ in range(rng.randint(1, 200))]
        if i % 3 == 0:
            for _ in range(3):
                words.insert(rng.randint(0, len(words)), rng.choice(BAD) + rng.choice(["", "!", "ic"]))
        texts.append(" ".join(words))
        labels.append(int(i % 3 == 0))
    return texts, labels


def test_gradients_equal_finite_differences():
    texts, labels = sample(6, 1)
    net = train(texts, labels, Options(rounds=0))
    distinct, codes, sizes = net.encode(texts)
    fixed = net.fixed(distinct)
    windows, owner = net.windows(codes, sizes)
    y = np.array(labels, np.float32)[owner]
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}

    def loss():
        z = net.run(net.inputs(distinct, fixed)[0], windows).astype(np.float64)
        return np.mean(np.log1p(np.exp(z)) - y * z)

    g = net.gradients(distinct, fixed, windows, y)
    for name, value in net.w.items():
        at = np.unravel_index(np.argmax(np.abs(g[name])), value.shape)
        kept, ends = value[at], []
        for step in (1e-2, -1e-2):
            value[at] = kept + step
            ends.append(loss())
        value[at] = kept
        assert np.isclose((ends[0] - ends[1]) / 2e-2, g[name][at], rtol=0.05, atol=1e-5), name


def test_windows_overlap_and_cover():
    net = Network([], np.zeros(0), np.zeros(1), Options(window=8, stride=4))
    sizes = np.array([0, 1, 8, 9, 31])
    windows, owner = net.windows(np.arange(sizes.sum()), sizes)
    for i, n in enumerate(sizes):
        held = windows[owner == i]
        first = sizes[:i].sum()
        assert set(held[held >= 0]) == set(range(first, first + n))
        assert all(b[0] - a[0] == 4 for a, b in zip(held, held[1:]))


def test_finds_held_out_rows_wherever_the_word_stands():
    texts, labels = sample(300, 2)
    model = train(texts, labels)
    more, truth = sample(150, 3)
    assert np.mean((model.scores(more) >= 0.5) == np.array(truth)) > 0.95
    long = " ".join(CLEAN * 2000)
    low, high = model.scores([long, long + " you idiot " + long])
    assert low < 0.5 < high


def test_odd_rows(spark):
    texts, labels = sample(120, 4)
    rows = [(i, t, 9.0) for i, t in enumerate(texts)] + [(None, None, None), (500, "", 1.0), (500, texts[0], 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double").repartition(3)
    marks = spark.createDataFrame([(i, y) for i, y in enumerate(labels)] + [(7, None), (None, 1)], "doc_id long, toxic int")
    got = scored(docs, toxicity_model(docs, marks)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.text == texts[0]}) == 1
    kept = without_toxic(docs, marks)
    assert kept.columns == docs.columns and 60 < kept.count() < len(rows)
    assert scored(docs.filter("false"), train([], [])).count() == 0
    assert scored(docs, train(["a"], [1])).filter("score < 0.1").count() == len(rows)


def test_word_counts_come_in_an_order_that_no_process_changes():
    words = [f"w{i}" for i in range(50)]
    assert list(Evidence([" ".join(reversed(words))], [0]).words[0]) == sorted(words)


def test_training_takes_no_more_rows_and_letters_than_it_may(spark, monkeypatch):
    taken = []

    def kept(texts, labels, options):
        taken.append(sorted(zip(texts, labels)))
        return train([], [])

    monkeypatch.setattr(toxicity, "train", kept)
    rows = [(i, f"text number {i:03}") for i in range(200)] + [(5, f"another text {i} of the same id") for i in range(300)]
    rows += [(7, "text number 007"), (8, "long " * 50_000), (9, None), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    marks = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    options = (Options(), Options(sample=60), Options(letters=1000), Options(letters=0))
    for o in options:
        toxicity.toxicity_model(docs, marks, options=o)
    every = {(t or "", i % 2) for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 4 != 2}
    assert set(taken[0]) == every and len(taken[0]) == len(every)
    for got, o in zip(taken, options):
        assert len(got) <= o.sample and sum(len(t) for t, _ in got) <= o.letters and set(got) <= every
    assert 20 < len(taken[2]) and not any(t for t, _ in taken[3])


def test_repeated_words_take_little_memory():
    net = Network([], np.zeros(0), np.zeros(1), Options())
    texts = [" ".join(CLEAN) * 250 for _ in range(100)] + ["", "One two one"]
    tracemalloc.start()
    try:
        distinct, codes, sizes = net.encode(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 24 * len(codes)
    found = [toxicity.WORD.findall(t.lower()) for t in texts]
    assert [distinct[c] for c in codes] == [w for ws in found for w in ws] and list(sizes) == list(map(len, found))
    assert distinct == list(dict.fromkeys(w for ws in found for w in ws))
    nothing = net.encode([])
    assert nothing[0] == [] and len(nothing[1]) == len(nothing[2]) == 0


def test_a_task_that_scores_needs_no_pandas():
    """Every Python worker of an executor would hold it."""
    code = "import sys; from tillstone.llm import toxicity as t; t.train(['a b', 'c'], [0, 1]).scores(['a']); sys.exit('pandas' in sys.modules)"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parents[2])


def test_the_sample_is_brought_without_python_on_the_executors(spark, monkeypatch):
    rows = spark.sql("SELECT * FROM VALUES (1, 'one', 0), (2, 'three', 1), (2, 'three', 1), (3, null, 0) AS t(id, text, label)")
    monkeypatch.setattr(spark.sparkContext, "pythonExec", "/no/python")
    assert sorted(map(tuple, brought_within(rows, 10, 100))) == [("", 0), ("one", 0), ("three", 1)]
    assert brought_within(rows.filter("id > 3"), 10, 100) == []
