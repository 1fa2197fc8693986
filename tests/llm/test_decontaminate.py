from __future__ import annotations

import random
import re
from collections import Counter

from tillstone.llm.decontaminate import PositionalIndex, contamination, without_contaminated

DOCS = "doc_id long, text string, k int, items string"


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 12)):
            if w:
                windows.setdefault(tuple(w[i : i + 13]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for win, ids in windows.items():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    found |= ids
        out.append((doc, len(w), len(hit), sorted(map(str, found)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(3)
    prose = lambda n: [rng.choice("the of and to in that is was for it Être À 7 ok".split()) if rng.random() < 0.5 else f"w{rng.randint(0, 80)}" for _ in range(n)]
    items = [(i, " ".join(prose(rng.randint(1, 40)))) for i in range(20)]
    items += [(30, None), (31, ""), (32, "..."), (33, items[0][1]), (None, "null item of many words " * 3), (0, items[1][1])]
    docs = []
    for i in range(80):
        w = prose(rng.randint(0, 150))
        for _ in range(rng.randint(0, 2)):
            part = (rng.choice(items[:20])[1]).split()
            a = rng.randint(0, 5)
            at = rng.randint(0, len(w))
            w = w[:at] + part[a:] + w[at:]
        docs.append((i, ", ".join(w)))
    passage = items[2][1].upper()
    docs += [(200 + i, f"{i} {passage} tail") for i in range(40)]  # a passage in a third of all documents
    docs += [(None, passage), (None, None), (300, ""), (301, None), (302, passage), (302, passage), (302, "other " + passage)]
    docs += [(303, " ".join([passage] * 300))]
    return docs, items


def test_equals_brute_force(spark):
    docs, items = corpus()
    d = spark.createDataFrame([(a, b, 1, "x") for a, b in docs], DOCS).repartition(5)
    b = spark.createDataFrame(items, "item_id long, text string")
    keep = [x for x in items if x[0] is not None]
    for options in ({}, {"small": 0, "rare": 2}):
        got = contamination(d, b.filter("item_id is not null"), **options).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in got), key=str) == brute(docs, keep)


def test_null_items_count_as_hits_without_a_name(spark):
    d = spark.createDataFrame([(1, "some null words here")], "doc_id long, text string")
    b = spark.createDataFrame([(None, "null words")], "item_id long, text string")
    row = contamination(d, b).first()
    assert (row.n_hit, row["items"], row.contaminated) == (2, [], True)


def test_kept_rows(spark):
    docs, items = corpus()
    d = spark.createDataFrame([(a, b, 1, "x") for a, b in docs], DOCS)
    got = without_contaminated(d, spark.createDataFrame(items[:20], "item_id long, text string"))
    want = brute(docs, items[:20])
    assert got.columns == d.columns and got.count() == sum(not r[-1] for r in want)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], DOCS.split(", k")[0])
    b = spark.createDataFrame([], "item_id long, text string")
    assert contamination(d, b).first().n_hit == 0
    assert contamination(d.filter("false"), b).count() == 0


def test_proximity(spark):
    d = spark.createDataFrame([(1, "x alpha y beta z gamma"), (2, "alpha beta gamma"), (3, "alpha " + "q " * 9 + "beta gamma")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    index = PositionalIndex(d, b)
    near = lambda slack: {r.k.id for r in index.near(slack).collect()}
    assert near(0) == {2} and near(2) == {1, 2} and near(9) == {1, 2, 3}
    assert [(r.k.id, r.hits[0].start, r.hits[0].length) for r in index.phrases().collect()] == [(2, 0, 3)]


def test_near_windows_equal_brute_force(spark):
    rng = random.Random(8)
    names = [f"w{i}" for i in range(25)]
    items = [(i, " ".join(rng.choice(names) for _ in range(rng.randint(2, 16)))) for i in range(12)]
    docs = []
    for i in range(60):
        w = [rng.choice(names) for _ in range(rng.randint(0, 40))]
        part = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, 3)):  # words put in or left out
            at = rng.randint(0, len(part))
            part = part[:at] + (["new"] if rng.random() < 0.5 else []) + part[at + (rng.random() < 0.5) :]
        docs.append((i, " ".join(w[:10] + part + w[10:])))
    count = Counter(x for _, t in docs for x in words(t))
    windows = {tuple(w[i : i + 13]) for _, t in items for w in [words(t)] for i in range(max(1, len(w) - 12))}
    want = {}
    for doc, text in docs:
        w, near = words(text), 0
        for win in windows:
            probes = sorted((count[x], off, x) for off, x in enumerate(win))[:3]
            if not probes[0][0] or any(tuple(w[i : i + len(win)]) == win for i in range(len(w))):
                continue
            starts = [{p - off for p, x in enumerate(w) if x == term} for _, off, term in probes]
            near += any(all(any(s <= q <= s + 2 for q in own) for own in starts) for s in set().union(*starts))
        want[doc] = near
    got = contamination(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"), slack=2
    )
    assert {r.doc_id: r.n_near for r in got.collect()} == want
    assert sum(map(bool, want.values())) > 15 and not all(want.values())
