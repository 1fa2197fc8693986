from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from tillstone.llm.prefix_trie import PrefixTrie, branched, digested

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def ordered(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [r[2:] for r in sorted(turns)] for c, turns in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h] + own[h:]
    return out


def brute(sequences):
    """The nodes of the trie of {conversation: turns}, from the sets of members alone."""
    members = {}
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    leaf = {n for n in members if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in members)}
    out = set()
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        saved = sum((len(members[m]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", m[-1][1])) for m in below if m)
        ends = ",".join(str(c) for c in sorted(convs) if len(sequences[c]) == len(node))
        out.add(
            (
                min(convs),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(convs),
                sum(len(m) == len(node) + 1 for m in below),
                sum(m in leaf for m in below),
                saved,
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return out


def _table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema).repartition(3)


def _some(seed, convs):
    draw = random.Random(seed)
    rows = []
    for conv in range(-25, convs):
        for turn in range(draw.choice([1, 1, 2, 3, 5])):
            role = draw.choice(["user", "assistant", None])
            rows.append((conv, draw.choice([turn, turn, turn, None]), role, draw.choice(["a b", "a  c\n", "", None, "d"])))
    return rows


@pytest.mark.parametrize("block", [4096, 2])
def test_nodes_equal_the_sets_of_members(spark, block):
    rows = _some(block, 120) + [(None, 0, "user", "no conversation"), (7, 3, "user", "a b"), (7, 3, "user", "a b")]
    trie = PrefixTrie(branched(digested(_table(spark, rows), block=block)), block=block)
    got = trie.nodes()
    assert got.columns == COLUMNS
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) > 100
    assert set(rows) == brute(rebuilt(ordered([r for r in _some(block, 120)] + [(7, 3, "user", "a b"), (7, 3, "user", "a b")])))


def test_any_conversations_without_rebuilding(spark):
    rows = [(1, 0, "user", "x y"), (2, 0, "user", "x y"), (3, 0, "user", "x y"), (3, 1, "assistant", "z"), (4, 0, "assistant", "x y")]
    got = {tuple(r) for r in PrefixTrie(digested(_table(spark, rows))).nodes().collect()}
    assert got == brute(ordered(rows))


def test_identical_conversations_collapse_into_one_sequence(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(3)] + [(900, 0, "user", "turn 0")]
    trie = PrefixTrie(digested(_table(spark, rows)))
    assert {(r.first, r.weight) for r in trie.sequences.collect()} == {(0, 300), (900, 1)}
    assert {tuple(r) for r in trie.nodes().collect()} == brute(ordered(rows))


def test_one_conversation_longer_than_many_blocks(spark):
    rows = [(1, t, "user", f"w{t % 7} x") for t in range(90)] + [(2, t, "user", f"w{t % 7} x") for t in range(61)]
    rows += [(3, t, "user", "a third") for t in range(40)]
    got = {tuple(r) for r in PrefixTrie(digested(_table(spark, rows), block=8), block=8).nodes().collect()}
    assert got == brute(ordered(rows))


def test_empty_turnless_and_clashing_columns(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert PrefixTrie(branched(digested(none))).nodes().collect() == []
    # crc32("22") % 4 and the missing conversation 20 leave 22 without turns
    lone = [(c, 0, "user", "hi") for c in (22, 45, 66, 87, 103)]
    assert any(not turns for turns in rebuilt(ordered(lone)).values())
    wide = [(*row, 1, "s", "d", 2) for row in lone]
    table = _table(spark, wide, SCHEMA + ", place long, said string, depth string, first long")
    assert {tuple(r) for r in PrefixTrie(branched(digested(table))).nodes().collect()} == brute(rebuilt(ordered(lone)))


def test_very_long_texts(spark):
    text = "many words " * 300_000
    rows = [(40, 0, "user", text), (41, 0, "user", text), (42, 0, "user", text + "x")]
    got = {tuple(r) for r in PrefixTrie(digested(_table(spark, rows))).nodes().collect()}
    assert got == brute(ordered(rows))
