from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from tillstone.llm.queries import QUERIES
from tillstone.llm.repair import NONE, SYMBOLS, Repair, damaged, repaired_conversations, tables

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(SPACE)
        out.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def _inserts(gaps, most):
    """All ways to put user and assistant turns into the gaps, at most so many."""
    if gaps == 0:
        yield []
        return
    for n in range(most + 1):
        for some in product("ua", repeat=n):
            for rest in _inserts(gaps - 1, most - n):
                yield [some, *rest]


ROLE = {"u": "user", "a": "assistant"}


def enumerated(rows):
    """Least cost, ASCII-least letters and lines over all edits, tried one after the other."""
    marks, best = faults(rows), None
    ways = list(_inserts(len(rows) + 1, 3))
    for ops in product("KuaD", repeat=len(rows)):  # u and a: rerole
        if any(m in ("b", "d") and op != "D" for m, op in zip(marks, ops)):
            continue
        own = sum({"K": 0, "D": 2}.get(op, 1) + 5 * (op != "D" and m == "t") for m, op in zip(marks, ops))
        if best and own > best[0]:
            continue
        for inserts in ways:
            cost = own + 5 * sum(map(len, inserts))
            if best and cost > best[0]:
                continue
            audit, lines, initials = "", [], ""
            for i in range(len(rows) + 1):
                for x in inserts[i]:
                    audit, initials = audit + "I", initials + x
                    lines.append(ROLE[x] + ":")
                if i < len(rows):
                    op, (role, text) = ops[i], rows[i]
                    audit += op if op in "KD" else "R"
                    if op != "D":
                        role = role if op == "K" else ROLE[op]
                        initials += role[:1] or "-"  # an empty role fits nowhere
                        lines.append(f"{role}:{text}")
            if re.fullmatch("(s?(ua)+)?", initials) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, lines)
    return best


def brute(turns):
    """The report on rows (conv, turn, role, text) that stand as they are."""
    convs = {}
    for conv, turn, role, text in turns:
        convs.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = set()
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        known = [t for t, _, _ in rows if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        said = [(r, t) for _, r, t in rows]
        marks = faults(said)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        cost, audit, lines = enumerated(said)
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.add((conv, gaps, marks.count("b"), marks.count("d"), marks.count("t"), illegal, cost, audit, sha))
    return out


def _table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema).repartition(3)


def _some(seed, convs, most):
    draw = random.Random(seed)
    roles = ["system", "user", "assistant", "tool", "", None]
    texts = ["Yes.", "No", "  ", "", None, "Why? ", "So !", "a\nb.\n"]
    return [
        (conv, draw.choice([None, 0, 1, 2, 3, 9]), draw.choices(roles, [2, 6, 6, 1, 1, 1])[0], draw.choices(texts, [5, 2, 1, 1, 1, 4, 4, 4])[0])
        for conv in range(convs)
        for _ in range(draw.randint(1, most))
    ]


@pytest.mark.parametrize("chunk, length", [(1024, 4), (2, 1), (3, 2)])
def test_report_equals_all_edits_tried(spark, chunk, length):
    rows = _some(chunk, 40, 4) + [(None, 1, "user", "Hi."), (None, None, "system", "Be."), (None, 1, "user", "Hi.")]
    got = Repair(_table(spark, rows), chunk=chunk, length=length).report()
    assert got.columns == COLUMNS
    assert {tuple(r) for r in got.collect()} == brute(rows)


def test_long_conversations_are_cut_into_chunks_without_a_difference(spark):
    rows = [(conv, turn, *row[2:]) for conv in (1, 2) for turn, row in enumerate(_some(5 + conv, 150, 4))]
    rows = [(c, None if t % 50 == 7 else t, r, f"{x} {t}." if x and t % 3 else x) for c, t, r, x in rows]
    whole = {tuple(r) for r in Repair(_table(spark, rows)).report().collect()}
    assert len(whole) == 2 and max(len(r[7]) for r in whole) > 200
    assert {tuple(r) for r in Repair(_table(spark, rows), chunk=7, length=3).report().collect()} == whole


def test_repaired_rows_read_as_the_pattern_asks(spark):
    rows = _some(11, 60, 6)
    kept = Repair(_table(spark, rows), chunk=4).turns().orderBy("conv", "place", "seq").collect()
    by_conv = {}
    for r in kept:
        by_conv.setdefault(r.conv, []).append(r)
    assert len(by_conv) > 20
    for turns in by_conv.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(t.role[:1] for t in turns))
        assert all(t.text == "" for t in turns if t.letter == "I")


def test_block_tables_equal_single_steps():
    one, block = tables(1), tables(3)
    assert one.vectors == block.vectors and len(one.vectors) < 100
    size = len(SYMBOLS)
    for v in range(len(one.vectors)):
        for number in range(0, size**3, 7):
            at, cost = v, 0
            for code in (number % size, number // size % size, number // size**2):  # from the last symbol on
                cost += one.one_cost[at, code]
                at = one.one[at, code]
            assert (block.many[v, number], block.many_cost[v, number]) == (at, cost)


def test_damage_follows_the_hash_of_id_and_turn(spark):
    rows = [(c, t, "assistant", f"Oh. {c}! {t}?") for c in range(30) for t in range(4)] + [(None, None, None, None)]
    want = []
    for conv, turn, role, text in rows:
        case = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" ", " ") if role is None else (role, text)
        role = "user" if case == 4 else role
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        want += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(case, 1)
    got = [tuple(r) for r in damaged(_table(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_table_extra_columns_and_ids_without_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repaired_conversations(none, none).collect() == []
    ids = _table(spark, [(1, 0, "user", "Hi."), (5, 0, "user", "Hi."), (None, 0, "user", "Hi.")])
    rows = _table(
        spark,
        [(1, 0, "user", "Hi.", 9, "c", "p", "t"), (1, 1, "assistant", "Ho.", 8, "d", "q", None)],
        SCHEMA + ", place long, conv string, chunk string, fault string",
    )
    got = {r.conv_id: tuple(r)[1:] for r in repaired_conversations(ids, rows).collect()}
    line = hashlib.sha256(b"user:Hi.\nassistant:Ho.").hexdigest()
    assert got == {1: (0, 0, 0, 0, 0, 0, "KK", line), 5: (0,) * 6 + ("", NONE), None: (0,) * 6 + ("", NONE)}


def test_very_long_text_and_one_conversation_with_most_rows(spark):
    text = "word. " * 200_000
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"{t}.") for t in range(5000)] + [(2, 0, "user", text), (2, 1, "assistant", text)]
    got = {r.conv_id: r for r in Repair(_table(spark, rows)).report().collect()}
    assert got[1].audit == "K" * 5000 and got[1].cost == got[1].gaps == got[1].illegal == 0
    assert got[2].repaired_sha256 == hashlib.sha256(f"user:{text}\nassistant:{text}".encode()).hexdigest()


def test_query_covers_every_conversation(spark):
    got = QUERIES["op11_block_tables"](spark, "/root/testdata/sf0.001")
    assert got.columns == COLUMNS
    ids = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id").distinct()
    assert got.select("conv_id").exceptAll(ids).count() == 0 and got.count() == ids.count()
