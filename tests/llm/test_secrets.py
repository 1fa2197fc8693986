from __future__ import annotations

import math
import random
import re
from collections import Counter

from tillstone.llm.secrets import ALPHABETS, KINDS, battery, secrets

DOCS = "doc_id long, text string, k int, spans string"


def brute_base(text):
    text = text or ""
    out = []
    for m in re.finditer(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A):
        if len(m[1]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def tail(z):
    half = 0.5 * math.exp(-0.717 * abs(z) - 0.416 * z * z)
    return half if z >= 0 else 1 - half


def p_random(value):
    raw = re.sub("=+$", "", value)
    if re.fullmatch("[0-9a-f]+|[0-9A-F]+", raw):
        raw, name = raw.lower(), "hex"
    elif re.fullmatch("[A-Z2-7]+", raw):
        name = "base32"
    elif re.fullmatch("[A-Za-z0-9]+", raw):
        name = "alnum"
    else:
        name = "base64url" if re.search("[-_]", raw) else "base64"
    k, x, n = len(ALPHABETS[name]), [ALPHABETS[name].find(c) for c in raw], len(raw)
    chi = sum(c * c for c in Counter(x).values()) * k / n - n
    z1 = (chi - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n)
    turns = sum((a >= k / 2) != (b >= k / 2) for a, b in zip(x, x[1:]))
    z2 = (turns - (n - 1) / 2) / math.sqrt((n - 1) / 4)
    mean = sum(x) / n
    spread = sum((v - mean) ** 2 for v in x)
    z3 = sum((a - mean) * (b - mean) for a, b in zip(x, x[1:])) / spread * math.sqrt(n) if spread else math.sqrt(n)
    ps = [max(p, 1e-290) for p in (tail(z1), min(1, 2 * tail(abs(z2))), min(1, 2 * tail(abs(z3))))]
    y = -sum(map(math.log, ps))
    return name, max(math.exp(-y) * (1 + y + y * y / 2), 1e-290)


def texts():
    rng = random.Random(2)
    key = lambda n, a: "".join(rng.choice(a) for _ in range(n))
    out = []
    for _ in range(120):
        parts = []
        for _ in range(rng.randint(0, 12)):
            parts.append(
                rng.choice(
                    [
                        "plain wörds 𝒳 here", "Password = " + key(rng.randint(1, 12), "abc123/+."), "api_key:'" + key(9, "xyz") + "'",
                        "APIKEY=" + key(6, "Q1"), "secret_token=abcdefg", "AKIA" + key(rng.randint(10, 24), "ABCXYZ019"),
                        key(rng.randint(20, 40), "0123456789abcdef"), key(30, ALPHABETS["base64"]), "x" * 25,
                        "Donaudampfschifffahrtsgesellschaft", "token", "passwd\"  :  \"a.b=c-d", "AKIAAKIA" + key(30, "A1"),
                    ]
                )
            )
        out.append(rng.choice([" ", "\n", ", ", ""]).join(parts))
    return out + ["", None, "password=", "0123456789abcdef" * 4000, "password=hunter2 " * 3000]


def test_base_spans_equal_brute_force(spark):
    rows = list(enumerate(texts())) + [(None, "token=abcdef"), (5, "twice secret=abcdef"), (5, "twice secret=abcdef")]
    got = secrets(spark.createDataFrame([(a, b, 1, "x") for a, b in rows], DOCS).repartition(4)).collect()
    want = [(doc, brute_base(text)) for doc, text in rows]
    base = [(r.doc_id, [tuple(s) for s in r.spans if s.kind < 3]) for r in got]
    assert sorted(base, key=str) == sorted(want, key=str)


def test_battery_equals_brute_force_and_separates(spark):
    rng = random.Random(4)
    random_keys = ["".join(rng.choice(ALPHABETS[a]) for _ in range(n)) for a in ALPHABETS for n in (20, 40, 80) for _ in range(8)]
    words = ["verantwortungsbewusstsein" * k for k in (1, 2)] + ["a" * 30, "ab" * 20, "0123456789abcdef" * 3, "some_long_identifier_name_here"]
    rows = battery(spark.createDataFrame([(v,) for v in random_keys + words], "value string")).collect()
    for r in rows:
        name, p = p_random(r.value)
        assert r.encoding == name and math.isclose(r.p_random, p, rel_tol=1e-6)
    by = {r.value: r.p_random for r in rows}
    assert sum(by[v] < 0.01 for v in random_keys) <= 0.1 * len(random_keys)
    assert all(by[v] < 1e-3 for v in words)


def test_step_up_rule_equals_brute_force(spark):
    rows = list(enumerate(texts()))
    got = secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    tests = []
    for doc, text in rows:
        for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", text or ""):
            name, p = p_random(m[0])
            tests.append((name, (len(m[0]) >= 32) + (len(m[0]) >= 64), int(-math.log10(p) * 100 // 1), doc, m.start(), m.end()))
    kept = set()
    for group in {t[:2] for t in tests}:
        own = [t for t in tests if t[:2] == group]
        passing = [b for b in {t[2] for t in own} if 10 ** (-b / 100) <= 0.01 * sum(t[2] >= b for t in own) / len(own)]
        kept |= {t[3:] for t in own if not passing or t[2] < min(passing)}
    assert {(r.doc_id, s.start, s.end) for r in got for s in r.spans if KINDS[s.kind] == "random"} == kept


def test_empty(spark):
    assert secrets(spark.createDataFrame([], DOCS)).count() == 0
    row = secrets(spark.createDataFrame([(1, None)], "doc_id long, text string")).first()
    assert row.spans == []


def test_finds_keys_in_documents_that_no_fixed_pattern_knows(spark):
    rng = random.Random(6)
    names = ["verantwortungsbewusstseinstraining", "org_example_service_configuration", "z" * 30, "xyz" * 9]
    prose = lambda n: " ".join(rng.choice(["the", "river", "of", "morning", rng.choice(names)]) for _ in range(n))
    rows, planted = [], {}
    for doc in range(120):
        text = prose(40)
        if doc % 3 == 0:
            key = "".join(rng.choice(ALPHABETS[rng.choice(["base64", "alnum"])]) for _ in range(rng.choice([32, 44, 64])))
            planted[doc] = (len(text) + 1, len(text) + 1 + len(key))
            text += " " + key + " " + prose(30)
        rows.append((doc, text))
    got = secrets(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert not any(brute_base(text) for _, text in rows)
    found = {r.doc_id: [(s.start, s.end) for s in r.spans if KINDS[s.kind] == "random"] for r in got}
    assert sum(place in found[doc] for doc, place in planted.items()) >= 0.9 * len(planted)
    extra = sum(len([p for p in spans if p != planted.get(doc)]) for doc, spans in found.items())
    words = sum(len(t) >= 20 for _, text in rows for t in text.split())
    assert extra <= 0.02 * words
