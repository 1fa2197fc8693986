from __future__ import annotations

import random
import re
import textwrap

import pytest

from tillstone.llm.licenses import FULL_STOPS, OTHER_ENDS, SENTENCES, licences


def run(spark, texts, **options):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, rule string, sid int")
    return sorted(tuple(r) for r in licences(df, **options).collect())


def test_reference_sentences(spark):
    got = run(spark, ["Prose. Released under the MIT License. More.", "X\nLicensed under CC BY-NC 4.0.\n", "the MIT License", None, ""])
    assert got == [(0, "MIT", "reference", 1, 1), (1, "CC-BY-NC-4.0", "reference", 1, 1)]


def test_longest_rule_wins_and_gaps_are_skipped(spark):
    full = [SENTENCES[i] for i in (3, 4, 5, 6)]
    text = ".\n".join([full[0].capitalize(), "some line", *full[1:]]) + "."
    swapped = ". ".join([full[1], full[0], full[2]])
    got = run(spark, [text, swapped])
    assert got == [(0, "MIT", "full text", 0, 4), (1, "MIT", "grant", 1, 1)]


def test_each_occurrence_counts_in_long_texts(spark):
    got = run(spark, ["Released under the MIT License! " * 500, "word " * 100_000])
    assert len(got) == 500 and got[7] == (0, "MIT", "reference", 7, 7)


def test_own_rules_overlaps_ties_and_odd_rows(spark):
    rules = [("L", "ab", [1, 2]), ("L", "ba", [2, 1]), ("M", "ab", [1, 2])]
    df = spark.createDataFrame([(None, "a. b. a."), (1, "A!"), (2, "a b")], "doc_id long, text string")
    got = sorted(map(tuple, licences(df, ["a", "b"], rules).collect()), key=str)
    assert got == [(None, "L", "ab", 0, 1), (None, "L", "ba", 1, 2), (None, "M", "ab", 0, 1)]
    assert licences(df.filter("false")).count() == 0


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated \
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the \
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit \
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE \
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR \
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR \
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in \
compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the \
specific language governing permissions and limitations under the License."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that \
the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following \
disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote \
products derived from this software without specific prior written permission."""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General \
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any \
later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied \
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public License for more details."""
FILES = {
    ("MIT", "full text"): MIT, ("Apache-2.0", "file notice"): APACHE,
    ("BSD-3-Clause", "full text"): BSD, ("GPL-3.0", "file notice"): GPL,
}


@pytest.mark.parametrize("sign", ["", "# ", "// ", " * ", "; ", "-- "])
def test_wrapped_and_commented_files(spark, sign):
    texts = [
        "\n".join(sign + line for p in text.split("\n\n") for line in [*textwrap.wrap(p, width), ""])
        for text in FILES.values() for width in (48, 72, 79)
    ]
    got = run(spark, texts + [texts[0].replace("\n", "\r\n")])
    names = [name for name in FILES for _ in range(3)] + [("MIT", "full text")]
    assert [r[:3] for r in got] == [(i, *name) for i, name in enumerate(names)]


def test_places_and_bounds_of_wrapped_sentences(spark):
    got = run(spark, [
        "x\n# Released under\n#\n# the MIT\n# License\ny", "Released under. The MIT License", "Released under\nthe MIT License too",
        "This project is\nlicensed under the MIT license", "released under\nthe\nreleased under\nthe MIT license", "released under the the mit\nlicense",
    ])
    assert got == [(0, "MIT", "reference", 1, 4), (3, "MIT", "reference", 0, 1), (4, "MIT", "reference", 2, 3)]


def brute(texts, sentences, rules):
    """Every run of pieces against every sentence, every run of identifiers against every rule."""
    out = []
    for doc, text in enumerate(texts):
        seen, at = [], 0
        for stretch in re.split(FULL_STOPS.replace(r"\z", r"\Z"), text or ""):
            pieces = [re.sub("[^A-Za-z0-9]+", " ", p).strip().lower() for p in re.split(OTHER_ENDS.replace(r"\z", r"\Z"), stretch)]
            full = [i for i, p in enumerate(pieces) if p]
            for x, i in enumerate(full):
                for j in full[x:]:
                    whole = " ".join(p for p in pieces[i : j + 1] if p)
                    seen += [(at + i, sid, at + j) for sid, s in sentences if s == whole]
            at += len(pieces)
        seen = sorted(s for s in seen if not any(o[0] <= s[0] and o[2] >= s[2] and o[2] - o[0] > s[2] - s[0] for o in seen))
        sids = [s[1] for s in seen]
        found = [
            (a, a + len(r[2]) - 1, r) for r in rules for a in range(len(sids)) if r[2] and sids[a : a + len(r[2])] == r[2]
        ]
        out += [
            (doc, r[0], r[1], seen[a][0], seen[b][2]) for a, b, r in found
            if not any(c <= a and d >= b and d - c > b - a for c, d, _ in found)
        ]
    return sorted(out)


def test_tables_of_many_sentences_and_rules_against_brute_force(spark):
    rng = random.Random(4)
    phrase = lambda n: " ".join(rng.choice("abcd") for _ in range(n))
    sentences = sorted({phrase(rng.randint(1, 6)) for _ in range(1500)})
    sentences = [(7 * i + 3, s) for i, s in enumerate(sentences)]
    sids = [sid for sid, _ in sentences[:40]]
    rules = [(f"L{i % 90}", f"r{i}", [rng.choice(sids) for _ in range(rng.randint(0, 3))]) for i in range(3000)]
    some = [s for _, s in sentences[:40]]
    cut = lambda s: "".join(rng.choice([" ", " ", "\n", "\n# ", "\n\n"]) if c == " " else c for c in s)
    texts = [
        "".join(cut(rng.choice(some)).upper() + rng.choice([". ", "\n", "; ", ";\n", "! ", ";. ", " zz\n"]) for _ in range(rng.randint(0, 12)))
        for _ in range(60)
    ]
    known = spark.createDataFrame(sentences, "sid int, sentence string")
    ordered = spark.createDataFrame(rules, "licence string, rule string, sids array<int>")
    expected = brute(texts, sentences, rules)
    assert len(expected) > 300 and run(spark, texts, sentences=known, rules=ordered) == expected
    assert run(spark, texts, sentences=known, rules=ordered, small=0) == expected


def test_sentences_longer_than_a_block_and_begun_often(spark):
    long = " ".join(f"w{i}" for i in range(700))
    text = "\n".join(textwrap.wrap(long, 60))
    got = run(spark, ["w0 w1\n" + text + "\n" + text + "\nw0 w1", text[:-1]], sentences=[long, "w0 w1"], rules=[("L", "l", [1]), ("S", "s", [2])])
    lines = text.count("\n") + 1
    assert got == [
        (0, "L", "l", 1, lines), (0, "L", "l", 1 + lines, 2 * lines), (0, "S", "s", 0, 0), (0, "S", "s", 1 + 2 * lines, 1 + 2 * lines),
    ]


def test_further_licences(spark):
    disclaimer = (
        "\n\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
        "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
        "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    )
    mozilla = (
        "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not "
        "distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/."
    )
    affero = GPL.replace("General", "Affero General")
    wrapped = ["\n".join(line for p in (BSD + disclaimer).split("\n\n") for line in [*textwrap.wrap(p, 70), ""])]
    got = run(spark, wrapped + [mozilla, affero, "# SPDX-License-Identifier: ISC"])
    assert [r[:3] for r in got] == [
        (0, "BSD-3-Clause", "full text"), (1, "MPL-2.0", "file notice"), (2, "AGPL-3.0", "file notice"), (3, "ISC", "identifier"),
    ]
