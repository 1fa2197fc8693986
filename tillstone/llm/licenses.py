"""Licence scan by sentence rules, in DataFrame operations only.

Texts are cut into pieces at sentence ends and line breaks. A known licence
sentence is found where the normal forms of one piece, or of several that
follow one another within a sentence, make it up: files are wrapped at some
column and often commented out. The identifiers of a document in order are
matched against rules, which are ordered identifier sequences.

Sentences and rules are tables of any length, joined by hash and by identifier;
the plan is the same for thirty and for thirty thousand. A sentence is a piece,
or begins with two pieces that are a run of its first words, so one hash for
each such run is all that the scan is joined with. Texts with such a beginning
are stored, and there the rest of the sentence is looked for, word by word and
exactly, among the pieces up to the next full stop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillstone.llm.common import Scratch, broadcast_if_small

# Normal forms of licence sentences (lower-case words with one space), numbered from 1.
SENTENCES = [
    "released under the mit license",
    "licensed under the mit license",
    "this project is licensed under the mit license",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "licensed under the apache license version 2 0",
    "licensed under the apache license version 2 0 the license",
    "you may not use this file except in compliance with the license",
    "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "see the license for the specific language governing permissions and limitations under the license",
    "this work is licensed under the gnu general public license version 3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "see the gnu general public license for more details",
    "licensed under cc by nc 4 0",
    "licensed under cc by 4 0",
    "this work is licensed under a creative commons attribution 4 0 international license",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "spdx license identifier mit",
    "spdx license identifier apache 2 0",
    "spdx license identifier bsd 3 clause",
    "spdx license identifier gpl 3 0 only",
    "all rights reserved",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
    "this source code form is subject to the terms of the mozilla public license v",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "see the gnu lesser general public license for more details",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "see the gnu affero general public license for more details",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "licensed under cc by sa 4 0",
    "licensed under cc0 1 0",
    "spdx license identifier bsd 2 clause",
    "spdx license identifier isc",
    "spdx license identifier mpl 2 0",
    "spdx license identifier gpl 2 0 only",
    "spdx license identifier lgpl 2 1 only",
    "spdx license identifier lgpl 3 0 only",
    "spdx license identifier agpl 3 0 only",
    "spdx license identifier cc0 1 0",
]
# Licence, rule and its sentence numbers in order.
RULES = [
    ("MIT", "reference", [1]),
    ("MIT", "reference", [2]),
    ("MIT", "reference", [3]),
    ("MIT", "full text", [4, 5, 6, 7]),
    ("MIT", "grant", [4]),
    ("Apache-2.0", "reference", [8]),
    ("Apache-2.0", "reference", [9]),
    ("Apache-2.0", "file notice", [9, 10, 11, 12, 13]),
    ("GPL-3.0", "reference", [14]),
    ("GPL-3.0", "file notice", [15, 16, 17]),
    ("GPL-3.0", "grant", [15]),
    ("CC-BY-NC-4.0", "reference", [18]),
    ("CC-BY-4.0", "reference", [19]),
    ("CC-BY-4.0", "reference", [20]),
    ("BSD-3-Clause", "full text", [21, 22, 23, 24]),
    ("BSD-2-Clause", "full text", [21, 22, 23]),
    ("MIT", "identifier", [25]),
    ("Apache-2.0", "identifier", [26]),
    ("BSD-3-Clause", "identifier", [27]),
    ("GPL-3.0", "identifier", [28]),
    ("proprietary", "reservation", [29]),
    ("BSD-3-Clause", "full text", [21, 22, 23, 24, 30, 31]),
    ("BSD-2-Clause", "full text", [21, 22, 23, 30, 31]),
    ("ISC", "full text", [32, 33, 34]),
    ("ISC", "grant", [32]),
    ("MPL-2.0", "reference", [35]),
    ("MPL-2.0", "file notice", [35, 36]),
    ("MPL-2.0", "file notice", [35, 37]),
    ("GPL-2.0", "file notice", [38, 16, 17]),
    ("GPL-2.0", "grant", [38]),
    ("LGPL-2.1", "file notice", [39, 41, 42]),
    ("LGPL-2.1", "grant", [39]),
    ("LGPL-3.0", "file notice", [40, 16, 42]),
    ("LGPL-3.0", "grant", [40]),
    ("AGPL-3.0", "file notice", [43, 16, 44]),
    ("AGPL-3.0", "grant", [43]),
    ("CC-BY-SA-4.0", "reference", [45]),
    ("CC-BY-SA-4.0", "reference", [46]),
    ("CC0-1.0", "reference", [47]),
    ("BSD-2-Clause", "identifier", [48]),
    ("ISC", "identifier", [49]),
    ("MPL-2.0", "identifier", [50]),
    ("GPL-2.0", "identifier", [51]),
    ("LGPL-2.1", "identifier", [52]),
    ("LGPL-3.0", "identifier", [53]),
    ("AGPL-3.0", "identifier", [54]),
    ("CC0-1.0", "identifier", [55]),
]
#: A piece ends at a line break, or at . ! ? ; before white space or the end. Sentences go on beyond line breaks and ;
#: which stands inside some and before commented lines; the rest of the ends is for certain.
FULL_STOPS = r"(?<![.!?;]);*+[.!?][.!?;]*+(?:\s+|\z)"
OTHER_ENDS = r"(?<!;);++(?:\s+|\z)|\n+"
#: Words of a stretch that are compared together.
BLOCK = 256


def normal(sentence: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(sentence, "[^A-Za-z0-9]+", " ")))


def known_sentences(spark: SparkSession, sentences: list[str] | DataFrame = SENTENCES) -> DataFrame:
    """(sid, w): the words of each known sentence. A table of (sid, sentence) is taken as it is, a list is numbered from 1."""
    if not isinstance(sentences, DataFrame):
        sentences = spark.createDataFrame([(i + 1, s) for i, s in enumerate(sentences)], "sid int, sentence string")
    return sentences.select("sid", F.split(normal(F.col("sentence")), " ").alias("w"))


def known_rules(spark: SparkSession, rules: list[tuple] | DataFrame = RULES) -> DataFrame:
    """(no, licence, rule, sids) of a table or list of (licence, rule, sids)."""
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([tuple(r) for r in rules], "licence string, rule string, sids array<int>")
    return rules.select(F.monotonically_increasing_id().alias("no"), "licence", "rule", "sids").filter(F.size("sids") > 0)


def beginnings(known: DataFrame) -> DataFrame:
    """(h, sid): hashes by which the first piece of a known sentence is found, see ``heads``."""
    words = lambda n: F.array_join(F.slice("w", 1, n), " ")
    runs = F.when(F.size("w") > 1, F.transform(F.sequence(F.lit(2), F.size("w")), lambda n: F.xxhash64(words(n))))
    hashes = F.concat(F.array(whole_head(words(F.size("w")))), F.coalesce(runs, F.array().cast("array<bigint>")))
    return known.select(F.explode(hashes).alias("h"), "sid")


def whole_head(part: Column) -> Column:
    return F.xxhash64(part, F.lit("."))


def heads(part: Column, following: Column) -> list[Column]:
    """A sentence is its first piece, or the first two begin it: one hash for each case, the latter null without a second."""
    return [whole_head(part), F.when(following.isNotNull(), F.xxhash64(F.concat(part, F.lit(" "), following)))]


def with_following(pieces: str) -> Column:
    """Each entry of an array column, as ``x``, with the one after it, as ``y``."""
    return F.zip_with(pieces, F.slice(pieces, F.lit(2), F.size(pieces)), lambda x, y: F.struct(x.alias("x"), y.alias("y")))


def line_forms(text: Column) -> Column:
    """The normal forms of all pieces of a text, without telling its sentences apart."""
    flat = F.regexp_replace(F.regexp_replace(text, f"{FULL_STOPS}|{OTHER_ENDS}", "\n"), "[^A-Za-z0-9\n]+", " ")
    return F.filter(F.split(F.lower(F.trim(flat)), " ?\n[ \n]*"), lambda p: p != "")


def outer(rows: DataFrame, start: str, end: str) -> DataFrame:
    """The rows whose stretch does not lie inside a longer one of the same ``rid``."""
    by = Window.partitionBy("rid").orderBy(start)
    before = F.max(end).over(by.rangeBetween(Window.unboundedPreceding, -1))
    upto = F.max(end).over(by.rangeBetween(Window.unboundedPreceding, 0))
    marked = rows.withColumn("_in", (F.coalesce(before, F.lit(-1)) >= F.col(end)) | (upto > F.col(end)))
    return marked.filter("NOT _in").drop("_in")


def _sentences_in(found: DataFrame, known: DataFrame, runs: DataFrame, scratch: Scratch, small: int) -> DataFrame:
    """(rid, id, sid, at, end): where known sentences stand, in pieces, for texts of (rid, id, text)."""
    pieces = F.flatten(
        F.transform(
            F.split("text", FULL_STOPS, -1),
            lambda s, k: F.transform(F.split(s, OTHER_ENDS, -1), lambda p: F.struct(k.alias("k"), normal(p).alias("part"))),
        )
    )
    pieces = F.transform(pieces, lambda p, at: F.struct(at.alias("at"), p["k"].alias("k"), p["part"].alias("part")))
    cut = found.select("rid", "id", F.filter(pieces, lambda p: p["part"] != "").alias("pieces"))
    cut = cut.select("rid", "id", F.explode(with_following("pieces")).alias("p")).select(
        "rid", "id", "p.x.*", F.when(F.col("p.y.k") == F.col("p.x.k"), F.col("p.y.part")).alias("following")
    )
    head = F.explode(F.array(*heads(F.col("part"), F.col("following")))).alias("h")
    starts = cut.select("rid", "k", "at", head).join(broadcast_if_small(runs, small), "h")
    starts = scratch.store(starts.select("rid", "k", "at", "sid").distinct(), "starts")
    within = broadcast_if_small(starts.select("rid", "k").distinct(), small)
    cut = cut.select("rid", "id", "k", "at", "part", F.size(F.split("part", " ")).alias("size")).join(within, ["rid", "k"], "left_semi")
    before = Window.partitionBy("rid", "k").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.withColumn("word", F.coalesce(F.sum("size").over(before), F.lit(0)).cast("int"))
    begun = placed.select("rid", "k", "at", F.col("word").alias("begin")).join(starts, ["rid", "k", "at"]).drop("at")
    begun = begun.join(known, "sid").withColumn("n", F.size("w"))
    # a piece is compared with the sentences begun in its block of words or in those just before it
    block = lambda word: F.floor(word / BLOCK)
    begun = begun.withColumn("block", F.explode(F.sequence(block(F.col("begin")), block(F.col("begin") + F.col("n") - 1))))
    there = placed.withColumn("block", block(F.col("word"))).join(begun, ["rid", "k", "block"])
    there = there.filter("word >= begin AND word + size <= begin + n")
    there = there.filter(F.array_join(F.slice("w", F.col("word") - F.col("begin") + 1, F.col("size")), " ") == F.col("part"))
    filled = there.groupBy("rid", "k", "begin", "sid").agg(
        F.first("id").alias("id"), F.first("n").alias("n"), F.sum("size").alias("filled"),
        F.min("at").alias("at"), F.max("at").alias("end"),
    )
    return outer(filled.filter("filled = n").select("rid", "id", "sid", "at", "end"), "at", "end")


def licences(
    docs: DataFrame,
    sentences: list[str] | DataFrame = SENTENCES,
    rules: list[tuple] | DataFrame = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
    small: int = 2_000_000,
) -> DataFrame:
    """One row per rule found in a row of docs: id, ``licence``, ``rule``, ``first`` and ``last`` piece (from 0).

    A sentence may stand on several lines, with blank ones and comment signs (no letters or digits) between; it
    must begin and end with a piece. A sentence whose pieces lie among those of a longer one is left out. A rule
    matches where its identifiers follow one another among the document's known sentences, whatever unknown ones
    stand between. A match inside a longer one is left out; each occurrence counts. Null or empty texts and empty
    tables give no rows, null ids are kept, rows equal in id and text report alike, other columns are not read.
    Texts of any length are searched whole. Sentences and rules are lists, or tables of (sid, sentence) and of
    (licence, rule, sids); a rule without identifiers matches nothing. ``small`` bounds the rows that are broadcast.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "licences")
    known = scratch.store(known_sentences(spark, sentences), "known")
    runs = scratch.store(beginnings(known), "runs")
    known_rule = scratch.store(known_rules(spark, rules), "rules")
    # texts are named by hash for the scan alone, so that it need not give them back; a clash lets one more in
    texts = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th")
    ).filter("text != ''")
    forms = texts.select("th", line_forms(F.col("text")).alias("parts")).select("th", F.explode(with_following("parts")).alias("p"))
    hashed = forms.select("th", F.explode(F.array(*heads(F.col("p.x"), F.col("p.y")))).alias("h"))
    begun = hashed.join(broadcast_if_small(runs.select("h").distinct(), small), "h", "left_semi")
    begun = scratch.store(begun.select("th").distinct(), "begun")
    found = texts.join(broadcast_if_small(begun, small), "th", "left_semi").withColumn("rid", F.monotonically_increasing_id())
    found = scratch.store(found.select("rid", "id", "text"), "found")
    by = Window.partitionBy("rid").orderBy("at", "sid", "end")
    numbered = _sentences_in(found, known, runs, scratch, small).withColumn("i", F.row_number().over(by))
    seen = scratch.store(numbered, "seen")
    scratch.drop("known", "runs", "begun", "found", "starts")

    # a rule is tried where its first sentence stands, and asks for one sentence at each place from there on
    tried = seen.select("rid", F.col("i").alias("a"), "sid").join(known_rule.withColumn("sid", F.get("sids", F.lit(0))), "sid")
    asked = tried.select("rid", "a", "no", "licence", "rule", F.size("sids").alias("n"), F.posexplode("sids").alias("j", "sid"))
    met = asked.withColumn("i", F.col("a") + F.col("j")).join(seen, ["rid", "i", "sid"])
    matches = met.groupBy("rid", "a", "no").agg(
        F.first("id").alias("id"), F.first("licence").alias("licence"), F.first("rule").alias("rule"), F.first("n").alias("n"),
        F.count("*").alias("c"), F.min(F.struct("j", "at")).alias("from"), F.max(F.struct("j", "end")).alias("to"),
    )
    matches = outer(matches.filter("c = n").withColumn("b", F.col("a") + F.col("n") - 1), "a", "b")
    return matches.select(
        F.col("id").alias(id_col), "licence", "rule",
        F.col("from.at").cast("long").alias("first"), F.col("to.end").cast("long").alias("last"),
    )
