"""Licence scans in DataFrame functions alone.

Parts of whole texts are compared with licence templates by the cosine of sparse
TF-IDF vectors; document frequencies of the template words come from all texts, a
word outside the templates weighs like one seen nowhere.

- Statements: every line, and every sentence of the text without comment markers at
  line starts (so a header wrapped over comment lines or plain lines is one sentence,
  and a sentence inside a longer line stands alone), against ``TEMPLATES``.
- Full texts: every paragraph without comment markers (a marker alone on its line
  separates), and the whole text of a file named like a licence file, against
  ``FULL_TEXTS``.

A file's own licence is that of its best part.  Files named like licence files also
cover their directory: a file without an own licence takes that of its nearest
ancestor directory, found by joining the distinct directories' ancestor paths.

Only parts with a word that the threshold requires are taken apart: by
Cauchy-Schwarz a part's cosine is at most the square root of the template's weight
that it shares, so it must hold one of the heaviest words.  No part that could match
is left out.

Null texts have no parts; a null path has no directory, a null id is kept as it is
and a null path part of a document is ``unknown``.  Ties go to the greater licence
name, in a directory to the best score, then the least path.  Rows are known by id,
path and text together, so rows that share an id get each their own answer and
repeated rows the same one; further columns are not read, an empty table gives no
rows, and texts of any length are read whole.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

THRESHOLD = 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Licence statements and titles that the scan knows.
TEMPLATES = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "Apache License, Version 2.0, January 2004"),
    "ARR": ("All rights reserved.",),
    "BSD-3-Clause": ("Redistribution and use in source and binary forms, with or without modification, are permitted.", "BSD 3-Clause License"),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", "GNU General Public License, Version 3, 29 June 2007"),
    "ISC": ("ISC License",),
    "LGPL-3.0": ("This library is licensed under the GNU Lesser General Public License, version 3.", "GNU Lesser General Public License, Version 3, 29 June 2007"),
    "MIT": ("Released under the MIT License.", "The MIT License"),
    "MPL-2.0": (
        "This file is subject to the terms of the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
        "Mozilla Public License Version 2.0",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}
# Header notices and licence texts, as their publishers give them.
FULL_TEXTS = {
    "Apache-2.0": (
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
        You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0""",
        """Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
        permissions and limitations under the License.""",
    ),
    "GPL-3.0": (
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published
        by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    ),
    "ISC": (
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that
        the above copyright notice and this permission notice appear in all copies.""",
    ),
    "MIT": (
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
        "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to
        the following conditions:""",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
        "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to
        the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions
        of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
        WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS
        BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
        CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    "MPL-2.0": (
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this
        file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    ),
}
# line starts of comments, what ends a sentence, and what separates paragraphs (both engines read these patterns alike)
MARKER = r"(^|\n)[ \t]*(?://+|/?\*+/?|#+|--+|;+|%+|<!--)[ \t]*"
PARAGRAPH = r"\n[ \t\r\n]*\n"
SENTENCE = r"[.!?;:]+[\"')]*[ \t\r\n]+|" + PARAGRAPH
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)"
OPENING = r"(?i)licen[cs]e|rights reserved"
WORD = "[a-z0-9]+"


def words_of(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))


def flat(templates: dict[str, tuple[str, ...]]) -> list[tuple[str, str]]:
    return [(name, text) for name, texts in templates.items() for text in texts]


def template_words(*templates: dict[str, tuple[str, ...]]) -> list[str]:
    return sorted({w for ts in templates for _, t in flat(ts) for w in words_of(t)})


def _lower(c):
    return F.translate(c, UPPER, LOWER)


def word_idf(files: DataFrame, words: list[str]) -> tuple[dict[str, float], float]:
    """Smoothed inverse document frequency of the given words over all texts, and that of an unseen word."""
    own = F.array_intersect(F.regexp_extract_all(_lower("text"), F.lit(f"({WORD})")), F.array(*map(F.lit, words)))
    got = files.select(F.explode(F.concat(F.array(F.lit("")), F.coalesce(own, F.array().cast("array<string>")))).alias("w")).groupBy("w").count().collect()
    seen = {r["w"]: r["count"] for r in got}
    n = seen.get("", 0)
    return {w: math.log((1 + n) / (1 + seen.get(w, 0))) + 1 for w in words}, math.log(1 + n) + 1


def template_weights(templates: list[tuple[str, str]], idf: dict[str, float]) -> list[dict[str, float]]:
    out = []
    for _, text in templates:
        ws = words_of(text)
        raw = {w: ws.count(w) * idf[w] for w in set(ws)}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        out.append({w: x / norm for w, x in raw.items()})
    return out


def required_words(weights: list[dict[str, float]], threshold: float) -> list[str]:
    """Words of which a part must hold one at least to reach the threshold with any template."""
    out: set[str] = set()
    for own in weights:
        left = 1.0
        for w, x in sorted(own.items(), key=lambda p: (-p[1], p[0])):
            if left < threshold**2 - 1e-9:
                break
            out.add(w)
            left -= x * x
    return sorted(out)


def _holding(words: list[str]) -> Column:
    return F.lit(r"(^|[^a-z0-9])(" + "|".join(words) + r")([^a-z0-9]|$)")


def word_table(spark: SparkSession, idf: dict[str, float], weights: list[dict[str, float]]) -> DataFrame:
    """``w, idf, y``: one row per template word with its weight in every template; as many rows as the templates have words."""
    rows = [{"w": w, "idf": x, "y": [own.get(w, 0.0) for own in weights]} for w, x in idf.items()]
    held = F.from_json(F.lit(json.dumps(rows)), "array<struct<w string, idf double, y array<double>>>")
    return spark.range(1).select(F.explode(held).alias("r")).select("r.*")


def part_matches(files: DataFrame, templates: dict[str, tuple[str, ...]], full_texts: dict[str, tuple[str, ...]], threshold: float) -> DataFrame:
    """``files(row_id, text, whole)`` to ``row_id, licence, score``: the best part of each, where it reaches the threshold."""
    idf, unseen = word_idf(files, template_words(templates, full_texts))
    short, long = flat(templates), flat(full_texts)
    both = [template_weights(short, idf), template_weights(long, idf)]
    need = [required_words(w, threshold) for w in both]
    low = files.select("row_id", "whole", _lower("text").alias("text")).where(F.rlike("text", _holding(sorted({*need[0], *need[1]}))))
    bare = low.withColumn("bare", F.regexp_replace("text", MARKER, "$1"))
    holds = lambda k: lambda u: F.rlike(u, _holding(need[k]))
    statements = F.array_distinct(F.filter(F.concat(F.split("text", "\n", -1), F.split("bare", SENTENCE, -1)), holds(0)))
    blocks = F.array_distinct(F.filter(F.concat(F.split("bare", PARAGRAPH, -1), F.when(F.col("whole"), F.array("bare")).otherwise(F.array().cast("array<string>"))), holds(1)))
    tagged = lambda units, kind: F.transform(units, lambda u: F.struct(F.lit(kind).alias("kind"), u.alias("text")))
    parts = bare.select("row_id", F.posexplode(F.concat(tagged(statements, 0), tagged(blocks, 1))).alias("part", "u")).select("row_id", "part", "u.*")
    terms = parts.select("row_id", "part", "kind", F.explode(F.regexp_extract_all("text", F.lit(f"({WORD})"))).alias("w")).groupBy("row_id", "part", "kind", "w").agg(F.count("*").alias("tf"))
    # the table of words is bounded by the templates, whatever the corpus
    weighed = terms.join(F.broadcast(word_table(files.sparkSession, idf, both[0] + both[1])), "w", "left")
    x = F.col("tf") * F.coalesce("idf", F.lit(unseen))
    n = len(short) + len(long)
    sums = weighed.select("row_id", "part", "kind", x.alias("x"), "y").groupBy("row_id", "part", "kind").agg(F.sum(F.col("x") * F.col("x")).alias("norm"), *[F.sum(F.col("x") * F.col("y")[i]).alias(f"t{i}") for i in range(n)])
    score = lambda i: F.round(F.coalesce(F.col(f"t{i}"), F.lit(0.0)) / F.sqrt("norm"), 6)
    each = [F.struct(score(i).alias("score"), F.lit(name).alias("licence")) for i, (name, _) in enumerate(short + long)]
    best = sums.select("row_id", F.when(F.col("kind") == 0, F.array_max(F.array(*each[: len(short)]))).otherwise(F.array_max(F.array(*each[len(short) :]))).alias("best"))
    top = best.where(F.col("best.score") >= threshold).groupBy("row_id").agg(F.max("best").alias("m"))
    return top.select("row_id", F.col("m.licence").alias("licence"), F.col("m.score").alias("score"))


def ancestors(directory):
    """All ancestor paths of a directory, itself included."""
    parts = F.split(directory, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))


def scan_licences(files: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, threshold: float = THRESHOLD, licence_file: str = LICENCE_FILE, full_texts: dict[str, tuple[str, ...]] = FULL_TEXTS) -> DataFrame:
    """``files(file_id, path, text)`` to ``file_id, path, licence, score, origin, from_path``; origin is ``header``, ``directory`` or null."""
    said = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    row_id = F.md5(F.concat_ws("\n", said("file_id"), said("path"), said("text")))
    rows = files.select("file_id", "path", row_id.alias("row_id"), F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("dir"), F.regexp_extract("path", "([^/]*)$", 1).alias("name"), "text")
    named = F.coalesce(F.rlike("name", F.lit(licence_file)), F.lit(False))
    found = part_matches(rows.select("row_id", "text", named.alias("whole")), templates, full_texts, threshold)
    placed = rows.drop("text").join(found, "row_id", "left")
    covering = placed.where(F.col("licence").isNotNull() & F.rlike("name", F.lit(licence_file)))
    cover = covering.groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("path"), F.col("licence"))).alias("m"))
    cover = cover.select(F.col("dir").alias("up"), F.col("m.licence").alias("dir_licence"), (-F.col("m.s")).alias("dir_score"), F.col("m.path").alias("dir_path"))
    # distinct directories, not files, meet the ancestors, so a full directory is one row here
    dirs = placed.select("dir").distinct().select("dir", F.explode(ancestors(F.col("dir"))).alias("up"))
    near = dirs.join(cover, "up").groupBy("dir").agg(F.max_by(F.struct("dir_licence", "dir_score", "dir_path"), F.length("up")).alias("near"))
    got = placed.join(near, "dir", "left")
    own = F.col("licence").isNotNull()
    return got.select("file_id", "path", F.when(own, F.col("licence")).otherwise(F.col("near.dir_licence")).alias("licence"), F.when(own, F.col("score")).otherwise(F.col("near.dir_score")).alias("score"), F.when(own, F.lit("header")).when(F.col("near").isNotNull(), F.lit("directory")).alias("origin"), F.when(own, F.col("path")).otherwise(F.col("near.dir_path")).alias("from_path"))


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files: source, language and thousand of the id make the directory.

    A text that opens with a licence line stands as a licence file; by the remainder of its id by 3 it stands in the
    source's directory, in that of source and language, or in the lowest one.
    """
    opens = F.coalesce(F.rlike(F.regexp_extract("text", "^([^\n]*)", 1), F.lit(OPENING)), F.lit(False))
    shown = F.coalesce(F.col("doc_id").cast("string"), F.lit("unknown"))
    name = F.when(opens, F.concat(F.lit("LICENSE-"), shown)).otherwise(F.concat(shown, F.lit(".txt")))
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("unknown"))
    parts = F.array(part("source"), part("lang"), F.coalesce(F.floor(F.col("doc_id") / 1000).cast("string"), F.lit("unknown")))
    depth = F.when(opens, F.coalesce(F.pmod("doc_id", F.lit(3)) + 1, F.lit(3))).otherwise(F.lit(3)).cast("int")
    return docs.select(F.col("doc_id").alias("file_id"), F.concat_ws("/", F.array_join(F.slice(parts, F.lit(1), depth), "/"), name).alias("path"), "text")
