"""Licence scan: lines and whole texts against licence templates, by Dice coefficient.

A text is lower-cased, everything but letters and digits separates words, and its features are the
distinct pairs of neighbouring words. The coefficient of n features and a template of m features is
2 * shared / (n + m). It can only reach t if m lies between n * t / (2 - t) and n * (2 - t) / t, so
a template outside these bounds is never compared. Units are every line and the whole text.

A unit that reaches t shares at least m * t / (2 - t) of the m pairs of the template, so it has one
of any larger part of them. For each template a few words are chosen that stand in so many pairs;
texts and lines without any of these words are passed over before their pairs are built.

Templates meet a unit only through a pair of words they share. The table of their pairs is fixed
(a few hundred rows), so it is broadcast; nothing is compared with everything. Only DataFrame
functions are used.

`noticed` compares windows of words instead of units, across line breaks and inside lines, so it
also finds a notice that is wrapped, commented or part of a paragraph, and full licence texts.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replenish.llm.common import col
from replenish.operators.scale import look_up, materialise

# The least coefficient of a match, in per cent.
PERCENT = 80

# Words that say little about a text.
COMMON = frozenset("a an and any at be by can file for found if in is it not of on or that the this to under with you".split())

# Notices as licensors write them, by licence.
TEMPLATES: list[tuple[str, str]] = [
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

# Whole texts that hold no notice of the list above, or much besides it.
_BSD_2 = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
FULL_TEXTS: list[tuple[str, str]] = [
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD-2-Clause", f"{_BSD_2} {_BSD_END}"),
    ("BSD-3-Clause", f"{_BSD_2} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. {_BSD_END}"),
]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), " "), "")


def all_pairs(words: Column) -> Column:
    """Pairs of neighbouring words in order, as text."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(
        F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b)
    )


def word_pairs(text: Column) -> Column:
    """Distinct pairs of neighbouring words, as text."""
    return F.array_distinct(all_pairs(words_of(text)))


def template_pairs(spark, templates: list[tuple[str, str]]) -> DataFrame:
    """pair, template (number), licence, m: one row per pair of a template."""
    rows = [(i, name, text) for i, (name, text) in enumerate(templates)]
    table = spark.createDataFrame(rows, "template int, licence string, text string")
    return table.withColumn("pairs", word_pairs(F.col("text"))).select(
        "template", "licence", F.size("pairs").alias("m"), F.explode("pairs").alias("pair")
    )


def anchors(pairs: list[str], percent: int) -> list[str]:
    """Words of a template of which a unit that reaches the threshold has at least one: together
    they stand in more pairs than such a unit may lack. Uncommon and long words come first."""
    lacking = len(pairs) - math.ceil(len(pairs) * percent / (200 - percent))
    chosen: list[str] = []
    covered: set[str] = set()
    words = sorted({w for p in pairs for w in p.split()}, key=lambda w: (w in COMMON, -len(w), w))
    for word in words:
        if len(covered) > lacking:
            break
        own = {p for p in pairs if word in p.split()}
        if not own <= covered:
            chosen.append(word)
            covered |= own
    return chosen


def any_of_words(words: list[str]) -> str:
    """A pattern that finds any of the words in one pass; words with the same first letter share a
    branch, so a position is compared with few of them."""
    by_first: dict[str, list[str]] = {}
    for word in words:
        by_first.setdefault(word[0], []).append(re.escape(word[1:]))
    return "|".join(f"{re.escape(c)}(?:{'|'.join(rest)})" for c, rest in sorted(by_first.items()))


def _bounds(n: Column, m: Column, percent: int) -> Column:
    return (m * (200 - percent) >= n * percent) & (m * percent <= n * (200 - percent))


def matches(
    docs: DataFrame,
    text: str = "text",
    percent: int = PERCENT,
    templates: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """text_key (MD5 of the text), line (1..n, 0 for the whole text), template, licence, dice: every
    pair of a unit and a template whose coefficient reaches `percent`."""
    templates = TEMPLATES if templates is None else templates
    # A fixed table; its size is that of TEMPLATES.
    known = template_pairs(docs.sparkSession, templates)
    if not templates:
        return known.select(F.lit("").alias("text_key"), F.lit(0).alias("line"), "template", "licence", F.lit(0.0).alias("dice"))
    of: dict[int, list[str]] = {}
    for row in known.collect():
        of.setdefault(row["template"], []).append(row["pair"])
    sizes = {len(pairs) for pairs in of.values()}
    words = sorted({w for pairs in of.values() for w in anchors(pairs, percent)})

    value = F.coalesce(col(text).cast("string"), F.lit(""))
    keyed = docs.select(F.md5(value.cast("binary")).alias("text_key"), value.alias("value"))
    # Before anything is computed from a text; besides A-Z two letters become one of a-z.
    pattern = any_of_words(words)
    texts = keyed.filter(
        F.rlike("value", F.lit(f"(?i){pattern}")) | F.rlike("value", F.lit("[\u0130\u212a]"))
    ).select("text_key", F.lower("value").alias("value"))
    # The whole text comes first, as line 0.
    lines = F.concat(F.array("value"), F.split("value", "\n"))
    units = texts.select("text_key", F.posexplode(lines).alias("line", "unit")).filter(
        F.rlike("unit", F.lit(pattern))
    )
    paired = units.select("text_key", "line", word_pairs(F.col("unit")).alias("pairs")).withColumn(
        "n", F.size("pairs")
    )
    possible = reduce(
        lambda a, b: a | b, [_bounds(F.col("n"), F.lit(m), percent) for m in sizes], F.lit(False)
    )
    exploded = paired.filter(possible).select("text_key", "line", "n", F.explode("pairs").alias("pair"))
    met = exploded.join(F.broadcast(known), "pair").filter(
        _bounds(F.col("n"), F.col("m"), percent)
    )
    # Repeated texts meet with the same pairs; each counts once.
    shared = met.dropDuplicates(["text_key", "line", "template", "pair"])
    shared_pairs, both = F.col("shared"), F.col("n") + F.col("m")
    return (
        shared.groupBy("text_key", "line", "template", "licence", "n", "m")
        .agg(F.count(F.lit(1)).alias("shared"))
        .filter(200 * shared_pairs >= percent * both)
        .select("text_key", "line", "template", "licence", (2 * shared_pairs / both).alias("dice"))
    )


def scanned(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    templates: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """One row per row of `docs`: doc_id, licence and dice of its best unit (null if none), n_units
    (lines, or the whole text, with a licence) and licences (all found, sorted, comma-separated).

    Of equal coefficients the first template in the list wins. Null texts count as empty and have
    no licence; keys may repeat or be null; an empty table gives no rows.
    """
    found = matches(docs, text, percent, templates)
    best = F.struct((-F.col("dice")).alias("off"), "template", "licence", "dice")
    per_text = materialise(
        found.groupBy("text_key").agg(
            F.min(best).alias("best"),
            F.count_distinct("line").cast("bigint").alias("n_units"),
            F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("licences"),
        )
    )
    rows = docs.select(
        col(key).alias("doc_id"),
        F.md5(F.coalesce(col(text).cast("string"), F.lit("")).cast("binary")).alias("text_key"),
    )
    return look_up(rows, per_text, ["text_key"]).select(
        "doc_id",
        F.col("best.licence").alias("licence"),
        F.col("best.dice").alias("dice"),
        F.coalesce("n_units", F.lit(0).cast("bigint")).alias("n_units"),
        F.coalesce("licences", F.lit("")).alias("licences"),
    )


def windows(
    docs: DataFrame,
    text: str = "text",
    percent: int = PERCENT,
    templates: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """text_key (MD5 of the text), template, licence, dice, start (number of the first word, from 1),
    n_words and shared (pairs of the template) of the best window of each text and template that
    reaches `percent`.

    A window starts and ends with a pair of the template and has no more pairs than a text that
    reaches the threshold can have. Pairs of the template count once in it, all others as often as
    they stand there.
    """
    templates = TEMPLATES + FULL_TEXTS if templates is None else templates
    known = template_pairs(docs.sparkSession, templates)
    if not templates:
        return known.select(F.lit("").alias("text_key"), "template", "licence", F.lit(0.0).alias("dice"),
                            F.lit(0).alias("start"), F.lit(0).alias("n_words"), F.lit(0).alias("shared"))
    # Fixed tables; their size is that of the templates.
    of: dict[int, list[str]] = {}
    for row in known.collect():
        of.setdefault(row["template"], []).append(row["pair"])
    number = {p: i for i, p in enumerate(sorted({p for pairs in of.values() for p in pairs}))}
    numbered = docs.sparkSession.createDataFrame(
        [
            (t, templates[t][0], p, number[p], len(pairs), -(-len(pairs) * percent // (200 - percent)),
             len(pairs) * (200 - percent) // percent)
            for t, pairs in of.items() for p in pairs
        ],
        "template int, licence string, pair string, p int, m int, need int, most int",
    )
    pattern = any_of_words(sorted({w for pairs in of.values() for w in anchors(pairs, percent)}))

    value = F.coalesce(col(text).cast("string"), F.lit(""))
    texts = docs.select(F.md5(value.cast("binary")).alias("text_key"), value.alias("value")).filter(
        F.rlike("value", F.lit(f"(?i){pattern}")) | F.rlike("value", F.lit("[\u0130\u212a]"))
    )
    words = texts.select("text_key", words_of(F.col("value")).alias("words"))
    placed = words.select("text_key", F.posexplode(all_pairs(F.col("words"))).alias("i", "pair"))
    hits = (
        placed.join(F.broadcast(numbered), "pair")
        .groupBy("text_key", "template", "licence", "m", "need", "most")
        # Repeated texts have the same hits; each counts once.
        .agg(F.array_sort(F.collect_set(F.struct("i", "p"))).alias("hits"))
        .filter("size(hits) >= need")
    )
    # Starts that have enough hits within reach, each with the hits within reach.
    starts = F.expr(
        "filter(sequence(1, size(hits) - need + 1), a -> hits[a + need - 2].i - hits[a - 1].i < most)"
    )
    near = (
        hits.withColumn("starts", starts)
        .filter("size(starts) > 0")
        .select("text_key", "template", "licence", "m", "need", "most",
                F.explode(F.expr("transform(starts, a -> slice(hits, a, most))")).alias("w"))
        .withColumn("w", F.expr("filter(w, h -> h.i < w[0].i + most)"))
        .filter("size(array_distinct(w.p)) >= need")
    )
    ends = near.select(
        "text_key", "template", "licence", "m", F.expr("w[0].i + 1").alias("start"),
        F.explode(F.expr(
            "transform(sequence(need, size(w)), k -> struct(w[k - 1].i - w[0].i + 1 AS length, k AS inside, "
            "size(array_distinct(slice(w.p, 1, k))) AS shared))"
        )).alias("e"),
    )
    shared, both = F.col("e.shared"), F.expr("e.shared + e.length - e.inside + m")
    best = F.struct((2 * shared / both).alias("dice"), (-F.col("start")).alias("off"), (F.col("e.length") + 1).alias("n_words"), shared.alias("shared"))
    return (
        ends.filter(200 * shared >= percent * both)
        .groupBy("text_key", "template", "licence")
        .agg(F.max(best).alias("best"))
        .select("text_key", "template", "licence", "best.dice", (-F.col("best.off")).alias("start"), "best.n_words", "best.shared")
    )


def noticed(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    templates: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """One row per row of `docs`: doc_id, licence, dice, start and n_words of its best window (null
    if none) and licences (all found, sorted, comma-separated). The window that shares most pairs
    is best, so a whole text goes before a notice in it, then the largest coefficient, then the
    first template in the list; rows are treated as in `scanned`."""
    best = F.struct((-F.col("shared")).alias("few"), (-F.col("dice")).alias("off"), "template", "licence", "dice", "start", "n_words")
    per_text = materialise(
        windows(docs, text, percent, templates)
        .groupBy("text_key")
        .agg(
            F.min(best).alias("best"),
            F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("licences"),
        )
    )
    rows = docs.select(
        col(key).alias("doc_id"),
        F.md5(F.coalesce(col(text).cast("string"), F.lit("")).cast("binary")).alias("text_key"),
    )
    return look_up(rows, per_text, ["text_key"]).select(
        "doc_id", "best.licence", "best.dice", "best.start", "best.n_words",
        F.coalesce("licences", F.lit("")).alias("licences"),
    )
