"""Licence scan: Dice coefficient over word bigrams against licence templates.

The units compared are every line, every paragraph of several lines, and every whole text of several
paragraphs. A template is a candidate only if the numbers of bigrams allow the wanted coefficient.
Texts and units without any word that a match must have are passed over before they are split.
Built-in functions only, no shuffle: one pass over the texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DICE = 0.8

#: Licence notices and short licence texts that units are compared with (fixed values).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD", "Licensed under the BSD License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Proprietary", "All rights reserved."),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    number: int
    license: str
    bigrams: tuple[str, ...]
    low: int  # fewest and most bigrams of a unit that can reach the coefficient
    high: int


def template_bigrams(text: str) -> tuple[str, ...]:
    words = re.findall("[a-z0-9]+", text.lower())
    return tuple(sorted({f"{a} {b}" for a, b in zip(words, words[1:])}))


def templates(dice: float = DICE, texts=TEMPLATES) -> list[Template]:
    """Templates with the size bounds: 2 min(a, b) / (a + b) >= dice."""
    out = []
    for number, (name, text) in enumerate(texts):
        grams = template_bigrams(text)
        n = len(grams)
        low = next(a for a in range(1, n + 1) if 2 * min(a, n) / (a + n) >= dice)
        high = n
        while 2 * n / (high + 1 + n) >= dice:
            high += 1
        out.append(Template(number, name, grams, low, high))
    return out


#: Words too common in prose to tell a licence (fixed values).
COMMON = frozenset("a above after all also an and any are as at be before being but by can do each following for "
                   "from has have here his if in included including into is it its may more no not of on one only "
                   "or other otherwise our out particular person persons possible project provided public shall so "
                   "some source subject such than that the their them then there these they this to under up use "
                   "version was we were what when which who will with without would you your".split())


def anchors(known: list[Template], dice: float = DICE) -> list[str]:
    """Words of which every unit that reaches the coefficient with some template has at least one.

    Such a unit has at least ``dice * (low + b) / 2`` of the b bigrams of the template, so it meets any
    set of words that touches all but fewer bigrams than that. The word that helps most templates most
    is taken first, common words last.
    """
    open_grams = {t.number: [set(g.split()) for g in t.bigrams] for t in known}
    needed = {t.number: len(t.bigrams) - math.ceil(dice * (t.low + len(t.bigrams)) / 2 - 1e-9) + 1 for t in known}
    chosen: list[str] = []
    while needed:
        gain: dict[str, float] = {}
        for number, most in needed.items():
            own = Counter(w for g in open_grams[number] for w in g)
            for w, n in own.items():
                gain[w] = gain.get(w, 0.0) + min(n, most) / most
        best = min(gain, key=lambda w: (w in COMMON or len(w) < 2, -gain[w], w))
        chosen.append(best)
        for number in list(needed):
            left = [g for g in open_grams[number] if best not in g]
            needed[number] -= len(open_grams[number]) - len(left)
            open_grams[number] = left
            if needed[number] <= 0:
                del needed[number]
    return sorted(chosen)


def anchor_pattern(found: list[str]) -> str:
    """Pattern for any of the words in either case, grouped by first letter."""
    groups = [f"[{k}{k.upper()}](?i:{'|'.join(w[1:] for w in found if w[0] == k)})" if k.isalpha()
              else "|".join(w for w in found if w[0] == k) for k in sorted({w[0] for w in found})]
    return f"(?<![A-Za-z0-9])(?:{'|'.join(groups)})(?![A-Za-z0-9])"


def words(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits; an empty array for a text without."""
    plain = F.trim(F.regexp_replace(F.translate(text, _UPPER, _LOWER), "[^a-z0-9]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def bigrams(w: Column) -> Column:
    """Distinct pairs of neighbouring words of an array of at least two."""
    n = F.size(w)
    return F.array_distinct(F.zip_with(F.slice(w, 1, n - 1), F.slice(w, 2, n - 1),
                                       lambda a, b: F.concat_ws(" ", a, b)))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dice: float = DICE,
         texts=TEMPLATES) -> DataFrame:
    """``id_col, unit, position, license, template, n_bigrams, dice``: the best template of each unit
    that reaches the coefficient.

    ``unit`` is line, paragraph or text, ``position`` counts from 0 within the document. Ties go to the
    template that stands first. A null, empty or one-word text has no unit and so no row; repeated rows
    of the table are repeated in the result. ``dice`` must be above 0.
    """
    known = templates(dice, texts)
    anchor = anchor_pattern(anchors(known, dice))
    lines = F.split("_text", "\n")
    blocks = F.filter(F.split("_text", "\n[ \t\r]*\n"), lambda p: F.trim(p) != "")
    whole = F.when(F.size(blocks) > 1, F.array(F.struct(F.lit("text").alias("unit"), F.lit(0).alias("position"),
                                                         F.col("_text").alias("body"))))
    several = F.filter(
        F.transform(blocks, lambda p, i: F.struct(F.lit("paragraph").alias("unit"), i.alias("position"), p.alias("body"))),
        lambda s: F.contains(s["body"], F.lit("\n")))
    single = F.transform(lines, lambda p, i: F.struct(F.lit("line").alias("unit"), i.alias("position"), p.alias("body")))
    units = (
        docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where(F.rlike("_text", F.lit(anchor)))
        .select("_id", F.inline(F.concat(single, several, F.coalesce(whole, F.array().cast(
            "array<struct<unit:string,position:int,body:string>>")))))
    )
    # Generators keep the optimiser from copying the long expressions into every later use.
    units = units.where(F.rlike("body", F.lit(anchor)))
    tokens = units.select("_id", "unit", "position", F.explode(F.array(words(F.col("body")))).alias("_w"))
    grams = (
        tokens.where(F.size("_w") > min(t.low for t in known))
        .select("_id", "unit", "position", F.explode(F.array(bigrams(F.col("_w")))).alias("_g"))
        .withColumn("_n", F.size("_g"))
    )
    all_templates = F.array(*[
        F.struct(F.lit(t.number).alias("number"), F.lit(t.license).alias("license"), F.lit(t.low).alias("low"),
                 F.lit(t.high).alias("high"), F.array(*map(F.lit, t.bigrams)).alias("grams"))
        for t in known])
    candidates = F.filter(all_templates, lambda t: F.col("_n").between(t["low"], t["high"]))
    rated = F.transform(candidates, lambda t: F.struct(
        (2.0 * F.size(F.array_intersect(F.col("_g"), t["grams"])) / (F.col("_n") + F.size(t["grams"]))).alias("dice"),
        (-t["number"]).alias("order"), t["license"].alias("license")))
    best = grams.select("_id", "unit", "position", "_n", F.explode(F.array(F.array_max(rated))).alias("_b"))
    return best.where(F.col("_b.dice") >= dice).select(
        F.col("_id").alias(id_col), "unit", "position", F.col("_b.license").alias("license"),
        (-F.col("_b.order")).alias("template"), F.col("_n").alias("n_bigrams"), F.col("_b.dice").alias("dice"))


def sql(table: str = "documents", dice: float = DICE, texts=TEMPLATES) -> str:
    """The same rows for the production templates, as DuckDB SQL."""
    rows = ", ".join(
        f"({t.number}, '{t.license}', [{', '.join(repr(g) for g in t.bigrams)}], {t.low}, {t.high})"
        for t in templates(dice, texts))
    return f"""
WITH templates(template, license, grams, low, high) AS (VALUES {rows}),
blocks AS (
    SELECT doc_id, text, list_filter(regexp_split_to_array(text, '\\n[ \\t\\r]*\\n'), lambda p: trim(p) <> '') AS b
    FROM {table} WHERE text IS NOT NULL),
units AS (
    SELECT doc_id, 'line' AS unit, unnest(range(len(l))) AS position, unnest(l) AS body
    FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM blocks)
    UNION ALL
    SELECT * FROM (SELECT doc_id, 'paragraph', unnest(range(len(b))), unnest(b) AS body FROM blocks)
    WHERE contains(body, chr(10))
    UNION ALL
    SELECT doc_id, 'text', 0, text FROM blocks WHERE len(b) > 1),
words AS (
    SELECT doc_id, unit, position, string_split(trim(regexp_replace(
        translate(body, '{_UPPER}', '{_LOWER}'), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM units),
grams AS (
    SELECT doc_id, unit, position,
           list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g
    FROM words WHERE len(w) > 1),
scores AS (
    SELECT doc_id, unit, position, template, license, len(g) AS n,
           2.0 * len(list_intersect(g, grams)) / (len(g) + len(grams)) AS dice
    FROM grams JOIN templates ON len(g) BETWEEN low AND high)
SELECT doc_id, unit, CAST(position AS INTEGER) AS position, license, CAST(template AS INTEGER) AS template,
       CAST(n AS INTEGER) AS n_bigrams, CAST(dice AS DOUBLE) AS dice
FROM scores WHERE dice >= {dice}
QUALIFY row_number() OVER (PARTITION BY doc_id, unit, position ORDER BY dice DESC, template) = 1"""
