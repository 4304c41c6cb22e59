"""Licence scan: normalised text against licence templates by the Dice coefficient over word bigrams.

The units compared are the lines of a text and the text as a whole. With a bigrams in the unit and b in
the template the coefficient is at most 2 min(a, b) / (a + b), so only templates within size bounds are
candidates. Column expressions only; the templates are literals of the plan, their number and length are
the user's to bound.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from dragoman.functions.plan import bind_once
from dragoman.llm.common import col

MIN_DICE = 0.8
# fixed values: notices by which works state their licence
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
                   "See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
            "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
                "You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
            "copyright notice and this permission notice appear in all copies."),
]


def template_bigrams(text: str) -> list[str]:
    """Distinct word bigrams of a normalised template, in order."""
    words = [w for w in re.split(r"[^a-z0-9]+", text.lower()) if w]
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def size_bounds(n: int, min_dice: float) -> tuple[int, int]:
    """Numbers of bigrams that a unit may have to reach ``min_dice`` with a template of ``n``."""
    ratio = min_dice / (2 - min_dice)
    return math.ceil(n * ratio - 1e-9), math.floor(n / ratio + 1e-9)


def anchor_bigrams(templates: list[list[str]], min_dice: float) -> list[tuple[str, str]]:
    """Word bigrams of which every unit at ``min_dice`` with a template (its bigrams) holds one.

    Such a unit shares min_dice * (n + b) / 2 bigrams or more, n being at least the lower size bound, so it lacks few of
    the b; any one more than it may lack will do. Those already taken come first, then those with the longest words.
    """
    taken: dict[str, None] = {}
    for bigrams in templates:
        b = len(bigrams)
        lacking = b - max(1, math.ceil(min_dice * (size_bounds(b, min_dice)[0] + b) / 2 - 1e-9))
        order = sorted(bigrams, key=lambda x: (x not in taken, -max(map(len, x.split(" "))), -len(x), x))
        taken.update(dict.fromkeys(order[:lacking + 1]))
    return sorted(tuple(x.split(" ")) for x in taken)


def _anchored(lowered: Column, anchors: list[tuple[str, str]]) -> Column:
    """Whether the text may hold an anchor: one of its words is searched first, the pair only where both occur."""
    by_word: dict[str, list[tuple[str, str]]] = {}
    for pair in anchors:
        by_word.setdefault(max(pair, key=len), []).append(pair)
    has = lambda w: F.contains(lowered, F.lit(w))
    pairs = lambda held: reduce(or_, [has(min(p, key=len)) & F.rlike(lowered, F.lit(f"{p[0]}[^a-z0-9]+{p[1]}")) for p in held])
    return reduce(or_, [has(word) & pairs(held) for word, held in sorted(by_word.items())])


def _words(lowered: Column) -> Column:
    return F.filter(F.split(lowered, "[^a-z0-9]+", -1), lambda w: w != "")


def _bigrams(words: Column) -> Column:
    pairs = F.when(F.size(words) >= 2, F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda k: F.concat_ws(" ", F.get(words, k), F.get(words, k + 1))))
    return F.array_distinct(F.coalesce(pairs, F.array().cast("array<string>")))


def _among(values: list[str]):
    return lambda x: x.isin(values)


def found_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] | None = None,
                   min_dice: float = MIN_DICE) -> DataFrame:
    """(doc_id, line_no, license, dice): the best template of each unit at ``min_dice`` or more.

    ``line_no`` counts lines from 0 and is -1 for the text as a whole, which is a unit if it has several lines. Of equal
    templates the first licence by name is named. Null, empty and licence-free texts give no row; repeated rows repeat.
    """
    usable = [(name, b) for name, text in (TEMPLATES if templates is None else templates) if (b := template_bigrams(text))]
    text = F.coalesce(col(text_col), F.lit(""))
    df = docs.select(col(id_col).alias("doc_id"), text.alias("text"))
    if not usable:
        return df.filter("false").select("doc_id", F.lit(0).alias("line_no"), F.lit("").alias("license"), F.lit(0.0).alias("dice"))
    bounds = [size_bounds(len(b), min_dice) for _, b in usable]
    # distinct bigrams are fewer than words, so a unit with fewer words than the least bound is no candidate;
    # a repetitive unit may have many more words than bigrams, so the upper bound waits for the bigrams
    least = max(1, min(a for a, _ in bounds))
    every = sorted({x for _, b in usable for x in b})
    anchors = anchor_bigrams([b for _, b in usable], min_dice)
    # a unit's anchor is one of its text too, so most texts end here, before anything is split
    df = bind_once(df, {"lowered": F.lower("text")}, drop=("text",)).filter(_anchored(F.col("lowered"), anchors))
    units = F.split("lowered", "\n", -1)
    df = df.select("doc_id", F.posexplode(F.concat(units, F.when(F.size(units) > 1, F.array("lowered")).otherwise(F.array().cast("array<string>")))).alias("line_no", "unit"),
                   F.size(units).alias("n_lines")).select("doc_id", F.when(F.col("line_no") < F.col("n_lines"), F.col("line_no")).otherwise(-1).alias("line_no"), "unit")
    df = bind_once(df.filter(_anchored(F.col("unit"), anchors)), {"words": _words(F.col("unit"))}, drop=("unit",)).filter(F.size("words") > least)
    df = bind_once(df, {"bigrams": _bigrams(F.col("words"))}, drop=("words",))
    df = bind_once(df, {"n": F.size("bigrams"), "shared": F.filter("bigrams", lambda x: x.isin(every))}, drop=("bigrams",)).filter(F.size("shared") > 0)
    scores = []
    for (name, b), (low, high) in zip(usable, bounds):
        dice = 2.0 * F.size(F.filter("shared", _among(b))) / (F.col("n") + len(b))
        scores.append(F.when(F.col("n").between(low, high), F.struct((-dice).alias("cost"), F.lit(name).alias("license"))))
    best = F.array_min(F.filter(F.array(*scores), lambda x: x.isNotNull()))
    df = bind_once(df, {"best": best}, drop=("n", "shared"))
    return df.select("doc_id", F.col("line_no").cast("int").alias("line_no"), "best.license", (-F.col("best.cost")).alias("dice")).filter(F.col("dice") >= min_dice)


def twin_sql(templates: list[tuple[str, str]] | None = None, min_dice: float = MIN_DICE) -> str:
    """The same for DuckDB over ``documents``."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ",\n".join(f"({quote(n)}, {quote(t)})" for n, t in (TEMPLATES if templates is None else templates))
    return rf"""
WITH t AS (SELECT license, list_filter(regexp_split_to_array(lower(body), '[^a-z0-9]+'), lambda w: w <> '') AS w FROM (VALUES {rows}) v(license, body)),
     tb AS (SELECT license, list_distinct(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) AS b FROM t),
     l AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls, coalesce(text, '') AS text FROM documents),
     u AS (SELECT r, doc_id, unnest(range(0, len(ls))) AS line_no, unnest(ls) AS unit FROM l
           UNION ALL SELECT r, doc_id, -1, text FROM l WHERE len(ls) > 1),
     w AS (SELECT r, doc_id, line_no, list_filter(regexp_split_to_array(lower(unit), '[^a-z0-9]+'), lambda w: w <> '') AS w FROM u
           WHERE regexp_matches(lower(unit), 'licen|permission|released|software|work')),
     b AS (SELECT r, doc_id, line_no, list_distinct(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) AS b FROM w WHERE len(w) > 1),
     s AS (SELECT r, doc_id, line_no, license, 2.0::DOUBLE * len(list_intersect(b.b, tb.b)) / (len(b.b) + len(tb.b)) AS dice FROM b, tb),
     k AS (SELECT *, row_number() OVER (PARTITION BY r, line_no ORDER BY dice DESC, license) AS n FROM s)
SELECT doc_id, line_no::INTEGER AS line_no, license, dice FROM k WHERE n = 1 AND dice >= {min_dice}"""
