r"""Licence scans (DataFrame functions only).

A text is normalised to its words (A-Z in lower case, runs of letters and digits), over line breaks and punctuation, so a notice is found
wrapped, indented, or within a longer line. Each licence has templates: usual notices, and the paragraphs of its text. A template of n
words is compared with the text's windows of n words by the Dice coefficient 2 |a & b| / (|a| + |b|) of their sets of word
bigrams; its best window is a hit if it reaches the threshold.

A coefficient of t needs t / (2 - t) of the template's bigrams in the window. So one pass marks the text's bigrams that any template has, a
template is left out unless the text has that many of its bigrams, and a window is cut out only if it starts with one and holds that many.
All within a row; nothing is shuffled, and the work grows with the text's length times the longest template at most.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import ascii_lower, let, table

THRESHOLD = 0.8
# Notices and paragraphs of public licences.
WARRANTY = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU %sGeneral Public License as published by the Free Software Foundation, either version %s of the License, or (at your option) any later version."
NOTICES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    "MIT": (
        "Released under the MIT License.", "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        WARRANTY,
    ),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", GNU % ("", "3")),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", (GNU % ("", "2")).replace("software:", "software;")),
    "LGPL-3.0": ("This library is licensed under the GNU Lesser General Public License, version 3.", GNU % ("Lesser ", "3")),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.", GNU % ("Affero ", "3")),
    "BSD-3-Clause": (
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", "Licensed under the BSD 3-Clause License.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.", BSD),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    "BSL-1.0": ("Distributed under the Boost Software License, Version 1.0.",),
}


def _templates(notices: dict) -> list[tuple[str, int, list[str]]]:
    """(licence, number of words, different bigrams) of each template with a bigram."""
    cut = lambda text: [w for w in re.split(r"[\W_]+", text.lower()) if w]
    return [(name, len(w), sorted({f"{a} {b}" for a, b in zip(w, w[1:])})) for name, texts in notices.items() for w in map(cut, texts) if len(w) > 1]


def scan(docs: DataFrame, notices: dict = NOTICES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_words, hits) for each row of `docs`, repeated rows and all: for each template that reaches the threshold struct(licence, dice,
    template, start, stop) of its best window (the first of equals), in words; in the order of `notices`.

    Null and empty texts have no words and no hits, as have texts of one word. No rows give no rows.
    """
    known = _templates(notices)
    share = threshold / (2 - threshold)
    marked, first = sorted({x for _, _, t in known for x in t}), sorted({x.split(" ")[0] for _, _, t in known for x in t})
    words = F.array_remove(F.split(ascii_lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    pair = lambda w, i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1))

    def found(w: Column) -> Column:
        """struct(i, b): the places and texts of the bigrams that some template has."""
        some = F.filter(F.transform(w, lambda x, i: F.when(x.isin(first), F.struct(i.alias("i"), pair(w, i).alias("b")))), lambda p: p["b"].isin(marked))
        return F.struct(F.size(w).cast("long").alias("n"), F.when(F.size(some) > 0, w).alias("w"), some.alias("p"))

    def best(k: int, licence: str, n: int, bigrams: list[str]) -> Column:
        least = math.ceil(share * len(bigrams) - 1e-9)

        def windows(own: Column) -> Column:
            # Places are different, so a window of n words has its bigrams among the next n - 1 of them.
            full = lambda p, j: F.get(own, j + F.lit(least - 1))["i"] < p["i"] + n - 1
            starts = F.filter(F.transform(own, lambda p, j: F.when(full(p, j), p["i"])), lambda s: s.isNotNull())

            def scored(s: Column) -> Column:
                inside = F.array_distinct(F.transform(F.sequence(s, F.least(s + n, F.size("_t.w")) - 2), lambda i: pair(F.col("_t.w"), i)))
                dice = let(inside, lambda a: 2 * F.size(F.filter(a, lambda x: x.isin(bigrams))) / (F.size(a) + len(bigrams)))
                return F.struct(dice.alias("dice"), (-s).alias("at"))

            top = F.array_max(F.transform(starts, scored))
            return let(top, lambda x: F.when(x["dice"] >= threshold, F.struct(
                F.lit(licence).alias("licence"), x["dice"].alias("dice"), F.lit(k).alias("template"), (-x["at"]).alias("start"), F.least(n - x["at"], F.size("_t.w")).alias("stop"))))

        own = F.filter(F.col("_t.p"), lambda p: p["b"].isin(bigrams))
        return F.when(F.size("_t.p") >= least, let(own, lambda o: F.when(F.size(o) >= least, windows(o))))

    least = min(math.ceil(share * len(t) - 1e-9) for _, _, t in known)
    hits = F.when(F.size("_t.p") >= least, F.filter(F.array(*[best(k, *t) for k, t in enumerate(known)]), lambda h: h.isNotNull()))
    texts = docs.select("doc_id", let(words, found).alias("_t"))
    return texts.select("doc_id", F.col("_t.n").alias("n_words"), F.coalesce(hits, F.array().cast("array<struct<licence:string,dice:double,template:int,start:int,stop:int>>")).alias("hits"))


def op8_licence_scan(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_hits"),
        F.array_join(F.sort_array(F.array_distinct(F.transform("hits", lambda h: h["licence"]))), ",").alias("licences"),
        F.coalesce(F.array_max(F.transform("hits", lambda h: h["dice"])), F.lit(0.0)).alias("best_dice"),
        F.coalesce(F.array_min(F.transform("hits", lambda h: h["start"])), F.lit(-1)).cast("long").alias("first_word"),
    )


def _sql() -> str:
    rows = ", ".join(f"({k}, '{name}', {n}, {b!r})" for k, (name, n, b) in enumerate(_templates(NOTICES)))
    return rf"""
WITH t(k, licence, tn, tb) AS (VALUES {rows}),
d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\pL\pN]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT r, unnest(range(len(w) - 1)) AS i, w FROM d WHERE len(w) > 1),
b AS (SELECT r, i, w[i + 1] || ' ' || w[i + 2] AS b FROM p),
o AS (SELECT k, unnest(tb) AS b FROM t),
h AS (SELECT DISTINCT r, k, i FROM b JOIN o USING (b)),
v AS (SELECT h.r, h.k, h.i, licence, tb, list_distinct(list_transform(range(i, least(i + tn, len(w)) - 1), lambda j: w[j + 1] || ' ' || w[j + 2])) AS a FROM h JOIN t USING (k) JOIN d USING (r)),
s AS (SELECT r, k, licence, max(2 * len(list_intersect(a, tb)) / (len(a) + len(tb))) AS dice, arg_max(i, (2 * len(list_intersect(a, tb)) / (len(a) + len(tb)), -i)) AS i FROM v GROUP BY ALL HAVING dice >= {THRESHOLD}),
x AS (SELECT r, count(*) AS n, string_agg(DISTINCT licence, ',' ORDER BY licence) AS ids, max(dice) AS best, min(i) AS place FROM s GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hits, coalesce(ids, '') AS licences, coalesce(best, 0)::DOUBLE AS best_dice, coalesce(place, -1)::BIGINT AS first_word
FROM d LEFT JOIN x USING (r)
"""


OP8_SQL = _sql()
