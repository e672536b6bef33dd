"""Licence scans: Dice coefficient of word bigrams against licence templates.

A text's segments are its lines and, if it has several, the whole text. Segments are brought
to lower-case words; a segment of too few or too many bigrams for any template is passed over
by its word count alone, and the others meet only templates whose size lets the coefficient
reach the threshold. Everything is column expressions on the row itself.

Notices wrapped over lines or followed by other words are found in windows of the whole
normalised text, each of a template's length (shorter at the text's ends). A text is looked at
for a template only if it holds one of its anchors: the template's longest bigrams, so many of
them that no window can reach the threshold without one.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

#: The disclaimer that both BSD texts end with.
BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
    "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)

#: Licence names and the notices and texts that stand for them.
TEMPLATES = {
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version."
    ),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "BSD-2-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. " + BSD_DISCLAIMER
    ),
    "BSD-3-Clause": (
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."
    ),
    "BSD-3-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission. " + BSD_DISCLAIMER
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "LGPL-3.0-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 3 of the License, or (at "
        "your option) any later version."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:"
    ),
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS '
        "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def _in_order(text: str) -> list[str]:
    words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return [f"{a} {b}" for a, b in zip(words, words[1:])]


def bigrams_of(text: str) -> list[str]:
    """Distinct word bigrams of a template, as the column expressions make them."""
    return sorted(set(_in_order(text)))


def anchors_of(text: str, threshold: float) -> list[str]:
    """Bigrams of which every set within the threshold holds one.

    A set within the threshold shares t/(2-t) of the template's bigrams at least, so it holds
    one of any that are more than the others. Long bigrams are taken, as they are rare.
    """
    t = Fraction(str(threshold))
    grams = bigrams_of(text)
    spare = len(grams) - math.ceil(len(grams) * t / (2 - t))
    return sorted(grams, key=lambda g: (-len(g), g))[: spare + 1]


def size_bounds(size: int, threshold: float) -> tuple[int, int]:
    """Sizes whose coefficient with a set of ``size`` can reach the threshold, in exact fractions."""
    t = Fraction(str(threshold))
    return math.ceil(size * t / (2 - t)), math.floor(size * (2 - t) / t)


def _words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")), " ")


def _bigrams(words: Column) -> Column:
    pairs = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1))),
        lambda i: F.concat_ws(" ", F.get(words, i - 1), F.get(words, i)),
    )
    return F.array_distinct(F.when(F.size(words) > 1, pairs).otherwise(F.array().cast("array<string>")))


def _marks(templates: dict[str, str], threshold: float) -> list[str]:
    """The longer words of all anchors: a text without any of them has no window to compare."""
    return sorted({max(g.split(), key=len) for text in templates.values() for g in anchors_of(text, threshold)})


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _best_window(grams: Column, template: str, threshold: float) -> Column:
    """(minus, word) of the best window over the threshold, of equal ones the first; or null.

    A text without an anchor has none. A window over the threshold shares ``least`` bigrams
    with the template, so only windows over as many of their places are compared.
    """
    own, length = bigrams_of(template), len(_in_order(template))
    t = Fraction(str(threshold))
    least = math.ceil(len(own) * t / (2 - t))
    anchors = F.array(*map(F.lit, anchors_of(template, threshold)))
    spots = F.filter(F.transform(grams, lambda g, i: F.when(g.isin(own), i)), lambda i: i.isNotNull())

    def starts(at: Column) -> Column:
        last = lambda p, k: F.get(at, k + least - 1)
        runs = F.filter(F.transform(at, lambda p, k: F.struct(p.alias("a"), last(p, k).alias("z"))),
                        lambda r: r["z"] - r["a"] < length)
        return F.array_distinct(F.flatten(F.transform(runs, lambda r: F.sequence(r["z"] - length + 1, r["a"]))))

    def shared(start: Column) -> Column:
        first = F.greatest(start, F.lit(0))
        return _let(F.array_distinct(F.slice(grams, first + 1, start + length - first)), lambda w: F.struct(
            (-2.0 * F.size(F.array_intersect(w, F.array(*map(F.lit, own)))) / (F.size(w) + len(own))).alias("minus"),
            (first + 1).alias("word"),
        ))

    near = F.filter(F.transform(_let(spots, starts), shared), lambda c: c["minus"] <= -threshold)
    return F.when(F.arrays_overlap(grams, anchors), F.array_min(near))


def _windows(grams: Column, templates: dict[str, str], threshold: float) -> Column:
    """Best window over the threshold of every template, in a text's bigrams in order."""
    found = F.array(*[
        F.struct(F.lit(name).alias("licence"), _best_window(grams, templates[name], threshold).alias("top"))
        for name in sorted(templates)
    ])
    return F.transform(F.filter(found, lambda f: f["top"].isNotNull()), lambda f: F.struct(
        f["licence"].alias("licence"), f["top"]["word"].alias("word"), (-f["top"]["minus"]).alias("dice")
    ))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, matches array<struct<segment, licence, dice>>, windows array<struct<licence, word,
    dice>> for every row of ``docs``.

    windows holds the best window over the threshold of every licence, sorted by licence; word
    counts the normalised text's words from 1, of equally good windows the first is taken.

    segment counts a text's lines from 1; 0 is the whole of a text with several lines. A
    segment keeps its best template, of equal ones the first by name. Null and empty texts
    match nothing. Repeated rows each give theirs. Other columns of ``docs`` are not read.
    """
    sets = {name: bigrams_of(text) for name, text in sorted(templates.items())}
    bounds = {name: size_bounds(len(s), threshold) for name, s in sets.items()}
    # A segment's words bound its distinct bigrams from above; repeats may only lower them.
    fewest = min(lo for lo, _ in bounds.values())
    table = F.array(*[
        F.struct(
            F.lit(name).alias("licence"),
            F.array(*map(F.lit, s)).alias("grams"),
            F.lit(bounds[name][0]).alias("lo"),
            F.lit(bounds[name][1]).alias("hi"),
        )
        for name, s in sets.items()
    ])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("_text"))
    rows = rows.select("doc_id", "_text", _words(F.col("_text")).alias("_w"))
    # Texts without a mark keep no bigrams, so their windows cost nothing.
    marked = F.arrays_overlap("_w", F.array(*map(F.lit, _marks(templates, threshold))))
    pairs = F.transform("_w", lambda w, i: F.concat_ws(" ", w, F.get(F.col("_w"), i + 1)))
    grams = F.when(marked & (F.size("_w") > 1), F.slice(pairs, 1, F.size("_w") - 1)).otherwise(F.array().cast("array<string>"))
    rows = rows.select("doc_id", "_text", grams.alias("_g"))
    rows = rows.select("doc_id", "_text", _windows(F.col("_g"), templates, threshold).alias("windows"))
    lines = F.transform(F.split("_text", "\n"), lambda l, i: F.struct((i + 1).alias("segment"), l.alias("body")))
    whole = F.when(F.col("_text").contains("\n"), F.array(F.struct(F.lit(0).alias("segment"), F.col("_text").alias("body"))))
    rows = rows.select("doc_id", "windows", F.concat(F.coalesce(whole, F.array().cast("array<struct<segment: int, body: string>>")), lines).alias("_s"))
    words = F.transform("_s", lambda s: F.struct(s["segment"].alias("segment"), _words(s["body"]).alias("words")))
    rows = rows.select("doc_id", "windows", F.filter(words, lambda s: F.size(s["words"]) > fewest).alias("_s"))
    rows = rows.select("doc_id", "windows", F.transform("_s", lambda s: F.struct(
        s["segment"].alias("segment"), _bigrams(s["words"]).alias("grams")
    )).alias("_s"))

    def best(s: Column) -> Column:
        n = F.size(s["grams"])
        fit = F.filter("_t", lambda t: n.between(t["lo"], t["hi"]))
        scored = F.transform(fit, lambda t: F.struct(
            (-2.0 * F.size(F.array_intersect(s["grams"], t["grams"])) / (n + F.size(t["grams"]))).alias("minus"),
            t["licence"].alias("licence"),
        ))
        return F.struct(s["segment"].alias("segment"), F.array_min(scored).alias("top"))

    rows = rows.select("doc_id", "windows", "_s", table.alias("_t"))
    top = F.filter(F.transform("_s", best), lambda m: F.coalesce(m["top"]["minus"] <= -threshold, F.lit(False)))
    shaped = F.transform(top, lambda m: F.struct(
        m["segment"].alias("segment"), m["top"]["licence"].alias("licence"), (-m["top"]["minus"]).alias("dice")
    ))
    return rows.select("doc_id", shaped.alias("matches"), "windows")


def report(found: DataFrame) -> DataFrame:
    """One row per document: matches as segment:licence, windows as licence:word, best coefficients."""
    return found.select(
        "doc_id",
        F.size("matches").cast("long").alias("n_matches"),
        F.array_join(
            F.transform("matches", lambda m: F.concat_ws(":", m["segment"].cast("string"), m["licence"])), ","
        ).alias("licences"),
        F.round(F.coalesce(F.array_max(F.transform("matches", lambda m: m["dice"])), F.lit(0.0)), 6).alias("best_dice"),
        F.size("windows").cast("long").alias("n_windows"),
        F.array_join(
            F.transform("windows", lambda m: F.concat_ws(":", m["licence"], m["word"].cast("string"))), ","
        ).alias("window_licences"),
        F.round(F.coalesce(F.array_max(F.transform("windows", lambda m: m["dice"])), F.lit(0.0)), 6).alias("best_window_dice"),
    )
