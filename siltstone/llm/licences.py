"""Licence scans by sparse TF-IDF cosine, with inheritance from the nearest directory (DataFrame functions only).

Of each text that speaks of a licence its header (the first terms, over line breaks and comment marks), of a licence file the whole
text, lines that speak, and windows of the text's terms around each word that does are compared to templates: notices and whole
licence texts. Terms are weighted by how rare they are among all files and lines of the corpus that speak, and the template
of the highest cosine names the licence. Windows run on over line breaks, so that a notice is found inside a longer line as well
as over several lines. A file without a licence of its own has that of the licence file in the nearest directory above it.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import Scratch, let

#: Notices of public licences (fixed values); several may name one licence.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, version 3 or later."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause Simplified License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0, the Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0, Creative Commons Attribution ShareAlike."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *((name, f"SPDX-License-Identifier: {name}") for name in ("Apache-2.0", "MIT", "BSD-3-Clause", "BSD-2-Clause", "MPL-2.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC0-1.0", "Unlicense")),
    *((name, f"SPDX-License-Identifier: {name}{end}") for name in ("GPL-3.0", "GPL-2.0", "LGPL-3.0", "AGPL-3.0") for end in ("", "-only", "-or-later")),
)
#: Whole texts, and long headers, of public licences (fixed values): headers, lines and licence files are compared to these too, windows to notices alone.
FULL_TEXTS = (
    (
        "MIT",
        "MIT License Copyright (c) Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "ISC License Copyright (c) Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in "
        "all copies. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY "
        "SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION "
        "WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "BSD-2-Clause",
        "BSD 2-Clause License Copyright (c) Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain "
        "the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.",
    ),
    (
        "BSD-3-Clause",
        "BSD 3-Clause License Copyright (c) Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain "
        "the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without "
        "specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.",
    ),
    (
        "Apache-2.0",
        "Copyright Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at Unless required by applicable law or agreed to "
        "in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
    ),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain.",
    ),
)
#: Terms of a text that are its header: of a few sentences, and of a whole notice with its conditions.
HEADERS = (80, 180)
#: What makes a line worth comparing.
SPEAKS = r"(?i)licen[sc]e|copyright|permission is hereby|public domain|redistribution|free software|\bCC[ -]BY\b|\bCC0\b|SPDX"
#: The same over line breaks and what a comment begins its lines with.
SPEAKS_OVER_LINES = SPEAKS.replace("CC[ -]BY", "CC BY").replace(" ", r"\W+")
#: File names whose licence is that of their directory.
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|notice|unlicense)(\..*)?$"
MIN_COSINE = 0.55
#: An SPDX tag is one term with the (first) identifier it gives, so that an unknown identifier resembles no template.
SPDX = r"(?i)spdx-license-identifier:[\s(]*"
#: Terms on each side of a speaking word; windows that fit a template are added to these.
RADII = (6, 12, 24)
#: Windows of fewer terms, which a few common words could fill, need a higher cosine.
SHORT, MIN_SHORT_COSINE = 12, 0.8
#: Marks the words that speak of a licence.
MARK = "\x01"
#: Licensed directories that may be broadcast.
BROADCAST_ROWS = 200_000


def terms(line: Column) -> Column:
    """Lower-cased runs of letters, digits and inner dots and hyphens."""
    return F.regexp_extract_all(F.lower(F.regexp_replace(line, SPDX, "SPDX-")), F.lit(r"([\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*)"), 1)


def marked_terms(text: Column) -> Column:
    """The terms of a text, with ``MARK`` in those where something that ``SPEAKS`` begins."""
    return F.split(F.regexp_replace(F.array_join(terms(text), " "), f"({SPEAKS})", f"{MARK}$1"), " ")


def _contexts(text: Column, before: int, after: int) -> Column:
    """Of each speaking word the terms before it and those from it on, as two strings, each pair once."""
    plain = lambda words: F.translate(F.array_join(words, " "), MARK, "")

    def of(words: Column) -> Column:
        at = F.filter(F.transform(words, lambda w, i: F.when(w.contains(MARK), i)), lambda i: i.isNotNull())
        return F.array_distinct(F.transform(at, lambda i: F.struct(plain(F.slice(words, F.greatest(i - before, F.lit(0)) + 1, F.least(i, F.lit(before)))).alias("left"), plain(F.slice(words, i + 1, F.lit(after + 1))).alias("right"))))

    return let(marked_terms(text), of)


def _best_window(spans: list[tuple[int, int]], named: list, idf: list, min_cosine: float) -> Column:
    """The best (-score, licence) of a context's windows, which have so many terms of (left, right) as each span says; null if none fits.

    All is computed within the row, for windows are short and nearly all different: ``named`` and ``idf`` go as one literal.
    """
    numbers = {r.term: k for k, r in enumerate(idf)}
    weights: dict[tuple, list] = {}
    for r in named:
        weights.setdefault((r.template, r.licence), [0.0] * len(idf))[numbers[r.term]] = r.tw
    model = {"terms": numbers, "idf": [r.idf for r in idf], "templates": [{"licence": name, "w": w} for (_, name), w in sorted(weights.items())]}
    model = F.from_json(F.lit(json.dumps(model)), "terms map<string,int>, idf array<double>, templates array<struct<licence:string,w:array<double>>>")

    def word(w: Column) -> Column:
        k = F.try_element_at(model["terms"], w)
        return F.struct(w.alias("w"), k.alias("k"), F.coalesce(F.get(model["idf"], k), F.lit(1.0)).alias("i"))

    def score(window: Column) -> Column:
        square = F.aggregate(window, F.lit(0.0), lambda s, x: s + x["i"] * x["i"] * F.size(F.filter(window, lambda y: y["w"] == x["w"])))
        enough = F.when(F.size(window) < SHORT, F.lit(max(MIN_SHORT_COSINE, min_cosine))).otherwise(F.lit(min_cosine))

        def over(v: Column) -> Column:
            dot = lambda t: F.aggregate(v["known"], F.lit(0.0), lambda s, x: s + x["i"] * F.get(t["w"], x["k"]))
            return F.array_min(F.transform(model["templates"], lambda t: F.struct((-F.round(dot(t) / v["norm"], 6)).alias("s"), t["licence"].alias("licence"))))

        best = let(F.struct(F.sqrt(square).alias("norm"), F.filter(window, lambda x: x["k"].isNotNull()).alias("known")), over)
        return let(best, lambda x: F.when(-x["s"] >= enough, x))

    side = lambda c: F.transform(F.array_remove(F.split(c, " "), ""), word)
    cut = lambda v: F.array(*[F.concat(F.slice(v["l"], F.greatest(F.size(v["l"]) - b, F.lit(0)) + 1, F.lit(b)), F.slice(v["r"], F.lit(1), F.lit(a + 1))) for b, a in spans])
    return F.array_min(F.transform(let(F.struct(side(F.col("left")).alias("l"), side(F.col("right")).alias("r")), cut), score))


def _weights(lines: DataFrame, key: list[str], idf: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, term, w), tf * idf of each term, and (key, norm), the length of its vector. Terms that no template has weigh 1."""
    each = lines.select(*key, F.explode("terms").alias("term")).groupBy(*key, "term").agg(F.count("*").alias("tf"))
    each = each.join(F.broadcast(idf), "term", "left").select(*key, "term", (F.col("tf") * F.coalesce("idf", F.lit(1.0))).alias("w"))
    norm = each.groupBy(*key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return each, norm


def own_licences(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", templates=TEMPLATES, min_cosine: float = MIN_COSINE, full_texts=FULL_TEXTS, is_file: Column | None = None) -> DataFrame:
    """(id, licence, score) of the documents with a header, line or window of terms (of licence files, as ``is_file`` says: or a whole text) that a template fits; ties go to the licence's name.

    A template that stands in a text word for word is found whatever surrounds it, for one of the windows is just as long.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    text = F.col(text_column)
    samples = F.array(*[F.struct(F.lit(k).alias("template"), F.lit(name).alias("licence"), F.lit(body).alias("line")) for k, (name, body) in enumerate([*templates, *full_texts])])
    samples = spark.range(1).select(F.explode(samples).alias("t")).select("t.template", "t.licence", terms(F.col("t.line")).alias("terms"), marked_terms(F.col("t.line")).alias("marked"))
    shapes = [(next((i for i, w in enumerate(r.marked) if MARK in w), None), len(r.marked)) for r in samples.collect()]
    short = range(len(templates))
    spans = sorted({(i, n - 1 - i) for i, n in shapes[: len(templates)] if i is not None} | {(n, n) for n in RADII})
    speaking = docs.where(F.col(id_column).isNotNull() & text.rlike(SPEAKS_OVER_LINES))
    around = _contexts(text, max(b for b, _ in spans), max(a for _, a in spans))
    some = lambda c, when: F.when(when, F.array(c)).otherwise(F.array().cast("array<string>"))
    headers = F.transform(F.array(*map(F.lit, HEADERS)), lambda n: F.array_join(F.slice(terms(text), F.lit(1), n), " "))
    whole = F.lit(False) if is_file is None else F.coalesce(is_file, F.lit(False))
    units = F.array_distinct(F.concat(F.filter(F.split(text, "\n"), lambda x: x.rlike(SPEAKS)), some(F.array_join(terms(text), " "), whole)))
    headers = F.array_except(F.filter(headers, lambda h: h.rlike(SPEAKS)), units)
    said = scratch.save(speaking.select(F.col(id_column).alias("id"), units.alias("lines"), headers.alias("headers"), around.alias("contexts")))
    # lines repeat a great deal: each different one is compared once, under a short name of its own
    # headers say once more what lines say, and don't count for the rarity of terms
    marked = F.concat(F.transform("lines", lambda x: F.struct(x.alias("line"), F.lit(1).alias("counts"))), F.transform("headers", lambda x: F.struct(x.alias("line"), F.lit(0).alias("counts"))))
    lines = said.select("id", F.explode(marked).alias("u")).select("id", F.md5("u.line").alias("unit"), "u.line", "u.counts")
    counted = scratch.save(lines.groupBy("unit").agg(F.sum("counts").alias("n"), F.min("line").alias("line")).select("unit", "n", terms(F.col("line")).alias("terms")))
    lines_in_all = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    known = samples.where(F.col("template").isin(*short)).select(F.explode("terms").alias("term")).distinct()
    prose = samples.select(F.explode("terms").alias("term")).distinct().join(F.broadcast(known), "term", "left_anti").select("term", F.lit(1.0).alias("idf"))
    df = counted.select("n", F.explode(F.array_distinct("terms")).alias("term")).join(F.broadcast(known), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
    rarity = F.log((1.0 + lines_in_all) / (1.0 + F.coalesce("df", F.lit(0)))) + 1.0
    # as many rows as the templates have terms; those that only whole texts have weigh as much as any other word
    idf = scratch.save(known.join(df, "term", "left").select("term", rarity.alias("idf")).unionAll(prose))
    t, t_norm = _weights(samples, ["template"], idf)
    named = t.join(t_norm, "template").join(samples.select("template", "licence"), "template").select("term", "template", "licence", (F.col("w") / F.col("norm")).alias("tw"))
    named = scratch.save(named)
    x, x_norm = _weights(counted, ["unit"], idf)
    dots = x.join(F.broadcast(named), "term").groupBy("unit", "template", "licence").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    scored = dots.join(x_norm, "unit").select("unit", "licence", F.round(F.col("dot") / F.col("norm"), 6).alias("score")).where(F.col("score") >= min_cosine)
    best = scored.groupBy("unit").agg(F.min(F.struct((-F.col("score")).alias("s"), "licence")).alias("b"))
    notices = named.where(F.col("template").isin(*short)).collect()
    windows = said.select("id", F.inline("contexts")).select("id", _best_window(spans, notices, idf.collect(), min_cosine).alias("b")).where("b is not null")
    fits = lines.select("id", "unit").join(best, "unit").select("id", "b").union(windows)
    per_doc = fits.groupBy("id").agg(F.min("b").alias("b"))
    return per_doc.select(F.col("id").alias(id_column), F.col("b.licence").alias("licence"), (-F.col("b.s")).alias("score"))


def licence_scan(docs: DataFrame, path: Column, id_column: str = "doc_id", text_column: str = "text", templates=TEMPLATES, min_cosine: float = MIN_COSINE) -> DataFrame:
    """(id, path, licence, score, origin, origin_dir) for each row of ``docs``; origin is own, inherited or null.

    ``path`` gives a file's path with ``/`` between directories; null counts as the empty path, which has no directory.
    Null and empty texts have no licence of their own. Repeated rows count each in the terms' rarity. Of several licence files in one directory the one with the
    best score counts, then the first name. Rows that share an id share its licence; rows without an id have only an inherited one.
    Other columns are not returned; an empty table gives an empty result. Very long texts are read whole.

    Texts are read once, in a narrow pass that keeps headers, licence files and lines that speak, and a bounded number of terms around each speaking word. Directories are made distinct before their ancestors (as
    many as a path is deep) are joined, so a directory's files cost it one row; files then join their own directory.
    """
    scratch = Scratch(docs.sparkSession)
    is_file = F.regexp_extract(path, "([^/]*)$", 1).rlike(LICENCE_FILE)
    own = scratch.save(own_licences(docs, id_column, text_column, templates, min_cosine, is_file=is_file).select(F.col(id_column).alias("id"), "licence", "score"))
    files = docs.select(F.col(id_column).alias("id"), F.coalesce(path, F.lit("")).alias("path"))
    files = files.select("id", "path", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("dir"), F.regexp_extract("path", "([^/]*)$", 1).alias("name"))
    marked = scratch.save(files.join(own, "id", "left"))
    licensed = marked.where(F.col("licence").isNotNull() & F.col("name").rlike(LICENCE_FILE)).groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("s"), "licence")).alias("d"))
    licensed = scratch.save(licensed.select(F.col("dir").alias("above"), F.col("d.licence").alias("theirs"), (-F.col("d.s")).alias("their_score")))
    if licensed.count() <= BROADCAST_ROWS:
        licensed = F.broadcast(licensed)
    parts = F.split("dir", "/")
    dirs = marked.select("dir").distinct().select("dir", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, 1, k), "/").alias("above")))).alias("a"))
    nearest = dirs.select("dir", "a.depth", "a.above").join(licensed, "above").groupBy("dir").agg(F.max(F.struct("depth", "above", "theirs", "their_score")).alias("near"))
    out = marked.join(nearest, "dir", "left")
    mine = F.col("licence").isNotNull()
    return out.select(
        F.col("id").alias(id_column), "path", F.coalesce("licence", "near.theirs").alias("licence"), F.coalesce("score", "near.their_score").alias("score"),
        F.when(mine, "own").when(F.col("near").isNotNull(), "inherited").alias("origin"), F.when(~mine, F.col("near.above")).alias("origin_dir"),
    )


def document_path(source: Column, doc_id: Column) -> Column:
    """The path that the table of documents stands for: one source is a tree of thousands, hundreds and tens.

    The first document of each ten, hundred and thousand is the licence file of that directory.
    """
    d = lambda n: F.floor(doc_id / n).cast("string")
    top = F.coalesce(source, F.lit(""))
    return (
        F.when(doc_id % 1000 == 0, F.concat_ws("/", top, d(1000), F.lit("LICENSE")))
        .when(doc_id % 100 == 0, F.concat_ws("/", top, d(1000), d(100), F.lit("LICENSE")))
        .when(doc_id % 10 == 0, F.concat_ws("/", top, d(1000), d(100), d(10), F.lit("LICENSE")))
        .otherwise(F.concat_ws("/", top, d(1000), d(100), d(10), F.concat(doc_id.cast("string"), F.lit(".txt"))))
    )
