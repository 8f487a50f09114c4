"""Licences of files: sparse TF-IDF cosine of lines and windows to templates, then inheritance from directories.

Every line of a file, and every two lines in a row, are compared with short licence statements. Headers and
whole licences are longer templates: they are compared with windows of their own length over all of the text,
an eighth of the length apart, and wherever their first term stands, whatever lines the text has. A file whose name, or title, says that it is a licence
file speaks for its directory; a file without a statement of its own takes the licence of the nearest directory
above it that has one.

Only DataFrame functions are used. What cannot reach the threshold is skipped without being compared: the
cosine of a piece with a template is at most the share of the template's length that their common terms have,
so a line needs at least one of the terms without which no template is covered far enough, and a text, then
two stretches of the template's length in a row, need terms that cover it far enough.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linkgraph.session import scratch_path, written

THRESHOLD = 0.7
LONGEST_LINE = 24  # terms of a template that is compared with lines; longer ones are compared with windows
STEPS = 8  # windows that begin within the length of one
FEW_TERMS = 200_000  # weights of terms that may be broadcast
FEW_DIRECTORIES = 200_000  # rows of a directory and a licence that may be broadcast

# Statements by licence identifier, then headers, then whole licences.
TEMPLATES: dict[str, list[str]] = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license.", "SPDX-License-Identifier: MIT",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0",
                   "Apache License Version 2.0, January 2004"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "SPDX-License-Identifier: GPL-3.0-or-later", "GNU General Public License Version 3, 29 June 2007"],
    "GPL-2.0": ["This program is licensed under the GNU General Public License, version 2.",
                "SPDX-License-Identifier: GPL-2.0-only", "GNU General Public License Version 2, June 1991"],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3.",
                 "SPDX-License-Identifier: LGPL-3.0-or-later",
                 "GNU Lesser General Public License Version 3, 29 June 2007"],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3.",
                 "SPDX-License-Identifier: AGPL-3.0-or-later",
                 "GNU Affero General Public License Version 3, 19 November 2007"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-2-Clause"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "SPDX-License-Identifier: MPL-2.0"],
    "ISC": ["Licensed under the ISC License.", "SPDX-License-Identifier: ISC"],
    "Unlicense": ["This is free and unencumbered software released into the public domain.",
                  "SPDX-License-Identifier: Unlicense"],
    "CC0-1.0": ["Released under CC0 1.0 Universal.", "SPDX-License-Identifier: CC0-1.0"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "SPDX-License-Identifier: CC-BY-4.0"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0.", "SPDX-License-Identifier: CC-BY-ND-4.0"],
}
_GNU_HEADER = (
    "{0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1}General Public "
    "License as published by the Free Software Foundation, either version {2} of the License, or (at your option) any "
    "later version. {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
    "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1}General Public License "
    "for more details. You should have received a copy of the GNU {1}General Public License along with this program. "
    "If not, see <https://www.gnu.org/licenses/>.")
_CC_HEADER = (
    "This work is licensed under the Creative Commons {0} 4.0 International License. To view a copy of this license, "
    "visit http://creativecommons.org/licenses/{1}/4.0/ or send a letter to Creative Commons, PO Box 1866, Mountain "
    "View, CA 94042, USA.")
for _name, _lesser, _version in (("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.1", "Lesser ", "2.1"),
                                 ("LGPL-3.0", "Lesser ", "3"), ("AGPL-3.0", "Affero ", "3")):
    _header = _GNU_HEADER.format("This program", _lesser, _version)
    TEMPLATES.setdefault(_name, []).extend([_header[:_header.index(" This program is distributed")], _header])
for _name, _kind in (("CC-BY-4.0", "Attribution"), ("CC-BY-SA-4.0", "Attribution-ShareAlike"),
                     ("CC-BY-NC-4.0", "Attribution-NonCommercial"), ("CC-BY-ND-4.0", "Attribution-NoDerivatives")):
    TEMPLATES[_name].append(_CC_HEADER.format(_kind, _name[3:-4].lower()))
TEMPLATES["MPL-2.0"].append(
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.")
TEMPLATES["Apache-2.0"].append(
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
    "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
    "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
    "specific language governing permissions and limitations under the License.")
TEMPLATES["MIT"].append(
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions:")
for _path in sorted((Path(__file__).parent / "licence_texts").glob("*.txt")):
    TEMPLATES.setdefault(_path.stem, []).append(_path.read_text(encoding="utf-8"))
LICENCE_NAME = r"(?i)(^|/)(un)?(licen[cs]e|copying|copyright|notice)[^/]*$"


def terms_of(text: Column) -> Column:
    """Runs of ASCII letters and digits, in lower case."""
    return F.array_remove(F.split(F.lower(text), "[^a-z0-9]+"), "")


def template_terms(spark: SparkSession, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """``template``, ``licence``, ``size`` (terms in all), ``head`` (the first one), ``term``, ``times``: a few thousand rows."""
    rows = [(f"{name} {i}", name, text) for name, texts in templates.items() for i, text in enumerate(texts)]
    table = spark.createDataFrame(rows, "template string, licence string, text string")
    words = terms_of(F.col("text"))
    return (table.select("template", "licence", F.size(words).alias("size"), words[0].alias("head"),
                         F.explode(words).alias("term"))
            .groupBy("template", "licence", "size", "head", "term").agg(F.count("*").alias("times")))


def file_counts(files: DataFrame) -> DataFrame:
    """``term``, ``n``: in how many files every term occurs."""
    return (files.select(F.explode(F.array_distinct(terms_of(F.col("text")))).alias("term"))
            .groupBy("term").agg(F.count("*").alias("n")))


def weighed(terms: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """``term``, ``idf`` of the distinct ``term`` of ``terms``: ln((1 + files) / (1 + files with the term)) + 1."""
    share = F.lit(1.0 + total) / (1 + F.coalesce("n", F.lit(0)))
    return terms.select("term").distinct().join(counts, "term", "left").select("term", (F.log(share) + 1).alias("idf"))


def telling_terms(templates: list, weights: dict[str, float], threshold: float) -> list[str]:
    """Terms of which a line must have one to reach the threshold with any template.

    The commonest terms are left out as long as the part of every template that they make up stays too short.
    """
    vectors: dict[str, dict[str, float]] = {}
    for row in templates:
        vectors.setdefault(row["template"], {})[row["term"]] = row["times"] * weights[row["term"]]
    squares = {name: sum(v * v for v in vector.values()) for name, vector in vectors.items()}
    holders: dict[str, list[str]] = {}
    for name, vector in vectors.items():
        for term in vector:
            holders.setdefault(term, []).append(name)
    common: set[str] = set()
    covered = dict.fromkeys(vectors, 0.0)
    for term in sorted(weights, key=lambda t: (weights[t], t)):
        trial = {name: covered[name] + vectors[name][term] ** 2 for name in holders.get(term, [])}
        if all(square < 0.999 * threshold ** 2 * squares[name] for name, square in trial.items()):
            common.add(term)
            covered.update(trial)
    return sorted(set(weights) - common)


def directory(path: Column) -> Column:
    """What stands before the last slash; empty for a path without one."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def ancestors(folder: Column) -> Column:
    """A directory and all above it, as structs of ``folder`` and ``depth``; the root is the empty path."""
    parts = F.split(folder, "/")
    depth = F.when(folder == "", 0).otherwise(F.size(parts))
    return F.transform(F.sequence(F.lit(0), depth), lambda i: F.struct(
        F.concat_ws("/", F.slice(parts, 1, i)).alias("folder"), i.alias("depth")))


def line_terms(files: DataFrame, telling: list[str]) -> DataFrame:
    """``file``, ``at``, ``in_title``, ``term``, ``line_times`` of lines, of two lines in a row, and of titles."""
    pattern = r"(^|[^a-z0-9])(" + "|".join(telling) + r")($|[^a-z0-9])"
    worded = F.filter(F.split(F.lower("text"), "\n"), lambda line: line.rlike("[a-z0-9]"))
    lines = F.when(F.lower("text").rlike(pattern), worded)
    texts = files.select("file", "title", lines.alias("lines"))
    pairs = F.zip_with(F.col("lines"), F.slice("lines", 2, F.greatest(F.size("lines"), F.lit(0))),
                       lambda one, two: F.concat_ws("\n", one, two))
    found = F.filter(F.concat("lines", pairs), lambda line: line.rlike(pattern))
    title = F.filter(F.array(F.lower("title")), lambda line: line.rlike(pattern))
    marked = F.concat(
        F.transform(F.coalesce(found, F.array().cast("array<string>")),
                    lambda s: F.struct(s.alias("line"), F.lit(False).alias("in_title"))),
        F.transform(title, lambda s: F.struct(s.alias("line"), F.lit(True).alias("in_title"))))
    candidates = (texts.select("file", F.posexplode(marked).alias("at", "one"))
                  .select("file", "at", "one.in_title", F.explode(terms_of(F.col("one.line"))).alias("term")))
    return candidates.groupBy("file", "at", "in_title", "term").agg(F.count("*").alias("line_times"))


def window_terms(files: DataFrame, weighted: DataFrame, telling: list[str], threshold: float) -> DataFrame:
    """``file``, ``template``, ``at``, ``in_title``, ``term``, ``line_times`` of windows over whole texts.

    A window is as long as its template and begins a multiple of an eighth of that length into the text, or where
    the text has the template's first term, so that an exact copy meets a window that holds just it.
    ``weighted`` has the long templates. A window lies within two stretches of the template's length; only those
    are cut into windows whose terms cover the template far enough.
    """
    spark = files.sparkSession
    enough = F.sum(F.col("value") ** 2) >= 0.999 * threshold ** 2 * F.first("template_length") ** 2
    texts = files.select("file", terms_of(F.col("text")).alias("words")).where(
        F.arrays_overlap("words", F.split(F.lit(" ".join(telling)), " ")))
    table = F.broadcast(weighted.select("template", "size", "head", "term", "value", "template_length"))
    pairs = written(texts.select("file", F.explode(F.array_distinct("words")).alias("term")).join(table, "term")
                    .groupBy("file", "template", "size", "head").agg(enough.alias("enough")).where("enough").drop("enough"),
                    scratch_path(spark, "near"))
    places = (texts.join(pairs, "file").select("file", "template", "size", "head", F.posexplode("words").alias("place", "term"))
              .join(table.drop("size", "head"), ["template", "term"])
              .withColumn("first", F.explode(F.array(F.floor(F.col("place") / F.col("size")) - 1,
                                                     F.floor(F.col("place") / F.col("size")))))
              .where("first >= 0").groupBy("file", "template", "size", "head", "first", "term")
              .agg(F.first("value").alias("value"), F.first("template_length").alias("template_length")))
    spots = written(places.groupBy("file", "template", "size", "head", "first").agg(enough.alias("enough"))
                    .where("enough").drop("enough"), scratch_path(spark, "spots"))
    begin = F.col("first") * F.col("size")
    stretch = F.slice("words", (begin + 1).cast("int"), F.col("size"))
    steps = F.greatest(F.floor(F.col("size") / STEPS), F.lit(1))
    places = F.transform(stretch, lambda word, i: F.when((word == F.col("head")) | (i % steps == 0), begin + i))
    starts = F.filter(places, lambda at: at.isNotNull())
    return (texts.join(spots, "file").select("file", "template", "size", "words", F.explode(starts).alias("at"))
            .select("file", "template", "at", F.explode(F.slice(
                "words", (F.col("at") + 1).cast("int"), F.col("size"))).alias("term"))
            .groupBy("file", "template", "at", F.lit(False).alias("in_title"), "term")
            .agg(F.count("*").alias("line_times")))


def cosines(counted: DataFrame, weighted: DataFrame, keys: list[str], on: list[str]) -> DataFrame:
    """``file``, ``licence``, ``cosine``, ``in_title``: pieces, named by ``keys``, with the templates they meet ``on``."""
    length = counted.groupBy(keys).agg(F.sqrt(F.sum((F.col("line_times") * F.col("idf")) ** 2)).alias("line_length"))
    products = (counted.drop("idf").join(F.broadcast(weighted), on)
                .groupBy(*{*keys, "file", "in_title", "licence", "template"})
                .agg(F.sum(F.col("line_times") * F.col("idf") * F.col("value")).alias("product"),
                     F.first("template_length").alias("template_length")))
    return products.join(length, keys).select("file", "licence", F.round(
        F.col("product") / (F.col("line_length") * F.col("template_length")), 9).alias("cosine"), "in_title")


def own_licences(files: DataFrame, threshold: float = THRESHOLD,
                 templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """``file``, ``licence``, ``cosine``, ``in_title``: the best statement of every file that has one.

    ``files`` has ``file`` (a unique key), ``text`` and ``title``. Ties go to the first licence by name.
    """
    spark = files.sparkSession
    known = written(template_terms(spark, templates), scratch_path(spark, "templates"))
    counts, total = written(file_counts(files), scratch_path(spark, "counts")), files.count()
    weight_table = written(weighed(known, counts, total), scratch_path(spark, "weights"))
    weights = weight_table.collect()
    weighted = known.join(F.broadcast(weight_table), "term").withColumn("value", F.col("times") * F.col("idf"))
    lengths = weighted.groupBy("template").agg(F.sqrt(F.sum(F.col("value") ** 2)).alias("template_length"))
    weighted = written(weighted.join(F.broadcast(lengths), "template"), scratch_path(spark, "weighted"))
    found = []
    for long in (False, True):
        some = weighted.where((F.col("size") > LONGEST_LINE) == long)
        rows = some.collect()
        if not rows:
            continue
        telling = telling_terms(rows, {t: w for t, w in weights if t in {row["term"] for row in rows}}, threshold)
        counted = window_terms(files, some, telling, threshold) if long else line_terms(files, telling)
        counted = written(counted, scratch_path(spark, "windows" if long else "lines"))
        own = written(weighed(counted, counts, total), scratch_path(spark, "weights"))
        idf = counted.join(F.broadcast(own) if own.limit(FEW_TERMS + 1).count() <= FEW_TERMS else own, "term")
        keys, on = (["file", "template", "at"], ["template", "term"]) if long else (["file", "at"], ["term"])
        found.append(cosines(idf, some, keys, on))
    scored = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    best = F.struct((-F.col("cosine")).alias("less"), "licence")
    return (scored.where(F.col("cosine") >= threshold).groupBy("file").agg(
        F.min(best).alias("best"), F.max("in_title").alias("in_title"))
        .select("file", "best.licence", (-F.col("best.less")).alias("cosine"), "in_title"))


def scan_licences(files: DataFrame, threshold: float = THRESHOLD,
                  templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """``file``, ``path``, ``licence``, ``cosine``, ``origin`` for every row of ``files``.

    ``files`` has ``file`` (a unique key), ``path``, ``text`` and ``title`` (what names the file's content, may
    be null). ``origin`` is "own", "inherited" or null, and the licence null where none is found. A directory
    with several licence files has the licence that most of them have, the first by name among equals. Null
    and empty texts have no statement of their own; a null path has no directory to inherit from. Equal paths
    are different files. An empty table gives no rows.
    """
    spark = files.sparkSession
    own = written(own_licences(files, threshold, templates), scratch_path(spark, "own"))
    placed = files.select("file", "path").join(own, "file", "left")
    says = placed.where(F.col("licence").isNotNull() & F.col("path").isNotNull()
                        & (F.col("in_title") | F.col("path").rlike(LICENCE_NAME)))
    votes = says.groupBy(directory(F.col("path")).alias("folder"), "licence").count()
    of_folder = votes.groupBy("folder").agg(
        F.min(F.struct((-F.col("count")).alias("less"), "licence")).getField("licence").alias("inherited"))
    if of_folder.limit(FEW_DIRECTORIES + 1).count() <= FEW_DIRECTORIES:
        of_folder = F.broadcast(of_folder)
    bare = placed.where(F.col("licence").isNull() & F.col("path").isNotNull())
    nearest = (bare.select("file", F.explode(ancestors(directory(F.col("path")))).alias("above"))
               .select("file", "above.folder", "above.depth").join(of_folder, "folder")
               .groupBy("file").agg(F.max_by("inherited", "depth").alias("inherited")))
    return placed.join(nearest, "file", "left").select(
        "file", "path", F.coalesce("licence", "inherited").alias("licence"), "cosine",
        F.when(F.col("licence").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited").alias("origin"))


def corpus_files(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """Documents and web pages as files: documents lie in a folder of their source, pages under host and path.

    Markup of a page becomes line breaks, its title is the file's title.
    """
    docs = documents.select(
        F.struct(F.lit("documents").alias("kind"), F.col("doc_id").alias("id")).alias("file"),
        F.concat_ws("/", F.lit("documents"), F.coalesce("source", F.lit("-")),
                    F.col("doc_id").cast("string")).alias("path"),
        "text", F.lit(None).cast("string").alias("title"))
    bare = F.regexp_replace(F.regexp_replace("url", r"^[a-z]+://", ""), r"[?#].*$", "")
    web = pages.select(
        F.struct(F.lit("pages").alias("kind"), F.col("page_id").alias("id")).alias("file"),
        F.concat_ws("/", F.lit("pages"), F.regexp_replace(bare, "/+$", "")).alias("path"),
        F.regexp_replace("html", "<[^>]*>", "\n").alias("text"),
        F.nullif(F.regexp_extract("html", r"(?i)<title>([^<]*)</title>", 1), F.lit("")).alias("title"))
    return docs.unionByName(web)
