"""Licences of files: TF-IDF cosine to licence texts and notices, and inheritance from directories.

Whole files and their headers (runs of neighbouring lines) are compared with whole licence texts, single lines with
notices; a cosine that reaches a threshold carries the licence.  A file near a licence text as a whole, or mostly
of notices, is a licence file, and files without a licence of their own take that of the licence file in the nearest
directory above them.  All steps are DataFrame operations: terms, weights and paths are joined as rows.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from importlib.resources import files

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opslens.llm.common import WORD, stage

#: Notices of public licences.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("all-rights-reserved", "All rights reserved."),
]

#: Notices of licences that are near one of the above in words.
NEIGHBOURS = [
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("ISC", "Released under the ISC License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
]

_GNU = """This {0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1} as published by
the Free Software Foundation; either version {2} of the License, or (at your option) any later version.
This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} for more details.
You should have received a copy of the GNU {1} along with this {0}. If not, see <https://www.gnu.org/licenses/>."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License."""
#: Whole licence texts, and the headers that licences ask for.
TEXTS = sorted(
    (p.name.removesuffix(".txt"), p.read_text(encoding="utf-8"))
    for p in files("opslens.llm").joinpath("licence_texts").iterdir()
    if p.name.endswith(".txt")
)
if not TEXTS:
    raise FileNotFoundError("the licence texts are not installed with the library")
TEXTS += [
    ("Apache-2.0", _APACHE),
    ("AGPL-3.0", _GNU.format("program", "Affero General Public License", "3")),
    ("GPL-2.0", _GNU.format("program", "General Public License", "2")),
    ("GPL-3.0", _GNU.format("program", "General Public License", "3")),
    ("LGPL-2.1", _GNU.format("library", "Lesser General Public License", "2.1")),
    ("LGPL-3.0", _GNU.format("library", "Lesser General Public License", "3")),
]

#: Least cosine of a file, header or line, and least share of a file's words in such lines for a licence file.
THRESHOLD = 0.6
FILE_SHARE = 0.5
#: A term: letters and digits, version numbers whole.
TERM = r"[a-z0-9]+(?:\.[0-9]+)*"


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def _vocabulary(templates: list[tuple[str, str]]) -> list[list[str]]:
    return [re.findall(TERM, text.lower()) for _, text in templates]


def document_frequencies(texts: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Number of texts, and of those that hold each term of the (bounded) vocabulary."""
    held = F.array_intersect(terms(F.coalesce("text", F.lit(""))), F.array(*[F.lit(t) for t in vocabulary]))
    # Every text counts under an empty term too: one pass gives all numbers.
    rows = texts.select(F.explode(F.concat(F.array(F.lit("")), held)).alias("term")).groupBy("term").count().collect()
    counts = {r["term"]: r["count"] for r in rows}
    return counts.pop("", 0), counts


def weigh(n: int, found: int) -> float:
    """Inverse document frequency."""
    return math.log((1 + n) / (1 + found)) + 1


def anchors(templates: list[list[str]], idf: dict[str, float], threshold: float) -> list[str]:
    """Terms of which a line must hold one to reach the threshold with any template.

    Without a template's heaviest terms a line's cosine is at most the length of the template's other part over its
    whole length (Cauchy-Schwarz); terms join until that is below the threshold.
    """
    out = set()
    for words in templates:
        squares = {t: (words.count(t) * idf[t]) ** 2 for t in words}
        whole = rest = sum(squares.values())
        for t in sorted(squares, key=lambda t: (-squares[t], t)):
            if math.sqrt(max(rest, 0.0) / whole) < threshold - 1e-9:
                break
            out.add(t)
            rest -= squares[t]
    return sorted(out)


def scored_lines(lines: DataFrame, templates: list[tuple[str, str]], idf: dict[str, float], threshold: float) -> DataFrame:
    """``line``, ``licence`` and ``score`` of distinct lines that reach the threshold; ties go to the first name.

    A term outside the templates weighs 1 an occurrence, as one that every text holds.
    """
    spark = lines.sparkSession
    vocabulary = _vocabulary(templates)
    weights = spark.createDataFrame(list(idf.items()), "term string, idf double")
    entries, lengths = [], []
    for k, ((name, _), words) in enumerate(zip(templates, vocabulary, strict=True)):
        entries += [(k, name, t, words.count(t) * idf[t]) for t in sorted(set(words))]
        lengths.append((k, math.sqrt(sum((words.count(t) * idf[t]) ** 2 for t in sorted(set(words))))))
    entry = spark.createDataFrame(entries, "template int, licence string, term string, weight double")
    length = spark.createDataFrame(lengths, "template int, length double")
    counts = lines.select("line", F.explode(terms(F.col("line"))).alias("term")).groupBy("line", "term").agg(F.count(F.lit(1)).alias("n"))
    # The broadcast tables have a row per term of the templates.
    vector = counts.join(F.broadcast(weights), "term", "left").select("line", "term", (F.col("n") * F.coalesce("idf", F.lit(1.0))).alias("x"))
    vector = stage(vector, "line-vectors")
    norms = vector.groupBy("line").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dots = vector.join(F.broadcast(entry), "term").groupBy("line", "template", "licence").agg(F.sum(F.col("x") * F.col("weight")).alias("dot"))
    cosine = dots.join(norms, "line").join(F.broadcast(length), "template")
    cosine = cosine.select("line", "licence", F.round(F.col("dot") / (F.col("norm") * F.col("length")), 6).alias("score"))
    best = cosine.filter(F.col("score") >= threshold).groupBy("line").agg(F.min(F.struct((-F.col("score")).alias("s"), "licence")).alias("best"))
    return best.select("line", "best.licence", (-F.col("best.s")).alias("score"))


def _damped(count: int, idf: float) -> float:
    return (1 + math.log(count)) * idf


def heavy_terms(words: list[str], idf: dict[str, float], threshold: float) -> tuple[list[str], int]:
    """Heavy terms of a text, and how many of them whatever reaches the threshold with it must hold.

    The cosine's square is at most the share of the text's squared weights whose terms are held (Cauchy-Schwarz).  Light
    terms have half of the needed share at most, so heavy ones must make the other half.
    """
    squares = {t: _damped(words.count(t), idf[t]) ** 2 for t in set(words)}
    half = threshold**2 * sum(squares.values()) / 2
    order = sorted(squares, key=lambda t: (squares[t], t))
    light = 0.0
    while order and light + squares[order[0]] <= half:
        light += squares[order.pop(0)]
    most, got = 0, 0.0
    while got < half * (1 - 1e-9) and most < len(order):
        most += 1
        got += squares[order[-most]]
    return order, most


def scored_texts(rows: DataFrame, texts: list[tuple[str, str]], idf: dict[str, float], n: int, threshold: float) -> DataFrame:
    """``version``, ``licence``, ``score`` and ``whole`` of texts (version, text) near a licence text; whole is the cosine
    of the text as a whole, null if only a header of it reaches the threshold.

    A header is a run of neighbouring lines, blank ones aside, that have at least half of their terms from the licence text.
    Repeated terms count by the logarithm; a term of no licence text weighs as one of a single text.
    """
    spark = rows.sparkSession
    vocabulary = _vocabulary(texts)
    heavy = [heavy_terms(words, idf, threshold) for words in vocabulary]
    listed = lambda held: F.split(F.lit(" ".join(sorted(held))), " ")
    near = lambda held: F.array_compact(
        F.array(*[F.when(F.size(F.array_intersect(held, listed(h))) >= m, F.lit(k)) for k, (h, m) in enumerate(heavy)])
    )
    held = F.array_intersect(terms(F.col("text")), listed(set().union(*[h for h, _ in heavy])))
    # Through an array of one, so that the terms are found once a text.
    some = rows.select("version", "text", F.explode(F.flatten(F.transform(F.array(held), near))).alias("template"))
    # Equal texts are one text here.
    some = stage(some.groupBy("version", "template").agg(F.any_value("text").alias("text")), "near-texts")

    lengths, entries, names = [], [], []
    for k, ((name, _), words) in enumerate(zip(texts, vocabulary, strict=True)):
        weights = {t: _damped(words.count(t), idf[t]) for t in sorted(set(words))}
        entries += [(k, t, x) for t, x in weights.items()]
        lengths.append(math.sqrt(sum(x * x for x in weights.values())))
        names.append((k, name, lengths[-1], sorted(weights)))
    # The broadcast tables have a row per term of the licence texts.
    template = F.broadcast(spark.createDataFrame(names, "template int, licence string, length double, own array<string>"))
    entry = F.broadcast(spark.createDataFrame(entries, "template int, term string, weight double"))
    used = sorted(set().union(*vocabulary))
    weight = F.broadcast(spark.createDataFrame([(t, idf[t]) for t in used], "term string, idf double"))

    lines = F.filter(F.transform(F.split("text", "\n"), terms), lambda t: F.size(t) > 0)
    lines = some.join(template, "template").select("version", "template", "own", F.posexplode(lines).alias("at", "found"))
    like = F.size(F.array_intersect("found", "own")) * 2 >= F.size(F.array_distinct("found"))
    lines = stage(lines.select("version", "template", "at", "found", like.alias("like")), "near-lines")
    order = Window.partitionBy("version", "template").orderBy("at")
    runs = lines.filter("like").select("version", "template", (F.col("at") - F.row_number().over(order)).alias("run"), "found")
    units = runs.unionByName(lines.select("version", "template", F.lit(None).cast("int").alias("run"), "found"))
    counts = units.select("version", "template", "run", F.explode("found").alias("term")).groupBy("version", "template", "run", "term").count()
    x = (1 + F.log("count")) * F.coalesce("idf", F.lit(weigh(n, 1)))
    vector = counts.join(weight, "term", "left").join(entry, ["template", "term"], "left").withColumn("x", x)
    sums = vector.groupBy("version", "template", "run").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"), F.sum(F.col("x") * F.col("weight")).alias("dot"))
    cosine = F.round(F.col("dot") / (F.col("norm") * F.col("length")), 6)
    best = sums.join(template, "template").select("version", "run", "licence", cosine.alias("score")).filter(F.col("score") >= threshold)
    best = best.groupBy("version").agg(
        F.min(F.struct((-F.col("score")).alias("s"), "licence")).alias("best"), F.max(F.when(F.col("run").isNull(), F.col("score"))).alias("whole")
    )
    return best.select("version", "best.licence", (-F.col("best.s")).alias("score"), "whole")


def directory(path: Column) -> Column:
    """The path without its last part; empty at the top, null for a null path."""
    return F.when(F.contains(path, F.lit("/")), F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.when(path.isNotNull(), F.lit("")))


def ancestors(path: Column) -> Column:
    """A directory and all above it, the top ('') last."""
    parts = F.when(path == "", F.array().cast("array<string>")).otherwise(F.split(path, "/"))
    return F.transform(F.sequence(F.size(parts), F.lit(0), F.lit(-1)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))


def scan(
    files: DataFrame,
    path: Column,
    templates: list[tuple[str, str]] = TEMPLATES + NEIGHBOURS,
    threshold: float = THRESHOLD,
    file_share: float = FILE_SHARE,
    texts: list[tuple[str, str]] = TEXTS,
) -> DataFrame:
    """``_row`` (the whole row of ``files``, which has ``text``), path, licence, score, origin and origin_dir.

    origin is 'own' (the licence of the best header or whole text, without one of the best line; ties go to the first
    name), 'inherited' (of the nearest directory at or above the file's with a licence file; of several one near a licence
    text as a whole, then that of the largest cosine or share of lines with a licence, then the first path) or null.  Null and empty texts have no lines, a null path has no directory.  Equal rows fare alike.
    """
    vocabulary = _vocabulary(templates)
    key = [path.alias("path"), F.xxhash64(files["text"]).alias("version")]
    rows = files.select(F.struct(*[files[f"`{c}`"] for c in files.columns]).alias("_row"), files["text"].alias("text"), *key)
    every = sorted(set(reduce(list.__add__, vocabulary + _vocabulary(texts))))
    n, found = document_frequencies(rows.select("text"), every)
    text_idf = {t: weigh(n, found.get(t, 0)) for t in every}
    idf = {t: weigh(n, found.get(t, 0)) for t in sorted(set(reduce(list.__add__, vocabulary)))}
    needed = F.array(*[F.lit(t) for t in anchors(vocabulary, idf, threshold)])

    some = rows.filter(F.arrays_overlap(terms(F.col("text")), needed))
    lines = some.select(
        "path", "version", F.regexp_count("text", F.lit(WORD)).alias("words"), F.posexplode(F.split("text", "\n")).alias("at", "line")
    )
    # Equal rows are one file here.
    lines = stage(lines.filter(F.arrays_overlap(terms(F.col("line")), needed)).distinct(), "licence-lines")
    scored = stage(scored_lines(lines.select("line").distinct(), templates, idf, threshold), "licence-scores")
    # The scored lines are distinct and staged; a line of many files is on the left, where Spark splits it.
    hits = lines.join(scored, "line")
    own = (
        hits.groupBy("path", "version")
        .agg(
            F.min(F.struct((-F.col("score")).alias("s"), "licence")).alias("best"),
            F.sum(F.regexp_count("line", F.lit(WORD))).alias("licensed"),
            F.max("words").alias("words"),
        )
        .select("path", "version", "best.licence", (-F.col("best.s")).alias("score"), (F.col("licensed") / F.col("words")).alias("share"))
    )
    near = stage(scored_texts(rows.select("version", "text"), texts, text_idf, n, threshold), "text-scores")
    # The scored texts are distinct and staged; a text of many files is on the left.
    near = rows.select("path", "version").join(near, "version").distinct()
    own = own.withColumn("whole", F.lit(None).cast("double")).withColumn("kind", F.lit(1))
    own = own.unionByName(near.withColumn("share", F.lit(None).cast("double")).withColumn("kind", F.lit(0)))
    own = own.groupBy("path", "version").agg(
        F.min(F.struct("kind", (-F.col("score")).alias("s"), "licence")).alias("best"), F.max("share").alias("share"), F.max("whole").alias("whole")
    )
    own = stage(own.select("path", "version", "best.licence", (-F.col("best.s")).alias("score"), "share", "whole"), "own-licences")
    named = own.filter((F.col("whole").isNotNull() | (F.col("share") >= file_share)) & F.col("path").isNotNull())
    rank = F.struct(F.col("whole").isNull().alias("notice"), (-F.coalesce("whole", "share")).alias("s"), "path", "licence", "score")
    named = named.withColumn("dir", directory(F.col("path"))).groupBy("dir").agg(F.min(rank).alias("best"))
    named = stage(named.select("dir", "best.licence", "best.score"), "licence-files")

    dirs = rows.select(directory(F.col("path")).alias("dir")).filter(F.col("dir").isNotNull()).distinct()
    climbed = dirs.select(F.col("dir").alias("below"), F.explode(ancestors(F.col("dir"))).alias("dir"))
    depth = F.when(F.col("dir") == "", 0).otherwise(F.size(F.split("dir", "/")))
    nearest = climbed.join(named, "dir").groupBy("below").agg(F.max(F.struct(depth.alias("depth"), "dir", "licence", "score")).alias("up"))
    nearest = stage(nearest.select(F.col("below").alias("_dir"), "up"), "inherited")

    mine = own.select(F.col("path").alias("_path"), F.col("version").alias("_version"), "licence", "score")
    joined = rows.join(mine, F.col("path").eqNullSafe(F.col("_path")) & (F.col("version") == F.col("_version")), "left")
    joined = joined.withColumn("dir", directory(F.col("path"))).join(nearest, F.col("dir") == F.col("_dir"), "left")
    has = F.col("licence").isNotNull()
    return joined.select(
        "_row",
        "path",
        F.coalesce("licence", "up.licence").alias("licence"),
        F.coalesce("score", "up.score").alias("score"),
        F.when(has, "own").when(F.col("up").isNotNull(), "inherited").alias("origin"),
        F.when(~has, F.col("up.dir")).alias("origin_dir"),
    )
