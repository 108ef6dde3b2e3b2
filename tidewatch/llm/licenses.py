"""Licence scans: TF-IDF cosine of stretches of text to templates, then inheritance from directories. DataFrame expressions only."""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import row_key, saved

# Licence names, and statements that announce them: in files, in headers, and the titles of licence files.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. CC0 1.0 Universal public domain dedication"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
)
LEAST_COSINE = 0.6


def _words(text: Column) -> Column:
    """Terms of a text, in lower case; versions stay whole. Comment marks and line ends only part words."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit("[\\p{L}\\p{N}]+(?:\\.[0-9]+)*"), F.lit(0)), F.array().cast("array<string>"))


def _template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+(?:\.[0-9]+)*", text.lower())


TERMS = sorted({w for _, text in TEMPLATES for w in _template_words(text)})


def term_weights(rows: DataFrame) -> tuple[dict[str, float], float]:
    """Inverse document frequency of each term of the templates over all texts of `rows` (`text`), and that of any other word."""
    held = F.array_intersect(_words(F.col("text")), F.array(*[F.lit(t) for t in TERMS]))
    counts = {r["term"]: r["n"] for r in rows.select(F.explode(held).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}  # len(TERMS) rows
    total = rows.count() + len(TEMPLATES)
    return {t: math.log((1 + total) / (1 + counts.get(t, 0))) + 1 for t in TERMS}, math.log(1 + total) + 1


def seeds(idf: dict[str, float], least: float = LEAST_COSINE) -> dict[str, list[tuple[int, int, int]]]:
    """The terms at which a text is compared with templates: for each, (template, place in it, words of it).

    A stretch has a cosine of `least` only if the terms that it shares with a template have `least` squared of the template's squared length. So
    the heaviest terms are seeds until those left have less than that, and no such stretch is without one.
    """
    out: dict[str, list[tuple[int, int, int]]] = {}
    for number, (_, text) in enumerate(TEMPLATES):
        words = _template_words(text)
        weights = {t: (n * idf[t]) ** 2 for t, n in Counter(words).items()}
        left = sum(weights.values())
        for term in sorted(weights, key=lambda t: (-round(weights[t], 9), t)):
            if left < least**2 * sum(weights.values()):
                break
            left -= weights[term]
            out.setdefault(term, []).extend((number, at, len(words)) for at, w in enumerate(words) if w == term)
    return out


def windows(rows: DataFrame, found: dict[str, list[tuple[int, int, int]]]) -> DataFrame:
    """Stretches of whole texts that may state a licence: `id`, `key`, `template`, `start` (word, from 0) and `words`.

    A stretch is as long as a template and lies so that a seed has the same place in both; at the ends of a text it is cut.
    """
    terms = F.array(*[F.lit(t) for t in sorted(found)])
    places = F.create_map(*[
        x for t in sorted(found)
        for x in (F.lit(t), F.array(*[F.struct(F.lit(n).alias("template"), F.lit(at).alias("at"), F.lit(size).alias("size")) for n, at, size in found[t]]))
    ])

    def met(hit: Column) -> Column:
        return F.transform(F.element_at(places, hit["word"]), lambda x: F.struct(x["template"].alias("template"), (hit["at"] - x["at"]).alias("start"), x["size"].alias("size")))

    def cut(x: Column) -> Column:
        first = F.greatest(x["start"], F.lit(0))
        return F.struct(x["template"].alias("template"), first.alias("start"), F.slice("words", first + 1, x["size"] + x["start"] - first).alias("words"))

    texts = rows.select("id", "key", _words(F.col("text")).alias("words")).where(F.arrays_overlap("words", terms))
    hits = F.filter(F.transform("words", lambda w, at: F.struct(w.alias("word"), at.alias("at"))), lambda h: F.array_contains(terms, h["word"]))
    stretches = F.array_distinct(F.flatten(F.transform(hits, met)))
    return texts.select("id", "key", F.explode(F.transform(stretches, cut)).alias("w")).select("id", "key", "w.template", "w.start", "w.words")


def recognised(found: DataFrame, idf: dict[str, float], other: float) -> DataFrame:
    """Stretches with a cosine of `LEAST_COSINE` or more to their template: `id`, `key`, `start`, `licence`, `cosine`.

    Weights are counts times inverse document frequency. Sparse products: a term meets only the template that holds it. Equal stretches,
    which many files repeat, are folded to one before any join.
    """
    spark = found.sparkSession
    listed = [(n, name, Counter(_template_words(text))) for n, (name, text) in enumerate(TEMPLATES)]
    sizes = {n: math.sqrt(sum((c * idf[t]) ** 2 for t, c in words.items())) for n, _, words in listed}
    units = spark.createDataFrame([(n, t, c * idf[t] / sizes[n]) for n, _, words in listed for t, c in words.items()], "template int, term string, unit double")
    names = spark.createDataFrame([(n, name) for n, name, _ in listed], "template int, licence string")
    known = spark.createDataFrame(list(idf.items()), "term string, idf double")
    marked = found.withColumn("kind", F.xxhash64("template", "words"))
    kinds = marked.groupBy("kind", "template", "words").agg(F.count(F.lit(1)).alias("n"))
    terms = kinds.select("kind", "template", F.explode("words").alias("term")).groupBy("kind", "template", "term").agg(F.count(F.lit(1)).alias("tf"))
    own = terms.join(F.broadcast(known), "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(other)))
    met = own.join(F.broadcast(units), ["template", "term"], "left")
    scored = met.groupBy("kind", "template").agg(F.round(F.sum(F.col("w") * F.col("unit")) / F.sqrt(F.sum(F.col("w") * F.col("w"))), 6).alias("cosine"))
    best = scored.where(F.col("cosine") >= LEAST_COSINE).join(F.broadcast(names), "template").select("kind", "licence", "cosine")
    return marked.join(best, "kind").select("id", "key", "start", "licence", "cosine")


def _folders(path: Column) -> Column:
    """All directories above a path, the root being empty: depth and name."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts) - 1), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("folder"))
    )


def licences(files: DataFrame, path_col: str = "path", id_col: str = "doc_id", text_col: str = "text", licence_file: str = "(?i)(^|/)(licen[cs]e|copying)[^/]*$") -> DataFrame:
    """One row per row of `files`: `id`, `key`, `licence`, `cosine` and `how`: `stated` in the file's own text (the best of its stretches, then the
    first, then by name), `inherited` from the licence file of the nearest directory above it, or `none`.

    Stretches of the whole text, as long as a template, are compared with it wherever they hold a term that no likeness can do without (see
    `seeds`): statements inside long lines, wrapped headers in comments and the titles of licence texts alike. A licence file is one whose path
    matches `licence_file` and whose own text states a licence; of several in a directory the best counts. Files meet directories by equal names only: each file offers its own directories, each directory has one row.
    Null paths have no directories, null and empty texts state nothing; repeated rows each give theirs; an empty
    table gives none.
    """
    rows = files.select(F.col(id_col).alias("id"), row_key(files).alias("key"), F.col(path_col).cast("string").alias("path"), F.col(text_col).cast("string").alias("text"))
    idf, other = term_weights(rows)
    found = recognised(saved(windows(rows, seeds(idf))), idf, other)
    stated = found.groupBy("id", "key").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "start", "licence")).alias("b"))
    stated = stated.select(F.col("id").alias("_id"), F.col("key").alias("_key"), F.col("b.licence").alias("own"), (-F.col("b.c")).alias("own_cosine"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    named = rows.select("id", "key", "path").join(stated, same, "left").select("id", "key", "path", "own", "own_cosine")
    folder = F.regexp_replace("path", "/?[^/]*$", "")
    given = named.where(F.col("own").isNotNull() & F.col("path").rlike(licence_file)).groupBy(folder.alias("given")).agg(
        F.min(F.struct((-F.col("own_cosine")).alias("c"), F.col("own").alias("licence"))).alias("g")
    )
    asked = named.where("own IS NULL AND path IS NOT NULL").select("id", "key", "path").distinct()
    above = asked.select("id", "key", F.explode(_folders(F.col("path"))).alias("f")).join(given, F.col("f.folder") == F.col("given"))
    nearest = above.groupBy("id", "key").agg(F.max(F.struct("f.depth", (F.col("g.c")).alias("c"), F.col("g.licence").alias("licence"))).alias("n"))
    nearest = nearest.select(F.col("id").alias("_id"), F.col("key").alias("_key"), F.col("n.licence").alias("above"), (-F.col("n.c")).alias("above_cosine"))
    how = F.when(F.col("own").isNotNull(), "stated").when(F.col("above").isNotNull(), "inherited").otherwise("none")
    return named.join(nearest, same, "left").select(
        "id", "key", "path", F.coalesce("own", "above").alias("licence"), F.coalesce("own_cosine", "above_cosine").alias("cosine"), how.alias("how")
    )
