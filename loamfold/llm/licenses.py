"""Licences of files: TF-IDF cosine to templates, inherited from the nearest ancestor directory; DataFrame functions only.

A line reaches the least cosine to a template only if it holds one of that template's rarer terms (the common ones
together weigh too little, by Cauchy and Schwarz). So one search over the whole text finds all lines that are worth a
vector, and everything after it works on those.
"""

from __future__ import annotations

from math import log, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Least cosine of a line, or of the whole text of a licence file, to a template.
LEAST = 0.7
#: Names of licence files, and notices by licence identifier.
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|notice)([._-].*)?$"
TEMPLATES = [
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def terms(text: Column) -> Column:
    """Runs of a-z and 0-9 after lower-casing."""
    return F.array_remove(F.split(F.lower(text), "[^a-z0-9]+"), "")


def _terms(text: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()


def inverse_frequencies(docs: DataFrame, vocabulary: set[str], text: str = "text") -> tuple[dict[str, float], float]:
    """Weight ln((N + 1) / (df + 1)) + 1 of the terms of the templates, over all documents; and that of any other term.

    What is collected is one number per term of the templates.
    """
    held = F.array_intersect(F.array(*[F.lit(t) for t in sorted(vocabulary)]), terms(F.coalesce(F.col(text), F.lit(""))))
    counts = docs.select(F.explode(F.concat(held, F.array(F.lit("")))).alias("term")).groupBy("term").count().collect()
    found = {r["term"]: r["count"] for r in counts}
    n = found.get("", 0)
    return {t: log((n + 1) / (found.get(t, 0) + 1)) + 1 for t in vocabulary}, log(n + 1) + 1


def _vector(text: str, weight: dict[str, float]) -> dict[str, float]:
    words = _terms(text)
    return {t: words.count(t) * weight[t] for t in words}


def rare_terms(vector: dict[str, float], least: float) -> set[str]:
    """Terms of which a text must hold one to reach ``least``: all but the lightest whose share of the norm is below it."""
    whole, light, rare = sum(x * x for x in vector.values()), 0.0, set()
    for term, x in sorted(vector.items(), key=lambda kv: (kv[1], kv[0])):
        light += x * x
        if light >= 0.999 * least * least * whole:
            rare.add(term)
    return rare


def own_licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """``ka, kb, license, score`` of the files (``ka, kb, is_file, text``) with a line, or whole licence text, near a template.

    The best cosine counts; ties go to the first identifier. Scores are rounded to six places.
    """
    weight, other = inverse_frequencies(docs, {t for _, text in templates for t in _terms(text)})
    vectors = [(name, _vector(text, weight)) for name, text in templates]
    wanted = sorted(set().union(*[rare_terms(v, least) for _, v in vectors]))
    search = rf"(?i)(?<![a-z0-9])({'|'.join(wanted)})(?![a-z0-9])"
    spark = docs.sparkSession
    entries = [(k, name, t, x * weight[t] / sqrt(sum(y * y for y in v.values()))) for k, (name, v) in enumerate(vectors) for t, x in v.items()]
    table = spark.createDataFrame(entries, "template int, name string, term string, along double")  # a row per template and term
    weights = spark.createDataFrame(sorted(weight.items()), "term string, idf double")

    near = docs.where(F.col("text").rlike(search))
    whole = F.when(F.col("is_file"), F.array("text")).otherwise(F.array().cast("array<string>"))
    segments = near.select("ka", "kb", F.posexplode(F.concat(F.split("text", "\n"), whole)).alias("place", "segment")).where(F.col("segment").rlike(search)).dropDuplicates(["ka", "kb", "place"])
    counted = segments.select("ka", "kb", "place", F.explode(terms(F.col("segment"))).alias("term")).groupBy("ka", "kb", "place", "term").agg(F.count("*").alias("tf"))
    weighted = counted.join(weights, "term", "left").withColumn("idf", F.coalesce("idf", F.lit(other)))
    norms = weighted.groupBy("ka", "kb", "place").agg(F.sqrt(F.sum(F.pow(F.col("tf") * F.col("idf"), 2))).alias("norm"))
    dots = counted.join(table, "term").groupBy("ka", "kb", "place", "template", "name").agg(F.sum(F.col("tf") * F.col("along")).alias("dot"))
    scored = dots.join(norms, ["ka", "kb", "place"]).select("ka", "kb", "name", F.round(F.col("dot") / F.col("norm"), 6).alias("score")).where(F.col("score") >= least)
    best = F.min(F.struct((-F.col("score")).alias("minus"), "name"))
    return scored.groupBy("ka", "kb").agg(best.alias("best")).select("ka", "kb", F.col("best.name").alias("license"), (-F.col("best.minus")).alias("score"))


def ancestors(folder: Column) -> Column:
    """A folder and all folders above it up to the root (an empty path), with their depths."""
    parts = F.when(folder == "", F.array().cast("array<string>")).otherwise(F.split(folder, "/"))
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("folder")))


def file_licenses(docs: DataFrame, keep: tuple[str, ...] = ("path",), path: str = "path", text: str = "text", templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """The columns ``keep`` with ``own_license, score, license, inherited_from`` of every file.

    A file's own licence is that of its best line (in a licence file also of its whole text). A file without one has
    that of the nearest folder, its own or above, with a licence file that has one (the best there; ties to the first
    identifier), and ``inherited_from`` names the folder ("" is the root). Paths are split at ``/``. A null or empty
    text has no licence of its own; a null path inherits nothing. Rows equal in path and text are treated alike; all
    stay. A kept column with an added name is an error; an empty table gives an empty table.
    """
    if clash := {"own_license", "score", "license", "inherited_from"} & set(keep):
        raise ValueError(f"columns {sorted(clash)} are added by the scan")
    kept = [F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)]
    keys = [F.xxhash64(F.lit(salt), F.col(path).isNull(), F.col(path), F.col(text)).alias(name) for salt, name in ((1, "ka"), (2, "kb"))]
    name = F.substring_index(F.col(path), "/", -1)
    folder = F.when(F.col(path).contains("/"), F.substring(F.col(path), F.lit(1), F.length(path) - F.length(name) - 1)).otherwise(F.when(F.col(path).isNotNull(), F.lit("")))
    is_file = F.coalesce(name.rlike(LICENCE_FILE), F.lit(False))
    own = own_licenses(docs.select(*keys, is_file.alias("is_file"), F.col(text).alias("text")), templates)
    files = docs.select(*kept, *keys, folder.alias("folder"), is_file.alias("is_file")).join(own, ["ka", "kb"], "left")

    best = F.min(F.struct((-F.col("score")).alias("minus"), F.col("license").alias("name")))
    licensed = files.where("is_file AND license IS NOT NULL AND folder IS NOT NULL").groupBy("folder").agg(best.alias("best")).select("folder", F.col("best.name").alias("given"))
    above = files.where("folder IS NOT NULL").select(F.col("folder").alias("below")).distinct().select("below", F.inline(ancestors(F.col("below"))))
    nearest = above.join(licensed, "folder").groupBy("below").agg(F.max(F.struct("depth", "folder", "given")).alias("up")).select(F.col("below").alias("folder"), "up.given", F.col("up.folder").alias("giver"))
    joined = files.join(nearest, "folder", "left")
    inherits = F.col("license").isNull()
    return joined.select(
        *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)],
        F.col("license").alias("own_license"),
        "score",
        F.coalesce("license", "given").alias("license"),
        F.when(inherits, F.col("giver")).alias("inherited_from"),
    )
