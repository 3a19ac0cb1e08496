"""License scan: sparse TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

A file has a path and a text. Its license sections are the lines that name a license, a copyright or rights, alone and
joined with the line after and before each; a file whose name says that it is a license file also counts whole. A section's word weights, tf * ln((1 + n) / (1 + df)) + tf
over the templates, meet the templates' weights in an equal-key join on the word: only words that
templates have take part, so a file sends a few rows whatever its length. A template counts only where the section has a word
that no other license's templates have: common words alone, as in "licensed under the", name no license. The template with the largest cosine of any section, at
`MIN_SCORE` or above, is the file's license.

A directory takes the license of its license file (of several, the best score, then the first path). A file without a license
takes that of the nearest directory above it, found by joining its ancestor paths with the licensed directories; the
root directory is the empty path.

Null texts have no license of their own; null paths inherit nothing. Rows that repeat are scanned each; ties go to the
first template in name order; empty tables give empty results.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, functions as F

from shopsight.llm.common import stored, text_column

MIN_SCORE = 0.5
# Titles, short forms, headers, first sentences and SPDX identifiers of public licenses.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "Apache License Version 2.0, January 2004",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Creative Commons Attribution 4.0 International Public License",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Creative Commons Attribution-NonCommercial 4.0 International Public License",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "GNU General Public License Version 3, 29 June 2007",
        "SPDX-License-Identifier: GPL-3.0",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "SPDX-License-Identifier: MIT",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Mozilla Public License Version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "Proprietary": ["All rights reserved.", "SPDX-License-Identifier: LicenseRef-Proprietary"],
}
NAMES_LICENSE = r"(?i)licen[sc]|copyright|rights reserved|permission is hereby|redistribution and use|free software|SPDX"
LICENSE_FILE = r"(?i)(^|/)(licen[sc]e|copying|notice|unlicense)[^/]*$"
WORD = r"[A-Za-z0-9][A-Za-z0-9.+-]*[A-Za-z0-9+]|[A-Za-z0-9]"


def template_weights(templates: dict[str, list[str]]) -> list[tuple[str, str, float]]:
    """template text's (name, word, weight), normed to length one; every text of a license is a template of its own."""
    counted = [(name, k, Counter(re.findall(WORD, text.lower()))) for name, texts in sorted(templates.items()) for k, text in enumerate(texts)]
    seen = Counter(w for _, _, words in counted for w in words)
    rows = []
    for name, k, words in counted:
        weights = {w: n * (math.log((1 + len(counted)) / (1 + seen[w])) + 1) for w, n in words.items()}
        norm = math.sqrt(sum(x * x for x in weights.values()))
        rows += [(f"{name}#{k}", w, x / norm, math.log((1 + len(counted)) / (1 + seen[w])) + 1) for w, x in weights.items()]
    return rows


def _sections(path: Column, text: Column) -> Column:
    """The texts that may hold a license, one array: a license file as a whole, and of every file the lines that name one.

    Such a line counts alone, unless a hyphen at its end says that it goes on, and joined with the next and the last line,
    without the comment signs between.
    """
    lines = F.split(text, "\n")
    after = F.concat(F.slice(lines, 2, F.size(lines)), F.array(F.lit("")))
    names = lambda line: line.rlike(NAMES_LICENSE)

    def joined(line: Column, following: Column) -> Column:
        bare = F.regexp_replace(following, r"^[\s#/*;%!<>-]+", "")
        return F.when(names(line) | names(following), F.regexp_replace(F.concat(F.rtrim(line), F.lit(" "), bare), r"(?<=[A-Za-z])- (?=[A-Za-z])", "-"))

    alone = F.filter(lines, lambda line: names(line) & ~line.rlike(r"[A-Za-z]-\s*$"))
    found = F.when(names(text), F.concat(alone, F.array_compact(F.zip_with(lines, after, joined)))).otherwise(F.array().cast("array<string>"))
    return F.when(F.coalesce(path.rlike(LICENSE_FILE), F.lit(False)), F.concat(F.array(text), found)).otherwise(found)


def own_words(templates: dict[str, list[str]]) -> set[str]:
    """Words that the templates of one license only have."""
    licenses = Counter(w for texts in templates.values() for w in set(re.findall(WORD, " ".join(texts).lower())))
    return {w for w, n in licenses.items() if n == 1}


def scored(files: DataFrame, templates: dict[str, list[str]] | None = None, min_score: float = MIN_SCORE) -> DataFrame:
    """row, path, license and score of every file by its own text; a row's sections are scored apart, the best one wins."""
    spark = files.sparkSession
    templates = templates or TEMPLATES
    own = own_words(templates)
    weighted = [(*row, row[1] in own) for row in template_weights(templates)]
    weights = spark.createDataFrame(weighted, "template string, word string, weight double, idf double, own boolean")
    rows = files.select("row", "path", F.posexplode_outer(_sections(F.col("path"), text_column())).alias("part", "section"))
    words = rows.where("section is not null").select("row", "part", F.explode(F.regexp_extract_all(F.lower("section"), F.lit(WORD), F.lit(0))).alias("word"))
    counts = words.groupBy("row", "part", "word").agg(F.count("*").alias("tf"))
    known = weights.select("word", "idf").distinct()
    # a word that no template has weighs as one that is in no template
    top = math.log(1 + weights.select("template").distinct().count()) + 1
    weighed = counts.join(F.broadcast(known), "word", "left").withColumn("x", F.col("tf") * F.coalesce("idf", F.lit(top)))
    norms = weighed.groupBy("row", "part").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dots = weighed.where("idf is not null").join(F.broadcast(weights.drop("idf")), "word").groupBy("row", "part", "template").agg(
        F.sum(F.col("x") * F.col("weight")).alias("dot"), F.max("own").alias("own")
    )
    cosines = dots.where("own").join(norms, ["row", "part"]).select("row", "template", F.round(F.col("dot") / F.col("norm"), 9).alias("score"))
    best = cosines.groupBy("row", "template").agg(F.max("score").alias("score")).groupBy("row").agg(F.min(F.struct((-F.col("score")).alias("s"), "template")).alias("b"))
    own = best.where(-F.col("b.s") >= min_score).select("row", F.substring_index("b.template", "#", 1).alias("license"), (-F.col("b.s")).alias("score"))
    return files.select("row", "path").join(own, "row", "left")


def ancestors(path: Column) -> Column:
    """Directories above a path, from the root (empty) down."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, 1, i), "/"))


def licensed(files: DataFrame, templates: dict[str, list[str]] | None = None, min_score: float = MIN_SCORE) -> DataFrame:
    """row, path, license, score and license_from (own, a directory, or null) of every file (row, path, text)."""
    own = stored(scored(files, templates, min_score), "own-licenses")
    holders = own.where(F.col("license").isNotNull() & F.col("path").rlike(LICENSE_FILE))
    folder = F.when(F.instr("path", "/") > 0, F.regexp_replace("path", r"/[^/]*$", "")).otherwise(F.lit(""))
    named = holders.withColumn("folder", folder).groupBy("folder").agg(F.min(F.struct((-F.col("score")).alias("s"), "path", "license")).alias("f"))
    folders = named.select("folder", F.col("f.license").alias("folder_license"), (-F.col("f.s")).alias("folder_score"))
    needy = own.where(F.col("license").isNull() & F.col("path").isNotNull())
    above = needy.select("row", F.explode(ancestors(F.col("path"))).alias("folder"))
    nearest = above.join(folders, "folder").groupBy("row").agg(F.max_by(F.struct("folder", "folder_license", "folder_score"), F.length("folder")).alias("n"))
    return own.join(nearest, "row", "left").select(
        "row",
        "path",
        F.coalesce("license", "n.folder_license").alias("license"),
        F.coalesce("score", "n.folder_score").alias("score"),
        F.when(F.col("license").isNotNull(), F.lit("own")).otherwise(F.col("n.folder")).alias("license_from"),
    )
