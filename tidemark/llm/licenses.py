"""Licences of files, from their own notices or from the nearest directory that states one.

Sentences, lines and overlapping windows of a file are compared with the wording of
licences by the cosine of sparse TF-IDF vectors, in which all their terms count. A licence
file states the licence of its directory, and files without a notice of their own take that
of the nearest directory above them, found by joining paths. Only DataFrame functions are
used.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.columns import named, text_of
from tidemark.session import stage_in

#: Notices by licence, and how the licences' own texts begin (fixed values, the customary wording).
TEMPLATES = {
    "AGPL-3.0": (
        "Licensed under the GNU Affero General Public License, version 3",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc.",
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with"
        " the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    ),
    "Artistic-1.0": (
        "The Artistic License Preamble The intent of this document is to state the conditions under which a Package may be copied",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of"
        " conditions and the following disclaimer",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC0-1.0": (
        "Dedicated to the public domain under CC0 1.0 Universal",
        "Creative Commons Legal Code CC0 1.0 Universal CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM AND DOES NOT PROVIDE LEGAL SERVICES",
    ),
    "GFDL": (
        "GNU Free Documentation License Version 1.3, 3 November 2008 Copyright (C) 2000, 2001, 2002, 2007, 2008 Free Software Foundation, Inc.",
        "GNU Free Documentation License Version 1.2, November 2002 Copyright (C) 2000,2001,2002 Free Software Foundation, Inc.",
        "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License",
    ),
    "GPL-1.0": (
        "GNU GENERAL PUBLIC LICENSE Version 1, February 1989 Copyright (C) 1989 Free Software Foundation, Inc.",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 1,"
        " or (at your option) any later version",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc.",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2"
        " of the License, or (at your option) any later version",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc.",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3"
        " of the License, or (at your option) any later version",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"
        " provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "LGPL-2.0": (
        "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1991 Free Software Foundation, Inc.",
        "under the terms of the GNU Library General Public License as published by the Free Software Foundation; either version 2"
        " of the License, or (at your option) any later version",
    ),
    "LGPL-2.1": (
        "Licensed under the GNU Lesser General Public License, version 2.1",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, Inc.",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1"
        " of the License, or (at your option) any later version",
    ),
    "LGPL-3.0": (
        "Licensed under the GNU Lesser General Public License, version 3",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc.",
    ),
    "MIT": (
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the Software), to deal in the Software without restriction",
    ),
    "MPL-1.1": (
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the License); you may not use this"
        " file except in compliance with the License",
        "MOZILLA PUBLIC LICENSE Version 1.1",
    ),
    "MPL-2.0": (
        "Subject to the terms of the Mozilla Public License, v. 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Mozilla Public License Version 2.0",
    ),
    "proprietary": ("All rights reserved", "Copyright (c) All rights reserved"),
}
#: It grants nothing, and stands in texts of licences too: it counts where no other notice is found.
RESERVED = "proprietary"
#: Words whose weight is 1, the least there is (fixed values).
COMMON = set("a all and any are as at be but by c copy except file files for free from in is it may not of on or person source subject terms that the this to under use v with without work you your".split())
TERM = r"[a-z0-9]+(?:\.[0-9]+)*"
SENTENCE = r"[.;:]\s+"
#: Terms of a window, and the terms from one to the next. Longer sentences and lines are seen through windows only.
WINDOW, STEP = 40, 20
#: A unit states a licence from this cosine on.
LEAST = 0.7
#: A file is a licence file by its name, or if one unit that states a licence makes up this share of its terms, in percent.
FILE_NAME = r"(?i)(^|/)(licen[cs]e|copying|unlicense)[^/]*$"
FILE_PERCENT = 50
#: The unit of a whole file, and of a template that is compared with whole files.
WHOLE = "whole"


def counted(text: str) -> dict[str, int]:
    terms = re.findall(TERM, text.lower())
    return {t: terms.count(t) for t in dict.fromkeys(terms)}


def templates(texts: Mapping[str, str] | None = None) -> list[tuple[int, str, str, dict[str, int]]]:
    """(number, licence, kind, terms with their counts) of every notice, and of whole texts of licences."""
    notices = [(licence, "notice", notice) for licence, all_of_it in TEMPLATES.items() for notice in all_of_it]
    whole = [(licence, WHOLE, text) for licence, text in (texts or {}).items()]
    return [(n, licence, kind, counted(text)) for n, (licence, kind, text) in enumerate([*notices, *whole])]


def vocabulary(texts: Mapping[str, str] | None = None) -> list[str]:
    """The templates' terms whose weight depends on the files."""
    return sorted({t for _, _, _, terms in templates(texts) for t in terms} - COMMON)


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def term_weights(files: DataFrame, known: list[str]) -> dict[str, float]:
    """idf of the given terms over all files: (text). As many numbers as terms reach the driver."""
    words = F.array(*[F.lit(t) for t in known])
    held = files.select(F.explode(F.array_intersect(words, terms_of(F.col("text")))).alias("term"))
    counts = dict(held.groupBy("term").agg(F.count("*")).toLocalIterator())
    total = files.count()
    return {t: math.log((total + 1) / (counts.get(t, 0) + 1)) + 1 for t in known}


def other_weight(idf: Mapping[str, float]) -> float:
    """The weight of a term that no template has: the mean of those that some have."""
    return sum(idf.values()) / len(idf) if idf else 1.0


def unit_vectors(idf: Mapping[str, float], texts: Mapping[str, str] | None = None) -> list[tuple[int, str, str, dict[str, float]]]:
    """(number, licence, kind, unit vector) of every template."""
    out = []
    for n, licence, kind, terms in templates(texts):
        weights = {t: k * idf.get(t, 1.0) for t, k in terms.items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        out.append((n, licence, kind, {t: w / norm for t, w in weights.items()} if norm else {}))
    return out


def key_terms(vectors: list[tuple[int, str, str, dict[str, float]]]) -> list[str]:
    """Terms of which a unit must hold one to reach the least cosine with any template.

    With none of a template's heaviest terms it shares at most the rest of the template's
    vector, whose length bounds the cosine.
    """
    keys: set[str] = set()
    for _, _, _, vector in vectors:
        rest = sum(u * u for u in vector.values())
        for term in sorted(vector, key=lambda t: (-vector[t], t)):
            if rest < (LEAST - 1e-6) ** 2:
                break
            keys.add(term)
            rest -= vector[term] ** 2
    return sorted(keys)


def units_of(text: Column, terms: Column) -> Column:
    """The distinct units of a text, as arrays of terms: sentences and lines of at most a
    window's terms, and windows over all of them."""
    lines = F.split(text, "\n")
    sentences = F.flatten(F.transform(lines, lambda x: F.split(x, SENTENCE)))
    short = F.filter(F.transform(F.concat(lines, sentences), terms_of), lambda t: F.size(t).between(1, WINDOW))
    starts = F.sequence(F.lit(1), F.greatest(F.size(terms) - STEP, F.lit(1)), F.lit(STEP))
    windows = F.filter(F.transform(starts, lambda k: F.slice(terms, k, WINDOW)), lambda t: F.size(t) > 0)
    return F.array_distinct(F.concat(short, windows))


def notices(spark: SparkSession, files: DataFrame, stage, texts: Mapping[str, str] | None = None) -> DataFrame:
    """(key, mark, licence, score, n_terms) of every unit that states a licence, by its best template."""
    idf = term_weights(files, vocabulary(texts))
    vectors = unit_vectors(idf, texts)
    keys = F.array(*[F.lit(t) for t in key_terms(vectors)])
    source = files.withColumn("terms", terms_of(F.col("text"))).where(F.arrays_overlap("terms", keys))
    kinds = [source.select("key", "mark", F.lit("notice").alias("kind"), F.explode(units_of(F.col("text"), F.col("terms"))).alias("unit"))]
    if texts:
        kinds.append(source.where(F.col("path").rlike(FILE_NAME)).select("key", "mark", F.lit(WHOLE).alias("kind"), F.col("terms").alias("unit")))
    units = kinds[0] if len(kinds) == 1 else kinds[0].unionByName(kinds[1])
    units = units.where(F.arrays_overlap("unit", keys)).distinct().withColumn("n_terms", F.size("unit"))
    units = stage(units.withColumn("at", F.monotonically_increasing_id()))

    counts = units.select("at", "kind", F.explode("unit").alias("term")).groupBy("at", "kind", "term").agg(F.count("*").alias("tf"))
    weights = spark.createDataFrame([*idf.items(), *[(t, 1.0) for t in sorted(COMMON)]], "term string, idf double")
    weighed = counts.join(weights, "term", "left").withColumn("weight", F.col("tf") * F.coalesce("idf", F.lit(other_weight(idf))))
    weighed = stage(weighed.select("at", "kind", "term", "weight"))
    sizes = weighed.groupBy("at").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    rows = [(n, licence, kind, t, u) for n, licence, kind, vector in vectors for t, u in vector.items()]
    model = spark.createDataFrame(rows, "template int, licence string, kind string, term string, unit double")
    dots = weighed.join(model, ["kind", "term"]).groupBy("at", "template", "licence").agg(
        F.sum(F.col("weight") * F.col("unit")).alias("dot"), F.sum(F.col("unit") * F.col("unit")).alias("shared")
    )
    # The shared part of a template's vector bounds the cosine.
    dots = dots.where(F.col("shared") >= (LEAST - 1e-6) ** 2)
    scored = dots.join(sizes, "at").withColumn("score", F.round(F.col("dot") / F.col("norm"), 6)).where(F.col("score") >= LEAST)
    best = F.max(F.struct("score", F.expr("-template").alias("order"), "licence")).alias("best")
    found = scored.groupBy("at").agg(best).select("at", "best.licence", "best.score")
    return units.join(found, "at").select("key", "mark", "licence", "score", "n_terms")


def ancestors(path: Column) -> Column:
    """All directories above a path, as (depth, dir); the root is the empty one."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts) - 1),
        lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, F.lit(1), k), "/").alias("dir")),
    )


def licensed(
    spark: SparkSession, files: DataFrame, path: str = "path", text: str = "text", texts: Mapping[str, str] | None = None
) -> DataFrame:
    """Per distinct (path, text): path, mark, header_licence, header_score, inherited_licence, inherited_from, licence.

    ``mark`` is the text's hash. The header licence is that of the best unit (of equal
    scores the licence last in order of name); reserved rights count where nothing else is
    found. Given ``texts`` of licences, licence files are compared with these as wholes,
    too. A null text is empty; a null path lies in no directory. A directory's licence is
    that of its best-scoring licence file. Repeated rows count once, other columns are not
    read. Texts are read whole, however long: of them only windows, and lines and sentences
    no longer than these, go on.
    """
    stage = stage_in(spark, "licences")
    source = files.select(named(path).cast("string").alias("path"), text_of(text).alias("text"))
    key = F.coalesce(F.concat(F.lit("at "), "path"), F.lit("nowhere"))
    source = source.withColumns({"mark": F.xxhash64("text"), "key": key})
    known = source.select("key", "path", "mark", F.regexp_count(F.lower("text"), F.lit(TERM)).alias("n_terms"))
    known = stage(known.groupBy("key", "path", "mark").agg(F.first("n_terms").alias("n_terms")))
    found = notices(spark, source, stage, texts)

    best = F.max(F.struct((F.col("licence") != RESERVED).alias("granted"), "score", "licence")).alias("best")
    headers = found.groupBy("key", "mark").agg(best, F.max("n_terms").alias("noticed"))
    headers = known.join(headers, ["key", "mark"], "left")
    headers = stage(headers.select("key", "path", "mark", "n_terms", "noticed", "best.granted", "best.licence", "best.score"))
    stated = headers.where(F.col("licence").isNotNull() & F.col("path").isNotNull())
    stated = stated.where(F.col("path").rlike(FILE_NAME) | (F.col("noticed") * 100 >= F.col("n_terms") * FILE_PERCENT))
    dirs = stated.select(F.regexp_replace("path", r"/?[^/]*$", "").alias("dir"), "granted", "score", "licence")
    best = F.max(F.struct("granted", "score", "licence")).alias("best")
    dirs = dirs.groupBy("dir").agg(best).select("dir", F.col("best.licence").alias("stated"))

    above = headers.where("path is not null").select("key", "mark", F.explode(ancestors(F.col("path"))).alias("up"))
    nearest = above.select("key", "mark", "up.depth", "up.dir").join(dirs, "dir")
    nearest = nearest.groupBy("key", "mark").agg(F.max(F.struct("depth", "dir", "stated")).alias("near"))
    own = F.col("licence").isNotNull()
    return headers.join(nearest, ["key", "mark"], "left").select(
        "path",
        "mark",
        F.col("licence").alias("header_licence"),
        F.col("score").alias("header_score"),
        F.when(~own, F.col("near.stated")).alias("inherited_licence"),
        F.when(~own, F.col("near.dir")).alias("inherited_from"),
        F.coalesce("licence", "near.stated").alias("licence"),
    )
