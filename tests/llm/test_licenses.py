from __future__ import annotations

import math
import os
import re
from collections import Counter

import pytest

from tidemark.llm import licenses, queries

from .conftest import prose


def units(text):
    """Sentences and lines of at most 40 terms, and windows of 40 terms, 20 apart."""

    def terms(x):
        return re.findall(r"[a-z0-9]+(?:\.[0-9]+)*", x.lower())

    lines = text.split("\n")
    short = [terms(x) for x in lines] + [terms(y) for x in lines for y in re.split(r"[.;:]\s+", x)]
    all_of_it = terms(text)
    windows = [all_of_it[k : k + 40] for k in range(0, max(len(all_of_it) - 20, 1), 20)]
    return [x for x in short if len(x) <= 40 and x] + [x for x in windows if x]


def brute(files):
    """(path, text) -> (licence, score) by plain TF-IDF over all files and all terms."""
    known = set(licenses.vocabulary())
    held = [set(re.findall(licenses.TERM, (x or "").lower())) for _, x in files]
    idf = {t: math.log((len(files) + 1) / (sum(t in h for h in held) + 1)) + 1 for t in known}
    other = sum(idf.values()) / len(idf)

    def unit(counts):
        weights = {t: n * idf.get(t, 1.0 if t in licenses.COMMON else other) for t, n in counts.items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        return {t: w / norm for t, w in weights.items()}

    models = [(n, name, unit(c)) for n, name, _, c in licenses.templates()]
    out = {}
    for path, text in files:
        best = None
        for found in units(text or ""):
            own = unit(Counter(found))
            scores = [(round(sum(w * own.get(t, 0) for t, w in model.items()), 6), -n, name) for n, name, model in models]
            score, _, name = max(scores)
            if score >= licenses.LEAST:
                best = max(best or (False, 0, ""), (name != licenses.RESERVED, score, name))
        out[(path, text)] = best and (best[2], best[1])
    return out


FILES = [
    ("a/LICENSE", "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("a/b/COPYING.txt", "Licensed under the GNU Lesser General Public License, version 3"),
    ("a/b/c/x.txt", prose(1, 60)),
    ("a/y.txt", prose(2, 60)),
    ("a/b/z.txt", prose(3, 60) + "\nLicensed under the Apache License, Version 2.0.\n"),
    ("q/notice.txt", "Licensed under CC BY-NC 4.0."),
    ("q/r/s/t.txt", prose(4, 20)),
    ("top.txt", "All rights reserved. " + prose(5, 30)),
    ("top2.txt", "This text says nothing of any license version."),
    (None, "Released under the MIT License."),
    (None, None),
    ("u/empty.txt", ""),
    ("u/empty.txt", ""),
]


def table(spark, files):
    return spark.createDataFrame([(p, t, "x") for p, t in files], "path string, text string, licence string")


def test_equal_to_brute_force(spark):
    got = licenses.licensed(spark, table(spark, FILES)).collect()
    assert len(got) == len(set(FILES))
    wanted = brute(FILES)
    texts = {r.mark: r.text for r in table(spark, FILES).selectExpr("xxhash64(coalesce(text, '')) as mark", "text").collect() if r.text}
    for r in got:
        best = wanted.get((r.path, texts.get(r.mark)), wanted.get((r.path, "")))
        assert (r.header_licence, r.header_score) == (best or (None, None))
    inherited = {r.path: (r.inherited_licence, r.inherited_from) for r in got if r.inherited_licence}
    assert inherited == {"a/b/c/x.txt": ("LGPL-3.0", "a/b"), "a/y.txt": ("MIT", "a"), "q/r/s/t.txt": ("CC-BY-NC-4.0", "q")}
    assert {r.path: r.licence for r in got if r.path}["a/b/z.txt"] == "Apache-2.0"
    assert licenses.licensed(spark, table(spark, [])).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op8_licenses(spark, sf).collect()
    wanted = brute(list(docs.items()))
    assert {r.doc_id: r.header_licence and (r.header_licence, r.header_score) for r in rows} == {i: wanted[(i, t)] for i, t in docs.items()}
    assert any(r.header_licence for r in rows)


WHOLE = "/usr/share/common-licenses"
NAMES = {
    "Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0", "BSD": "BSD", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL", "GFDL-1.3": "GFDL",
    "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0",
    "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0",
}
MIT = """Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software. All rights reserved."""


def corpus():
    """Files of prose in which common words are common."""
    return [(f"p/{i}.txt", f"the {prose(i, 80)} of a license and the rights to use it in all of the work") for i in range(40)]


@pytest.mark.skipif(not os.path.isdir(WHOLE), reason="no licence texts here")
@pytest.mark.parametrize("whole", [False, True])
def test_whole_texts_of_licences(spark, whole):
    there = {name: open(f"{WHOLE}/{name}").read() for name in NAMES if os.path.exists(f"{WHOLE}/{name}")}
    files = corpus() + [(f"{name}/LICENSE", text) for name, text in there.items()] + [("MIT/LICENSE", MIT)]
    texts = {NAMES[name]: text for name, text in there.items()} if whole else None
    got = {r.path: r.licence for r in licenses.licensed(spark, table(spark, files), texts=texts).collect()}
    assert {name: got[f"{name}/LICENSE"] for name in there} == {name: NAMES[name] for name in there}
    assert got["MIT/LICENSE"] == "MIT" and all(got[p] is None for p, _ in corpus())


def test_notices_inside_texts(spark):
    files = [
        ("a", prose(1, 30).replace("\n", " ") + " Copyright 2020 Acme. All rights reserved. " + prose(2, 30).replace("\n", " ")),
        ("b", "/*\n * Licensed under the Apache License, Version 2.0 (the \"License\");\n * you may not use this file except in\n * compliance with the License.\n */\n" + prose(3, 200)),
        ("c", "The hotel has all rooms reserved tonight."),
        ("d", "A compliance license is what the office asked for."),
        ("e", "compliance license"),
        ("f", "All rooms are reserved by right of all who were there."),
        ("g", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
        ("h", "x " * 200_000 + ". Released under the MIT License. " + "y " * 200_000),
        ("i", "z" * 1_000_000),
    ]
    got = {r.path: r.header_licence for r in licenses.licensed(spark, table(spark, corpus() + files)).collect()}
    assert {p: got[p] for p, _ in files} == {
        "a": "proprietary", "b": "Apache-2.0", "c": None, "d": None, "e": None, "f": None, "g": "ISC", "h": "MIT", "i": None,
    }


def test_odd_rows(spark, documents_of, odd_rows):
    docs = documents_of([(i, t) for i, t in odd_rows])
    got = licenses.licensed(spark, docs, path="kept")
    assert got.count() == len({(i, t or "") for i, t in odd_rows}) and got.where("licence is not null").count() == 0
