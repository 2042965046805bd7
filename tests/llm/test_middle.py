from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import middle


def expected(id, text, rate=90, suffix_first=20):
    """Units and cuts by a plain regular expression and prefix sums."""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    h = [int(x, 16) for x in re.findall("." * 8, hashlib.sha256(f"1:{'' if id is None else id}".encode()).hexdigest())]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return (id, len(units), "plain", None, None, text)
    if h[3] % 100 < suffix_first:
        return (id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def answers(df):
    again = middle.restored(F.col("form"), F.col("output")).alias("again")
    return df.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", again).collect()


@pytest.mark.parametrize("n", [0, 1, 2, 9, 100, 30_000])
def test_descent_reaches_every_rank(n):
    widths = np.random.default_rng(n).integers(1, 9, n)
    held = middle.SkipList(widths)
    assert (held.seek(np.arange(n + 1)) == np.concatenate(([0], np.cumsum(widths)))).all()
    for units, points, below in zip(held.units, held.points, held.down, strict=True):
        assert len(units) == len(points) == len(below) - 1
    # Each lane holds some quarter of the nodes of the lane below it.
    assert len(held.units) <= 2 + np.log(max(4, n)) / np.log(2)


def test_odd_rows(spark, documents_of, odd_rows):
    found = answers(middle.middle_last(documents_of(odd_rows)))
    assert sorted(map(repr, (tuple(r)[:6] for r in found))) == sorted(repr(expected(i, t or "")) for i, t in odd_rows)
    texts = sorted(t or "" for _, t in odd_rows)
    assert sorted(r.again for r in found) == texts


def test_forms_marks_and_characters(spark, documents_of):
    texts = ["añb—c 日本語 𝔘𝔫 \x00\x7f é", "<P", "<S<S", "a<P>b", "x <M> y", "<s> <m>", "<<<>>>", "S>P>M>", "one\r\ntwo three"]
    rows = [(i, texts[i % len(texts)]) for i in range(400)]
    found = answers(middle.middle_last(documents_of(rows)))
    assert sorted(tuple(r)[:6] for r in found if r.form != "plain") == sorted(x for x in (expected(i, t) for i, t in rows) if x[2] != "plain")
    assert {(r.doc_id, r.again) for r in found} == set(rows)
    forms = [r.form for r in found]
    assert forms.count("psm") > forms.count("spm") > 0 and "plain" in forms


def test_rates(spark, documents_of):
    rows = [(i, "some words here") for i in range(60)]
    assert {r.form for r in answers(middle.middle_last(documents_of(rows), rate=0))} == {"plain"}
    assert {r.form for r in answers(middle.middle_last(documents_of(rows), rate=100, suffix_first=100))} == {"spm"}


def test_empty_table_and_a_million_characters(spark, documents_of):
    assert answers(middle.middle_last(documents_of([]))) == []
    rows = [(1, "é " * 500_000), (2, "x" * 1_000_000), (3, "ab,")]
    found = answers(middle.middle_last(documents_of(rows)))
    assert sorted(tuple(r)[:6] for r in found) == [expected(i, t) for i, t in rows]
