from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import periodic, queries

SF = "/root/testdata/sf0.001"


def plain_runs(t):
    """All periods by walking over the words; the smallest one of each stretch."""
    out = {}
    for p in range(1, len(t) // 3 + 1):
        i = 0
        while i + p < len(t):
            start = i
            while i + p < len(t) and t[i] == t[i + p]:
                i += 1
            if i + p - start >= max(24, 3 * p):
                out.setdefault((start, i + p - start), p)
            i += 1
    return sorted(((s, n, p) for (s, n), p in out.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def repeating(pick, n):
    t = [pick.randrange(pick.choice([1, 2, 3, 40])) for _ in range(pick.randint(0, n))]
    for _ in range(pick.randint(0, 3)):
        a, p = pick.randint(0, len(t)), pick.randint(1, 45)
        block = t[a : a + p] or [0]
        t[a:a] = [block[i % len(block)] for i in range(pick.randint(1, 4 * n))]
    return np.array(t, dtype=np.int32)


@pytest.mark.parametrize("seed", range(60))
def test_runs_equal_plain_ones(seed):
    pick = random.Random(seed)
    texts = [repeating(pick, pick.choice([10, 60, 200])) for _ in range(pick.randint(1, 5))]
    assert periodic.runs_of(texts) == [plain_runs(t.tolist()) for t in texts]


def test_cover_has_every_difference():
    v, cover = periodic.MODULUS, periodic.COVER
    assert {(a - b) % v for a in cover for b in cover} == set(range(v))


@pytest.mark.parametrize("n", [1, 2, 30, 31, 32, 500, 3_000])
def test_extensions(n):
    pick = np.random.default_rng(n)
    words = np.tile(pick.integers(0, 3, max(1, n // 7)), 8)[:n].astype(np.int32)
    held = periodic.Extensions(words)
    i, j = pick.integers(0, n + 1, 400), pick.integers(0, n + 1, 400)
    i, j = i[i != j], j[i != j]

    def plain(a, b):
        k = 0
        while max(a, b) + k < len(words) and words[a + k] == words[b + k]:
            k += 1
        return k

    assert held.lce(i, j).tolist() == [plain(a, b) for a, b in zip(i, j, strict=True)]


def test_odd_rows(spark, documents_of, odd_rows):
    rows = [(i, t) for i, t in odd_rows if t is None or len(t) < 200_000]
    found = periodic.periodic_runs(documents_of(rows)).collect()
    got = sorted(repr((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed)) for r in found)
    want = []
    for i, text in rows:
        words = words_of(text)
        runs = plain_runs(words)
        want.append(repr((i, len(words), runs, collapsed(words, runs))))
    assert got == sorted(want)


def test_long_texts_and_empty_table(spark, documents_of):
    stretch = [f"w{i}" for i in range(7_000)]
    rows = [(1, " ".join(stretch * 4)), (2, "a\n" * 100_000), (3, " ".join(f"v{i}" for i in range(200_000)))]
    found = {r.doc_id: r for r in periodic.periodic_runs(documents_of(rows)).collect()}
    assert [tuple(x) for x in found[1].runs] == [(0, 28_000, 7_000)] and found[1].collapsed == " ".join(stretch)
    assert [tuple(x) for x in found[2].runs] == [(0, 100_000, 1)] and found[2].collapsed == "a"
    assert found[3].runs == [] and found[3].collapsed == rows[2][1]
    assert periodic.periodic_runs(documents_of([])).collect() == []


def planted(id, text):
    """A document's words as the query plants them."""
    words = words_of(text)
    h = zlib.crc32(str(id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def answer(id, text):
    words = planted(id, text)
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    milli = 1000 * best[1] // best[2] if runs else None
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    return (id, len(runs), *best, milli, digest(listed), digest(collapsed(words, runs)))


def test_query_equals_plain_version(spark, tmp_path):
    docs = [tuple(r) for r in queries.table(spark, SF, "documents").select("doc_id", "text").collect()]
    docs = [(i, t) for i, t in docs if len(words_of(t)) < 1_200]
    x = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    docs += [(900_000 + i, " ".join([x] * k + ["tail"] + ["q q r"] * (3 * k))) for i, k in enumerate((1, 3, 4, 9))]
    docs += [(910_000 + i, t) for i, t in enumerate([None, "", " \n", "one", *["la " * k for k in (23, 24, 25)]] * 20)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    names = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    found = queries.op12_periodic(spark, str(tmp_path))
    assert tuple(found.columns) == names and {t for n, t in found.dtypes if "sha" not in n} == {"bigint"}
    got = {r.doc_id: tuple(r) for r in found.collect()}
    assert got == {i: answer(i, t) for i, t in docs}
    assert sum(r[1] > 0 for r in got.values()) > 20 and any(r[1] > 1 for r in got.values())
