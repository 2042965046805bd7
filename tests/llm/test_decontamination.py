from __future__ import annotations

import random
import re
import tracemalloc

import numpy as np
import pytest

from tidemark.llm import decontamination

from .conftest import prose

WORD = re.compile(r"[0-9a-z\u0080-\U0010ffff]+")


def words(text):
    return WORD.findall((text or "").lower())


def tiled(text, item, least=5):
    """Greedy string tiling by looking at all pairs of places: words of the item covered."""
    t, p = words(text), words(item)
    least = min(least, len(p))
    mt, mp = [False] * len(t), [False] * len(p)
    while True:
        best = (0, 0, 0)
        for i in range(len(t)):
            for j in range(len(p)):
                k = 0
                while i + k < len(t) and j + k < len(p) and t[i + k] == p[j + k] and not mt[i + k] and not mp[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        n, i, j = best
        if not p or n < least:
            return sum(mp), len(p)
        mt[i : i + n] = mp[j : j + n] = [True] * n


def cases(seed):
    pick = random.Random(seed)
    items = [(i, prose(700 + i, pick.randint(12, 40)).replace("\n", " ")) for i in range(12)]
    docs = []
    for d in range(80):
        parts = [prose(d, pick.randint(5, 40))]
        for _ in range(pick.randint(0, 2)):
            item = pick.choice(items)[1].split(" ")
            how = pick.random()
            if how < 0.3:
                cut = pick.randint(4, len(item) - 4)
                item = item[cut:] + ["between", "these"] + item[:cut]
            elif how < 0.6:
                for _ in range(pick.randint(1, 3)):
                    item[pick.randrange(len(item))] = "changed"
            elif how < 0.7:
                item = [w.upper() + "," for w in item]
            parts.append(" ".join(item))
        pick.shuffle(parts)
        docs.append((d, "\n".join(parts)))
    return docs, items


def test_equal_to_brute_force(spark, documents_of):
    docs, items = cases(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontamination.mark_leaks(spark, documents_of(docs), bench)
    got = {r.doc_id: sorted((x.item_id, x.covered, x.words) for x in r.leaks) for r in out.collect()}
    wanted = {}
    for d, text in docs:
        found = [(i, *tiled(text, item)) for i, item in items]
        wanted[d] = sorted(x for x in found if x[1] * 100 >= 60 * x[2])
    assert got == wanted
    assert sum(map(bool, wanted.values())) > 20


def test_odd_rows(spark, documents_of, odd_rows):
    docs = documents_of([*odd_rows, (20, prose(5, 30) + " short item"), (21, "A " * 500)])
    bench = spark.createDataFrame(
        [(1, "short ITEM!"), (1, "short ITEM!"), (None, prose(5, 30)), (2, None), (3, ""), (4, "..."), (5, "a a a a a a a a a")],
        "item_id long, text string",
    )
    out = decontamination.mark_leaks(spark, docs, bench)
    assert out.columns == [*docs.columns, "leaks"]
    got = {(r.doc_id, len(r.text or "")): [x.item_id for x in r.leaks] for r in out.collect()}
    assert got[(20, len(prose(5, 30)) + 11)] == [None, 1] and got[(21, 1000)] == [5] and got[(11, 6000)] == [5]
    kept = decontamination.decontaminated(spark, docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(odd_rows) - 1
    assert decontamination.decontaminated(spark, documents_of([]), bench).count() == 0
    assert decontamination.decontaminated(spark, docs, bench.limit(0)).count() == len(odd_rows) + 2


def seeds_of(tokens, width):
    hashed = [hash(("seed", *tokens[i : i + width])) & (2**64 - 1) for i in range(len(tokens) - width + 1)]
    return np.array(hashed, dtype=np.uint64)


@pytest.mark.parametrize("seed", range(150))
def test_tiles_equal_plain_tiling(seed):
    """Texts and items of few words, so that matches repeat, overlap and tie."""
    pick = random.Random(seed)
    letters = "abcdef"[: pick.randint(1, 6)]
    text = [pick.choice(letters) for _ in range(pick.randint(5, 60))]
    item = [pick.choice(letters) for _ in range(pick.randint(5, 40))]
    if pick.random() < 0.5:
        cut = pick.randrange(len(item))
        text += item[cut:] + ["zz"] + item[:cut]
    mine, its = seeds_of(text, 5), seeds_of(item, 5)
    at = np.flatnonzero(np.isin(mine, its))
    found = decontamination.tiles(at, mine[at], its, 5)
    assert sum(n for _, _, n in found) == tiled(" ".join(text), " ".join(item))[0]
    assert all(text[d : d + n] == item[p : p + n] for d, p, n in found)


def test_equal_words_take_little_memory():
    n = 20_000
    same = seeds_of(["a"] * (n + 4), 5)
    tracemalloc.start()
    assert decontamination.tiles(np.arange(n), same, same, 5) == [(0, 0, n + 4)]
    assert [x[2] for x in decontamination.tiles(np.arange(n), same, same[:1_500], 5)] == [1_504]
    assert tracemalloc.get_traced_memory()[1] < 50_000_000
    tracemalloc.stop()


def test_many_texts_with_one_passage(spark, documents_of):
    """A passage that a third of the texts hold is tiled once: wherever it lies, the pattern is the same."""
    item = prose(900, 30).replace("\n", " ")
    docs = [(i, prose(i, 20 + i % 7) + (" " + item if i % 3 == 0 else "")) for i in range(120)]
    bench = spark.createDataFrame([(7, item), (8, prose(901, 30))], "item_id long, text string")
    out = decontamination.mark_leaks(spark, documents_of(docs), bench).collect()
    assert {r.doc_id for r in out if r.leaks} == {i for i in range(0, 120, 3)}
    assert all([(x.item_id, x.covered, x.words) for x in r.leaks] == [(7, 30, 30)] for r in out if r.leaks)


def test_a_text_of_a_million_characters(spark, documents_of):
    item = prose(910, 40).replace("\n", " ")
    bench = spark.createDataFrame([(1, item), (2, "a " * 300)], "item_id long, text string")
    docs = [(1, "word " * 200_000 + item), (2, "a " * 500_000), (3, "x" * 1_000_000)]
    out = {r.doc_id: [x.item_id for x in r.leaks] for r in decontamination.mark_leaks(spark, documents_of(docs), bench).collect()}
    assert out == {1: [1], 2: [2], 3: []}
