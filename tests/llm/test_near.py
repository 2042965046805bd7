from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import graph, setsketch
from tidemark.session import stage_in

from .conftest import prose

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} - {()}


def brute(sets, percent=75):
    """The smallest index of each set's component."""
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        for j in range(i):
            if s and sets[j] and 100 * len(s & sets[j]) >= percent * len(s | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(sets))]


def family(seed, n, words):
    """Copies of a text, each with a few other words; also copies of copies."""
    pick, texts = random.Random(seed), [prose(seed, words).split(" ")]
    for _ in range(n):
        copy = list(pick.choice(texts))
        for _ in range(pick.randint(0, 3)):
            copy[pick.randrange(len(copy))] = f"new{pick.random()}"
        texts.append(copy)
    return [" ".join(t) for t in texts]


def test_components_equal_brute_force(spark, documents_of):
    texts = family(1, 90, 70) + family(2, 40, 200) + [prose(100 + i, 80) for i in range(40)] + ["a b c", "A B C", "", None]
    random.Random(5).shuffle(texts)
    wanted = brute([shingles(t) for t in texts])
    got = setsketch.near_duplicates(spark, documents_of(list(enumerate(texts)))).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(wanted))
    assert all(r.kept == (r.doc_id == r.component_id) and r.n_shingles == len(shingles(texts[r.doc_id])) for r in got)


def test_odd_rows(spark, documents_of, odd_rows):
    got = setsketch.near_duplicates(spark, documents_of(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    component = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in got}
    a, b = len(shingles(odd_rows[0][1])), len(shingles(odd_rows[3][1]))
    assert component[(1, a)] == (1, True) and component[(2, a)] == (1, False)
    assert component[(3, b)] == (3, True) and component[(None, b)] == (3, False) == component[(None, b + 1)]
    assert component[(4, 0)] == (4, True) and component[(None, 0)] == (None, True)


def test_rows_that_stay(spark, documents_of, odd_rows):
    docs = documents_of(odd_rows)
    out = setsketch.without_near_duplicates(spark, docs)
    assert out.columns == docs.columns
    kept = [r.doc_id for r in out.collect()]
    assert sorted(x for x in kept if x) == [1, 3, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12] and kept.count(None) == 1
    assert setsketch.without_near_duplicates(spark, documents_of([])).count() == 0


def test_without_ids_one_of_a_component_stays(spark, documents_of):
    text = prose(1, 100)
    out = setsketch.without_near_duplicates(spark, documents_of([(None, text), (None, text + " more"), (None, text)]))
    assert out.count() == 1


def test_registers_merge_and_estimate():
    pick = np.random.default_rng(3)
    whole = np.unique(pick.integers(0, 2**64, 3000, dtype=np.uint64))
    a, b = whole[:2500], whole[500:]

    def sketch(x):
        return setsketch.registers(x, np.array([0, len(x)]))

    assert (setsketch.merged(sketch(a), sketch(b)) == sketch(whole)).all()
    likely = setsketch.likely_similarity(sketch(a), sketch(b), np.array([len(a)]), np.array([len(b)]))
    assert abs(likely[0] - 2000 / len(whole)) < 0.15
    same = setsketch.likely_similarity(sketch(a), sketch(a), np.array([len(a)]), np.array([len(a)]))
    assert same[0] > 0.99


def test_graph_components(spark):
    pick = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 200 + i) for i in range(50)] + [(pick.randint(300, 500), pick.randint(300, 500)) for _ in range(120)]
    got = graph.components(spark.createDataFrame(links, "a long, b long"), stage_in(spark, "test"))
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    assert {r.node: r.comp for r in got.collect()} == {x: find(x) for x in list(root)}
    assert graph.components(spark.createDataFrame([], "a long, b long"), stage_in(spark, "test")).count() == 0


def test_links_beside_the_centre_are_found(spark):
    """Members of a bucket that are like each other, but not like its centre."""
    stage = stage_in(spark, "test")
    sets = {1: range(20), 2: range(100, 120), 3: range(101, 121), 4: range(200, 220), 5: range(201, 221), 6: range(300, 310)}
    items = spark.createDataFrame([(k, list(v)) for k, v in sets.items()], "node long, items array<long>")
    buckets = spark.createDataFrame([(7, k) for k in sets], "bucket long, node long")
    members = stage(graph.shared_buckets(buckets))
    comps = graph.linked_components(members, graph.star_pairs(members), items, 75, stage)
    linked = comps.groupBy("comp").agg(F.sort_array(F.collect_list("node")).alias("nodes")).collect()
    assert sorted(r.nodes for r in linked if len(r.nodes) > 1) == [[2, 3], [4, 5]]
