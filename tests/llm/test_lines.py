from __future__ import annotations

import random
import re
from collections import defaultdict

from tidemark.llm import lines

from .conftest import prose
from .test_near import brute


def shingles(line):
    """All runs of ten characters; a shorter line is one."""
    return {line[i : i + 10] for i in range(max(1, len(line) - 9))}


def visible(text):
    return [(n, x.strip(" ").lower()) for n, x in enumerate((text or "").split("\n")) if re.search(r"[^\s]", x)]


def expected(rows):
    """(doc_id, line_no) of the first line of each line's component, by comparing all lines."""
    places = [(i, n, x) for i, t in rows for n, x in visible(t)]
    roots = brute([shingles(x) for _, _, x in places])
    return {places[k][:2]: places[r][:2] for k, r in enumerate(roots)}


def table(seed, n):
    pick = random.Random(seed)
    pool = [prose(50 + i, pick.randint(8, 40)).replace("\n", " ") for i in range(25)]
    rows = []
    for i in range(n):
        out = []
        for _ in range(pick.randint(1, 6)):
            words = pick.choice(pool).split(" ") if pick.random() < 0.6 else prose(pick.randrange(10**6), 15).replace("\n", " ").split(" ")
            if pick.random() < 0.4:
                words[-1] = "other."
            out.append(" ".join(words))
        rows.append((i, "\n".join(out) + ("\n\n" if i % 3 else "")))
    return rows


def test_equal_to_brute_force(spark, documents_of):
    rows = table(4, 60)
    wanted = expected(rows)
    got = {(r.doc_id, r.line_no): (r.first_doc_id, r.first_line_no) for r in lines.duplicate_lines(spark, documents_of(rows)).collect()}
    assert got == wanted and any(k != v for k, v in wanted.items())


def test_kept_lines_rebuild_the_texts(spark, documents_of):
    rows = table(9, 40)
    wanted = expected(rows)
    docs = documents_of(rows)
    out = lines.without_duplicate_lines(spark, docs)
    assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    got = {r.doc_id: r for r in out.collect()}
    for i, text in rows:
        rest = "\n".join(x for n, x in enumerate(text.split("\n")) if wanted.get((i, n), (i, n)) == (i, n))
        if rest.strip():
            assert got[i].text == rest and got[i].n_chars == len(rest)
        else:
            assert i not in got


def test_odd_rows(spark, documents_of, odd_rows):
    docs = documents_of(odd_rows)
    got = lines.duplicate_lines(spark, docs).collect()
    assert {r.doc_id for r in got if r.kept} >= {1, 7, 8, 9, 10, 11} and not any(r.kept for r in got if r.doc_id == 2)
    out = lines.without_duplicate_lines(spark, docs).collect()
    kept = [r.doc_id for r in out]
    # Repeated rows count as one document; the second copy of a text goes; rows without lines stay.
    assert kept.count(1) == 2 and kept.count(2) == 0 and {4, 5, 6, 12} <= set(kept)
    assert next(r for r in out if r.doc_id == 4).text is None
    assert lines.without_duplicate_lines(spark, documents_of([])).count() == 0


def test_text_without_spaces(spark, documents_of):
    pick = random.Random(1)
    a = "".join(pick.choices("abcdefghij", k=400))
    rows = [(1, a), (2, a[:200] + "Z" + a[200:]), (3, a[:40] + "".join(pick.choices("klmnop", k=360)))]
    got = {r.doc_id: r.kept for r in lines.duplicate_lines(spark, documents_of(rows)).collect()}
    assert got == {1: True, 2: False, 3: True}


def test_all_shingles_count(spark, documents_of):
    """Lines that differ only in the last characters of words are compared by all their shingles."""
    pairs = [
        ("measurement-1 failed", "measurement-2 failed"),
        ("9780143039433", "9780143039471"),
        ("temperature:21", "temperature:38"),
        ("这是一个测试文本的甲乙", "这是一个测试文本的丙丁"),
        ("short", "shore"),
        ("\U0001f600" * 11 + "a", "\U0001f600" * 11 + "b"),
    ]
    same = "all of this line is as it was in the other document, but for its last sign"
    rows = [(i, x) for i, x in enumerate([x for p in pairs for x in p] + [same + "!", same + "?"])]
    got = {(r.doc_id, r.line_no): (r.first_doc_id, r.first_line_no) for r in lines.duplicate_lines(spark, documents_of(rows)).collect()}
    assert got == expected(rows)
    assert sum(k != v for k, v in got.items()) == 1 and got[(13, 0)] == (12, 0)


def test_signed_shingles(spark):
    """Every line has some; those of a line are among all of its shingles, and begin where the rule says."""
    from pyspark.sql import functions as F

    texts = [prose(8, n).replace("\n", " ") for n in (1, 3, 20, 200)] + ["x" * n for n in (1, 9, 10, 11, 73, 74)] + ["\U0001f600é" * 50, "ab\r", "a b", "q1"]
    df = spark.createDataFrame([(t,) for t in texts], "line string")
    for r in df.select("line", lines.shingles(F.col("line")).alias("all"), lines.signed(F.col("line")).alias("signed")).collect():
        assert set(r["all"]) == shingles(r.line)
        want = [x for i, x in enumerate(r["all"]) if i == 0 or not re.match("[a-u]", r.line[i - 1])]
        assert r.signed == want and want


def edited(pick, line):
    words = line.split(" ")
    how = pick.random()
    if how < 0.4:
        for _ in range(pick.randint(1, 3)):
            words[pick.randrange(len(words))] = "".join(pick.choices("abcdefghilmnoprstu", k=pick.randint(2, 9)))
    elif how < 0.7:
        signs = list(line)
        for _ in range(pick.randint(1, 4)):
            signs[pick.randrange(len(signs))] = pick.choice("abcdefghijklmnopqrstuvwxyz 01")
        return "".join(signs).strip()
    elif how < 0.85:
        words.append("".join(pick.choices("abcdefgh ilmnop", k=max(2, len(line) // 6))).strip() or "x")
    else:
        del words[pick.randrange(len(words))]
    return " ".join(words).strip()


def test_recall_of_the_bands(spark):
    """Of pairs whose whole sets are similar enough, nearly all share a bucket."""
    from pyspark.sql import functions as F

    pick = random.Random(12)
    pool = [prose(i, pick.randint(6, 30)).replace("\n", " ") for i in range(300)]
    pool += ["".join(pick.choices("0123456789", k=60)) for _ in range(30)] + ["".join(pick.choices("abcdefghijklmnopqrstuvwxyz", k=80)) for _ in range(30)]
    pairs = []
    while len(pairs) < 1_500:
        a = pick.choice(pool)
        b = edited(pick, a)
        x, y = shingles(a), shingles(b)
        if 0.75 <= len(x & y) / len(x | y) < 0.9 and a != b:
            pairs.append((a, b))
    texts = sorted({t for p in pairs for t in p})
    df = spark.createDataFrame([(t,) for t in texts], "line string").withColumn("node", F.xxhash64("line"))
    node = {r.line: r.node for r in df.collect()}
    buckets = defaultdict(set)
    for r in lines.signatures(df).collect():
        buckets[r.node].add(r.bucket)
    found = sum(bool(buckets[node[a]] & buckets[node[b]]) for a, b in pairs)
    assert found / len(pairs) > 0.98, found / len(pairs)


def test_links_by_unsigned_shingles(spark, documents_of):
    """Lines that share all but their first shingle are linked, though the shingles behind
    letters a to u, which alone made signatures, have none in common."""
    pick = random.Random(3)
    a = "".join(pick.choices("abcdefghijklmnopqrstu", k=300))
    b = "x" + a[1:]
    assert len(shingles(a) & shingles(b)) * 100 >= 75 * len(shingles(a) | shingles(b))
    rows = [(1, a), (2, b), (3, "a line of its own here")]
    got = {(r.doc_id, r.line_no): (r.first_doc_id, r.first_line_no) for r in lines.duplicate_lines(spark, documents_of(rows)).collect()}
    assert got == {(1, 0): (1, 0), (2, 0): (1, 0), (3, 0): (3, 0)}
    kept = {r.doc_id for r in lines.without_duplicate_lines(spark, documents_of(rows)).collect()}
    assert kept == {1, 3}
