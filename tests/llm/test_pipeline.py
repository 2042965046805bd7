"""The pipeline against plain versions of its five stages."""

from __future__ import annotations

import random
import re
import zlib
from collections import defaultdict

import corpus_pipeline
from tidemark.llm import packing, quality

from .conftest import prose
from .test_decontamination import tiled
from .test_lines import expected as first_lines
from .test_near import brute, family, shingles
from .test_packing import expected as token_ids
from .test_quality import base


def line_fails(line):
    words, signs = len(line.split(" ")), len(re.findall(quality.MENU, line))
    if signs >= 2 and signs * 4 >= words - signs:
        return True
    symbols, shouts = len(re.findall(r"[#*$%&<>{}~^\\=_]", line)), len(re.findall(r"[!?]{2,}|…{2,}", line))
    if symbols * 5 > words or shouts * 5 > words:
        return True
    if not re.search(quality.SENTENCE, line) and line[-1] not in ".!?" and not re.search(quality.OTHER_SENTENCE, line):
        parts = re.findall("[^\x20\x09-\x0d]+", line)
        if len(parts) <= 4 or 2 * len(set(parts)) <= len(parts) or 3 * sum(p[0].isupper() for p in parts) > 2 * len(parts):
            return True
    return any(n in line.lower() and 100 * len(n) >= 5 * len(line) for n in quality.NOTICES)


def cleaned(rows):
    out = []
    for i, text in rows:
        n, _, _, _, repeated = base(text or "")
        kept = "\n".join(x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x) and not line_fails(x))
        if n >= 20 and 100 * (repeated or 0) <= 30 * n and 100 * len(kept.split()) >= 50 * n:
            out.append((i, kept))
    return out


def without_lines(rows):
    firsts = first_lines(rows)
    out = []
    for i, text in rows:
        rest = "\n".join(x for n, x in enumerate(text.split("\n")) if firsts.get((i, n), (i, n)) == (i, n))
        if rest.strip():
            out.append((i, rest))
    return out


def one_of_each(rows):
    roots = brute([shingles(t) for _, t in rows])
    return [row for k, row in enumerate(rows) if roots[k] == k]


def without_leaks(rows, items):
    return [(i, t) for i, t in rows if not any(n * 100 >= 60 * m for n, m in (tiled(t, item) for item in items) if m)]


def corpus():
    pick = random.Random(8)
    texts = family(11, 14, 60) + family(12, 8, 90) + [prose(300 + i, pick.randint(15, 120)) for i in range(25)]
    items = [prose(900 + i, 25).replace("\n", " ") for i in range(4)]
    texts += [prose(400 + i, 40) + "\n" + items[i % 4] for i in range(4)]
    texts += [" | ".join(prose(500 + i, 40).split()) for i in range(3)]
    # The words of one text, broken into other lines: line dedup leaves them, as documents they are alike.
    texts += ["\n".join(" ".join(rewrapped[a:b]) for a, b in zip((0, *cuts), (*cuts, len(rewrapped)), strict=True))
              for cuts in ((20, 40, 60), (10, 30, 50, 70)) for rewrapped in [prose(650, 80).split()]]
    texts += [texts[0], texts[30], prose(600, 50) + "\nAll rights reserved.", "!! ".join(prose(601, 40).split()), "", None, "x " * 60]
    pick.shuffle(texts)
    return list(enumerate(texts)), items


def test_run_equals_plain_stages(spark, tmp_path):
    rows, items = corpus()
    docs = spark.createDataFrame(
        [(i, t, "en", "src", None if t is None else len(t)) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    wanted = [cleaned(rows)]
    wanted.append(without_lines(wanted[-1]))
    wanted.append(one_of_each(wanted[-1]))
    wanted.append(without_leaks(wanted[-1], items))
    assert len({len(x) for x in [rows, *wanted]}) == 5

    now = docs
    for (name, stage), rest in zip(corpus_pipeline.STAGES, wanted, strict=False):
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns, name
        assert sorted((r.doc_id, r.text) for r in now.collect()) == rest, name
        assert all(r.n_chars == len(r.text) for r in now.collect())

    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    got = defaultdict(list)
    for p in pieces:
        got[p.doc_id].append((p.start, p.length, p.ids_crc32, p.doc_tokens))
    ids = dict(zip((i for i, _ in wanted[-1]), token_ids([t for _, t in wanted[-1]]), strict=True))
    assert set(got) == set(ids)
    for i, parts in got.items():
        assert sum(n for _, n, _, _ in parts) == len(ids[i])
        for start, n, crc, total in parts:
            raw = b"".join(x.to_bytes(4, "little") for x in ids[i][start : start + n])
            assert zlib.crc32(raw) == crc and total == len(ids[i])
    sequences = defaultdict(int)
    for p in pieces:
        sequences[p.sequence_id] += p.length
    assert max(sequences.values()) <= packing.LENGTH


def test_names_and_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "decontamination", "packing"]


def test_odd_documents(spark, tmp_path, documents_of, odd_rows):
    """Nulls, repeated rows, a long text and clashing columns through every stage."""
    docs = documents_of(odd_rows)
    spark.createDataFrame([(None, None), (1, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns and dict(now.dtypes) == dict(docs.dtypes), name
        kept = now.collect()
        assert all(r["a.b"] == f"a.b{r.doc_id}" for r in kept), name
    assert {r.doc_id for r in kept} <= {1, 2, 3, 9, None} and {1, 9} <= {r.doc_id for r in kept}
    pieces = corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path)).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in kept}


def test_no_documents(spark, tmp_path, documents_of):
    documents_of([]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "some item of the benchmark")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
