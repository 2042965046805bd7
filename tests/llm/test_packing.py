from __future__ import annotations

import zlib
from array import array
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from tidemark.llm import packing, queries
from tidemark.llm.tokens import encoder, open_tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


def expected(texts):
    tokenizer = open_tokenizer(PATH)
    return [[*e.ids, 1] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def check(pieces, rows):
    """Every id of every document once, sequences gapless and full, but for one a block."""
    wanted = defaultdict(list)
    for (i, _), ids in zip(rows, expected([t or "" for _, t in rows]), strict=True):
        wanted[i].append(ids)
    got = defaultdict(list)
    for p in pieces:
        got[p.doc_id].append((p.start, p.length, zlib.crc32(p.ids), p.doc_tokens))
    assert set(got) == set(wanted)
    for i, lists in wanted.items():
        assert sum(x[1] for x in got[i]) == sum(map(len, lists))
        assert {x[3] for x in got[i]} == {len(x) for x in lists}
        if len({tuple(x) for x in lists}) == 1:
            ids = array("I", lists[0])
            assert all(zlib.crc32(ids[s : s + n].tobytes()) == c for s, n, c, _ in got[i])
            cover = np.zeros(len(ids), int)
            for s, n, _, _ in got[i]:
                cover[s : s + n] += 1
            assert (cover == len(lists)).all()
    sequences = defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length > 0
        sequences[p.sequence_id].append((p.offset, p.length))
    short = defaultdict(int)
    for s, parts in sequences.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= packing.LENGTH
        short[s >> 32] += packing.LENGTH - at
    assert all(n < packing.LENGTH for n in short.values())


def test_odd_rows(spark, documents_of, odd_rows):
    out = packing.packed(spark, documents_of(odd_rows), PATH, block_bytes=50_000)
    assert out.columns == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    check(out.collect(), odd_rows)


def test_empty_table(spark, documents_of):
    assert packing.packed(spark, documents_of([]), PATH).count() == 0


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    out = queries.op1_packing(spark, SF)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(packing.packed(spark, docs, PATH).collect(), rows)
    assert out.agg({"length": "sum"}).first()[0] == sum(map(len, expected([t or "" for _, t in rows])))


def test_lowest_cost_with_room():
    sizes = np.array([2000, 1500, 1000, 500, 40, 30, 20])
    out = packing.balanced(sizes, 2048)
    assert sorted(p for p, *_ in out if p < 4) == [0, 1, 2, 3]
    by_sequence = defaultdict(list)
    for piece, _, take, at, _ in out:
        by_sequence[at].append((piece, take))
    # 5,090 tokens need three sequences; the 500 go to the cheapest, that of the 1,000.
    assert len(by_sequence) == 3
    assert next(at for at, x in by_sequence.items() if (3, 500) in x) == next(at for at, x in by_sequence.items() if (2, 1000) in x)


@pytest.mark.parametrize("text", ["a  b", " a", "a ", "x\n y", "<|endoftext|>", "it's", "a　 b", "\x1c a", ""])
def test_words_encode_alone(text):
    assert encoder(PATH)([text]) == [array("I", expected([text])[0][:-1]).tobytes()]
