from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.errors import PythonException

from tidemark.llm import queries, rans
from tidemark.llm.tokens import open_tokenizer, word_encoder

from .conftest import prose

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


def expected(texts):
    tokenizer = open_tokenizer(PATH)
    return [[*e.ids, 2] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def table_of(ids, size=49_408):
    return rans.Frequencies.of(np.bincount(ids, minlength=size))


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 32_768, 32_769, 200_000])
def test_round_trip_from_every_checkpoint(n):
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, n) - 1, 49_407).astype(np.uint32)
    table = table_of(ids)
    points, words = rans.encode(ids, table)
    assert (rans.decode(points, words, n, table, rans.STEPS) == ids).all()
    span = rans.STEPS * rans.LANES
    assert len(points) == -(-n // span)
    for k in range(len(points)):
        assert (rans.decode(points, words, n, table, rans.STEPS, k, k + 1) == ids[k * span : (k + 1) * span]).all()
    if n == 200_000:
        share = np.bincount(ids) / n
        bits = -(share[share > 0] * np.log2(share[share > 0])).sum() * n
        assert 8 * words.nbytes < 1.05 * bits


@pytest.mark.parametrize("counts", [[0, 0, 0], [1], [10**15, 0, 1], [0] * 60_000, [3] * 70_000])
def test_shares_fill_the_range(counts):
    share = rans.Frequencies.of(np.array(counts)).share
    assert int(share.sum()) == 1 << rans.BITS and int(share.min()) >= 1


def test_ids_never_counted_are_coded_too():
    table = table_of(np.array([5] * 1000))
    ids = np.array([5, 49_407, 0, 5, 17], dtype=np.uint32)
    block = rans.Block(rans.write_block([1, None], [ids[:2], ids[2:]], table), table)
    assert block.tokens_from().tolist() == ids.tolist() and block.ids == [1, None] and block.lengths.tolist() == [2, 3]


def test_damage_is_found():
    table = table_of(np.arange(100))
    data = rans.write_block([1], [np.arange(100, dtype=np.uint32)], table)
    for at in (0, 20, len(data) // 2, len(data) - 1):
        bad = bytearray(data)
        bad[at] ^= 1
        with pytest.raises(rans.DamagedBlock):
            rans.Block(bytes(bad), table)
    with pytest.raises(rans.DamagedBlock):
        rans.Block(data[:-5], table)
    with pytest.raises(rans.DamagedBlock):
        rans.Block(data, table_of(np.array([3])))


def test_words_are_encoded_as_whole_texts():
    texts = [prose(k, 300) for k in range(4)]
    texts += ["İstanbul ΣΑΣ ǅ ﬁ   x y\x1cz é ́a don't it'S ''s 's", "#~ ## !!?? a1b22 日本語 <|endoftext|> </w>", "\x85\x0b\x0c\r", ""]
    got = [np.frombuffer(x, dtype="<u2").tolist() for x in word_encoder(PATH, "<u2")(pa.array(texts)).to_pylist()]
    assert [[*x, 2] for x in got] == expected(texts)


def test_words_of_all_kinds_equal_the_library():
    """Every word of the vocabulary, made-up ones, and every character below U+0600 inside a word."""
    pick = random.Random(5)
    tokenizer = open_tokenizer(PATH)
    vocabulary = [tokenizer.id_to_token(i).replace("</w>", "") for i in range(0, 49_000, 7)]
    words = [w for w in vocabulary if w.isascii()]
    words += ["".join(pick.choices(words, k=3)) for _ in range(20_000)]
    words += ["".join(pick.choices("abcdefghijklmnopqrstuvwxyzABCéßøñ'-.,0123!#", k=pick.randint(1, 25))) for _ in range(20_000)]
    words += [f"a{chr(c)}{x}" for c in range(33, 0x600) for x in ("", "b", "\u0301", "s!")]
    got = word_encoder(PATH, "<u2")(pa.array(words)).to_pylist()
    want = tokenizer.encode_batch(words, add_special_tokens=False)
    assert [np.frombuffer(g, dtype="<u2").tolist() for g in got] == [e.ids for e in want]


def check(rows, found):
    """In order of the ids read back: gapless starts, and every document's ids."""
    got = sorted(found, key=lambda r: r.start)
    ends = [r.start + r.n_tokens for r in got]
    assert [r.start for r in got] == [0, *ends][: len(got)]
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    ids = expected([t for _, t in rows])
    want = sorted(repr((i, len(x), crc(x))) for (i, _), x in zip(rows, ids, strict=True))
    assert sorted(repr((r.doc_id, r.n_tokens, zlib.crc32(r.ids))) for r in got) == want


@pytest.mark.parametrize("block", [1, 700, rans.BLOCK])
def test_files_give_back_odd_rows(spark, documents_of, odd_rows, path, block):
    rows = odd_rows + [(-5, "negative"), (20, "word " * 3_000), (20, "## #~ #a")]
    rans.write_tokens(spark, documents_of(rows), PATH, path, block=block)
    check(rows, rans.read_tokens(spark, path).collect())


def test_empty_table(spark, documents_of, path):
    rans.write_tokens(spark, documents_of([]), PATH, path)
    assert rans.read_tokens(spark, path).collect() == []


def test_a_damaged_file_fails_the_read(spark, documents_of, path):
    rans.write_tokens(spark, documents_of([(1, "some words")]), PATH, path)
    blocks = spark.read.parquet(f"{path}/blocks")
    blocks.selectExpr("part", "number", "first", "tokens", "concat(block, x'00') as block").write.parquet(f"{path}/bad")
    spark.read.parquet(f"{path}/bad").write.mode("overwrite").parquet(f"{path}/blocks")
    with pytest.raises(PythonException, match="DamagedBlock"):
        rans.read_tokens(spark, path).collect()


def test_query_equals_plain_tokens(spark):
    docs = queries.table(spark, SF, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    start, want = 0, []
    for (i, _), ids in zip(docs, expected([t for _, t in docs]), strict=True):
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    found = queries.op13_token_files(spark, SF)
    assert found.dtypes == [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")]
    assert sorted(tuple(r) for r in found.collect()) == want
