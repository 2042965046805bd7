"""Packing of documents into token sequences of equal length and balanced cost.

The cost of a sequence is estimated as a linear part for its tokens and a quadratic
part for the attention within each piece. In every block, pieces in descending order
go to the sequence of lowest cost that has room for them; what fits nowhere whole is cut.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.columns import named, text_of
from tidemark.llm.tokens import encoder

LENGTH = 2048
END = 1
#: Cost of a token, and of a pair of tokens of one piece.
LINEAR, QUADRATIC = 1.0, 1.0 / LENGTH
#: Bytes of text dealt to one block, on average. A block is packed by one task; there are
#: as many blocks as the input needs.
BLOCK_BYTES = 4_000_000


def _pieces(path: str, length: int, end: int, blocks: int):
    """Documents to pieces of at most ``length`` tokens, each with the block it is dealt to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        last = np.array([end], dtype="<u4").tobytes()
        seen: Counter = Counter()
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                ids, texts = (c.slice(a, 256).to_pylist() for c in batch.columns[:2])
                rows: list[tuple] = []
                for doc_id, tokens in zip(ids, encode(texts), strict=True):
                    tokens += last
                    for start in range(0, len(tokens) // 4, length):
                        piece = tokens[4 * start : 4 * (start + length)]
                        # Equal pieces spread too; the rule does not depend on the order of rows.
                        key = zlib.crc32(piece, zlib.crc32(f"{doc_id}:{start}".encode()))
                        block = (key + seen[key] * 0x9E3779B1) % blocks
                        seen[key] += 1
                        rows.append((block, doc_id, start, len(tokens) // 4, piece))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                columns = zip(*rows, strict=True) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=["block", "doc_id", "start", "doc_tokens", "ids"],
                )

    return run


def balanced(sizes: np.ndarray, length: int) -> list[tuple[int, int, int, int, int]]:
    """(piece, first, tokens, sequence, offset) of a packing of pieces of ``sizes`` tokens.

    There are as many sequences as the tokens need. Pieces in descending order go whole
    to the sequence of lowest estimated cost with room; a piece with room nowhere is cut
    by the largest rooms, so all sequences but the last rooms left over are full.
    """
    n = max(1, -(-int(sizes.sum()) // length))
    room, cost = np.full(n, length, dtype=np.int64), np.zeros(n)
    out = []
    for piece in np.lexsort((np.arange(len(sizes)), -sizes)):
        first, left = 0, int(sizes[piece])
        while left:
            fits = room >= left
            at = int(np.argmin(np.where(fits, cost, np.inf))) if fits.any() else int(np.argmax(room))
            take = min(left, int(room[at]))
            out.append((int(piece), first, take, at, length - int(room[at])))
            room[at] -= take
            cost[at] += LINEAR * take + QUADRATIC * take * take
            first, left = first + take, left - take
    return out


_NAMES = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]


def _pack(length: int):
    def run(key: tuple, block: pa.Table) -> pa.Table:
        block = block.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("ids", "ascending")])
        ids, docs, starts, tokens = (block[c].to_pylist() for c in ("ids", "doc_id", "start", "doc_tokens"))
        base = key[0].as_py() << 32
        sizes = np.array([len(x) // 4 for x in ids], dtype=np.int64)
        rows = [
            (docs[i], starts[i] + first, take, tokens[i], base + at, offset, ids[i][4 * first : 4 * (first + take)])
            for i, first, take, at, offset in balanced(sizes, length)
        ]
        kinds = [pa.int64()] * 6 + [pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=_NAMES)

    return run


def packed(
    spark: SparkSession,
    docs: DataFrame,
    tokenizer: str,
    id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    end: int = END,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``length`` tokens.

    One row a piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (unsigned
    32-bit little-endian). A document's tokens are those of its text and ``end``; a null
    text is empty, so it has ``end`` alone. Null ids stay null, repeated rows are packed
    each. Other columns of ``docs`` are not read. ``sequence_id`` is the block's number
    times 2**32 plus the sequence's number in its block; in each block at most one
    sequence's worth of places stays empty.

    Long documents are cut into pieces before they are dealt out, so a block's size does
    not depend on any single document, however long it is or however many rows have its id.
    """
    source = docs.select(named(id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    size = source.agg(F.sum(F.octet_length("text").cast("long") + 1)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    pieces = source.mapInArrow(
        _pieces(tokenizer, length, end, blocks), "block long, doc_id long, start long, doc_tokens long, ids binary"
    )
    return pieces.groupBy("block").applyInArrow(
        _pack(length),
        "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary",
    )
