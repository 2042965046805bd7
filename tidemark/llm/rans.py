"""Token ids in files, coded by a static range asymmetric numeral system (rANS).

One table of frequencies, counted over the corpus, serves all blocks. A block holds the
ids of whole documents, dealt round to lanes that are coded in step; it can be decoded
without any other block, and from each of its checkpoints on. A checksum covers all of it.

A written corpus is a folder with two Parquet tables, so that Spark's commit protocol
holds for them on any file system: ``table`` (id, frequency) and ``blocks`` (part, number,
first, tokens, block), where ``block`` is, in little-endian order:

    head        magic, version, frequency bits, lanes, steps between checkpoints, tokens, documents,
                checkpoints, words, checksum of the table
    documents   ids (int64), 1 for a null id (uint8), tokens (uint32)
    checkpoints place in the words (uint32), state of each lane (uint64)
    words       what the lanes gave off (uint32)
    checksum    CRC-32 of all that stands before it
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.columns import named, text_of
from tidemark.llm.hashing import chunks, utf8
from tidemark.llm.tokens import vocabulary_size, word_encoder
from tidemark.session import materialize, scratch

END = 2
#: Frequencies sum up to 2**BITS; a lane's state stays in [2**31, 2**63).
BITS, LOW = 20, np.uint64(1 << 31)
LANES = 1024
#: Steps between checkpoints, and tokens after which a block is closed.
STEPS, BLOCK = 64, 1 << 18
#: Bytes of text tokenized at once: of these each distinct word is looked up once.
TEXT_BYTES = 16_000_000
_HEAD = "<4sHHIIIIIII"
MAGIC, VERSION = b"TRNS", 1
_WORD = np.uint64(32)
_BLOCKS = "part int, number int, first long, tokens long, block binary"


class DamagedBlock(ValueError):
    """A block whose checksum, kind or table is not the expected one."""


class Frequencies:
    """The shared table: every id of the vocabulary has a share of at least one."""

    def __init__(self, share: np.ndarray):
        self.share = share.astype(np.uint64)
        self.below = np.concatenate(([0], np.cumsum(self.share)[:-1])).astype(np.uint64)
        self.crc = zlib.crc32(share.astype("<u4").tobytes())
        self._owner: np.ndarray | None = None

    @classmethod
    def of(cls, counts: np.ndarray) -> Frequencies:
        """Shares in proportion to ``counts``; what rounding leaves goes to the largest rests."""
        if len(counts) > 1 << (BITS - 1):
            raise ValueError(f"more than {1 << (BITS - 1)} ids")
        spare = (1 << BITS) - len(counts)
        exact = np.maximum(counts, 0) * (spare / max(1, int(counts.sum())))
        if not counts.any():
            exact = np.full(len(counts), spare / len(counts))
        share = np.floor(exact).astype(np.int64)
        rest = spare - int(share.sum())
        order = np.argsort(share - exact, kind="stable")
        share[order[: max(0, rest)]] += 1
        share[int(np.argmax(share))] += spare - int(share.sum())  # floating-point error
        return cls(share + 1)

    @property
    def owner(self) -> np.ndarray:
        """The id that owns each of the 2**BITS places."""
        if self._owner is None:
            self._owner = np.repeat(np.arange(len(self.share), dtype=np.uint32), self.share.astype(np.int64))
        return self._owner


def encode(ids: np.ndarray, table: Frequencies, lanes: int = LANES, steps: int = STEPS) -> tuple[list[tuple[int, np.ndarray]], np.ndarray]:
    """(checkpoints, words) of ids. A checkpoint is a place in the words and the lanes' states."""
    state = np.full(lanes, LOW, dtype=np.uint64)
    given: list[np.ndarray] = []
    points: list[tuple[int, np.ndarray]] = []
    total = 0
    for step in reversed(range(-(-len(ids) // lanes))):
        now = ids[step * lanes : (step + 1) * lanes]
        x, share = state[: len(now)], table.share[now]
        full = x >= share << np.uint64(63 - BITS)
        words = x[full]
        given.append(words.astype(np.uint32))
        total += len(words)
        x[full] = words >> _WORD
        quotient = x // share
        x[:] = (quotient << np.uint64(BITS)) + (x - quotient * share) + table.below[now]
        if step % steps == 0:
            points.append((total, state.copy()))
    words = np.concatenate(given[::-1]) if given else np.zeros(0, np.uint32)
    return [(total - at, x) for at, x in reversed(points)], words


def decode(
    points: list[tuple[int, np.ndarray]], words: np.ndarray, tokens: int, table: Frequencies, steps: int, first: int = 0, last: int | None = None
) -> np.ndarray:
    """The ids from checkpoint ``first`` on, up to checkpoint ``last`` or the end."""
    if not points:
        return np.zeros(0, np.uint32)
    lanes = len(points[0][1])
    at, state = points[first]
    state = state.copy()
    begin = first * steps * lanes
    end = tokens if last is None or last >= len(points) else last * steps * lanes
    out = np.empty(end - begin, dtype=np.uint32)
    mask = np.uint64((1 << BITS) - 1)
    for place in range(begin, end, lanes):
        n = min(lanes, tokens - place)
        x = state[:n]
        slot = x & mask
        now = table.owner[slot]
        out[place - begin : place - begin + n] = now
        x[:] = table.share[now] * (x >> np.uint64(BITS)) + slot - table.below[now]
        empty = np.flatnonzero(x < LOW)
        x[empty] = (x[empty] << _WORD) | words[at : at + len(empty)]
        at += len(empty)
    return out


def write_block(ids: list[int | None], documents: list[np.ndarray], table: Frequencies, lanes: int = LANES, steps: int = STEPS) -> bytes:
    """The bytes of a block of whole documents."""
    tokens = np.concatenate(documents) if documents else np.zeros(0, np.uint32)
    points, words = encode(tokens, table, lanes, steps)
    head = struct.pack(_HEAD, MAGIC, VERSION, BITS, lanes, steps, len(tokens), len(ids), len(points), len(words), table.crc)
    parts = [
        head,
        np.array([i or 0 for i in ids], dtype="<i8").tobytes(),
        np.array([i is None for i in ids], dtype=np.uint8).tobytes(),
        np.array([len(d) for d in documents], dtype="<u4").tobytes(),
        np.array([at for at, _ in points], dtype="<u4").tobytes(),
        *[x.astype("<u8").tobytes() for _, x in points],
        words.astype("<u4").tobytes(),
    ]
    body = b"".join(parts)
    return body + struct.pack("<I", zlib.crc32(body))


class Block:
    """A block read from its bytes; nothing is decoded yet."""

    def __init__(self, data: bytes, table: Frequencies):
        if len(data) < struct.calcsize(_HEAD) + 4 or zlib.crc32(memoryview(data)[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise DamagedBlock("wrong checksum")
        magic, version, bits, lanes, self.steps, self.tokens, documents, points, words, crc = struct.unpack_from(_HEAD, data)
        if (magic, version, bits, crc) != (MAGIC, VERSION, BITS, table.crc):
            raise DamagedBlock("another format or table")
        self.table, at = table, struct.calcsize(_HEAD)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, dtype=kind, count=n, offset=at)
            at += out.nbytes
            return out

        ids, null = take("<i8", documents), take("u1", documents)
        self.ids = [None if x else i for i, x in zip(ids.tolist(), null, strict=True)]
        self.lengths = take("<u4", documents).astype(np.int64)
        places = take("<u4", points).tolist()
        self.points = [(p, take("<u8", lanes).astype(np.uint64)) for p in places]
        self.words = take("<u4", words)

    def tokens_from(self, first: int = 0, last: int | None = None) -> np.ndarray:
        return decode(self.points, self.words, self.tokens, self.table, self.steps, first, last)


def _tokenized(path: str, end: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = word_encoder(path, kind)
        last = np.array([end], dtype=kind).tobytes()
        for batch in batches:
            for a, b in chunks(utf8(batch.column(1))[1], TEXT_BYTES):
                ids, texts = (c.slice(a, b - a) for c in batch.columns)
                coded = [x + last for x in ids_of(texts).to_pylist()]
                yield pa.RecordBatch.from_arrays([ids, pa.array(coded, pa.binary())], names=["doc_id", "ids"])

    return run


def _counted(size: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, dtype=np.int64)
        for batch in batches:
            # The ids of a batch of documents stand in one buffer.
            rows = batch.column(0)
            _, ends, data = rows.buffers()
            first, last = np.frombuffer(ends, dtype=np.int32)[[rows.offset, rows.offset + len(rows)]] if len(rows) else (0, 0)
            if last > first:
                counts += np.bincount(np.frombuffer(data, dtype=np.uint8)[first:last].view(kind), minlength=size)
        there = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(counts[there], pa.int64())], names=["id", "n"])

    return run


def _blocks(share: np.ndarray, kind: str, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, part = Frequencies(share), TaskContext.get().partitionId()
        ids: list[int | None] = []
        held: list[np.ndarray] = []
        number = first = size = 0

        def close() -> pa.RecordBatch:
            row = (part, number, first, size, write_block(ids, held, table))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=["part", "number", "first", "tokens", "block"]
            )

        for batch in batches:
            for id, tokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids.append(id)
                held.append(np.frombuffer(tokens, dtype=kind))
                size += len(held[-1])
                if size >= block:
                    yield close()
                    number, first, size, ids, held = number + 1, first + size, 0, [], []
        if ids:
            yield close()

    return run


def _documents(share: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Frequencies(share)
        for batch in batches:
            for before, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                block = Block(data, table)
                tokens = block.tokens_from().astype("<u4")
                ends = np.cumsum(block.lengths)
                begins = ends - block.lengths
                raw = [tokens[a:b].tobytes() for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.ids, pa.int64()), pa.array(begins + before), pa.array(block.lengths), pa.array(raw, pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return run


def write_tokens(
    spark: SparkSession, docs: DataFrame, tokenizer: str, path: str, id: str = "doc_id", text: str = "text", end: int = END, block: int = BLOCK
) -> None:
    """Write the ids of all documents, ``end`` behind each, to the folder ``path`` in ascending order of id.

    A null text is empty and has ``end`` alone; null ids come first; rows of equal id
    follow each other by their tokens, repeated rows are written each. Other columns are
    not read. Rows are dealt by ranges of their ids, and each range is written by one
    task, a block at a time; a document longer than a block makes a longer one, which its
    checkpoints divide. The driver sees counts per id of the vocabulary only.
    """
    size = max(vocabulary_size(tokenizer), end + 1)
    kind = "<u2" if size <= 1 << 16 else "<u4"
    source = docs.select(named(id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    coded = materialize(
        source.mapInArrow(_tokenized(tokenizer, end, kind), "doc_id long, ids binary"), scratch(spark, "token-ids")
    )
    per_id = coded.select("ids").mapInArrow(_counted(size, kind), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(size, dtype=np.int64)
    for row in per_id.collect():
        counts[row["id"]] = row["n"]
    share = Frequencies.of(counts).share.astype(np.int64)
    table = spark.createDataFrame(list(enumerate(share.tolist())), "id int, frequency int")
    table.coalesce(1).write.mode("overwrite").parquet(f"{path}/table")
    order = ("doc_id", F.xxhash64("ids"))
    dealt = coded.repartitionByRange(*order).sortWithinPartitions(*order, "ids")
    blocks = dealt.mapInArrow(_blocks(share, kind, block), _BLOCKS)
    blocks.write.mode("overwrite").option("compression", "uncompressed").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of a written corpus; ``ids`` are unsigned 32-bit little-endian numbers.

    ``start`` counts the ids of all documents before. Blocks are decoded independently; a
    damaged one fails the read. An empty corpus has no rows.
    """
    stored = spark.read.schema("id int, frequency int").parquet(f"{path}/table").orderBy("id")
    share = np.array([row["frequency"] for row in stored.collect()], dtype=np.int64)
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    # One row for each part that was written: the tokens of the parts before it.
    parts = blocks.groupBy("part").agg(F.sum("tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # There are at most spark.sql.shuffle.partitions of them, so the blocks are not shuffled.
    placed = blocks.select("part", "first", "block").join(F.broadcast(parts), "part")
    return placed.select((F.col("before") + F.col("first")).alias("start"), "block").mapInArrow(
        _documents(share), "doc_id long, start long, n_tokens long, ids binary"
    )
