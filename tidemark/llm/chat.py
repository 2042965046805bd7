"""Conversations as token ids with a loss mask.

Every segment of a turn is encoded by itself and reserved ids, beyond the vocabulary,
are spliced between segments, so no text can produce a mark. In the written form the
marks are strings; where one occurs in a text it is escaped reversibly. The mask is the
running sum of +1 and -1 put where a segment that is learnt begins and ends.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.columns import named, text_of
from tidemark.llm.tokens import encoder, open_tokenizer

#: The marks of the template, in the order of their reserved ids (fixed values). A user's
#: text stands between the first two, an assistant's between the next two; any other role
#: is named between the fifth and the sixth, and its text ends with the last.
MARKS = ("[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[TEXT]", "[/TEXT]")
USER, ASSISTANT = "user", "assistant"
#: A mark in a text, with the backslashes that earlier escapes put behind its first sign.
_HELD = re.compile(r"([\[<])(\\*)(/?(?:INST|TEXT|ROLE)\]|/?s>)")
_ESCAPED = re.compile(r"([\[<])\\(\\*)(/?(?:INST|TEXT|ROLE)\]|/?s>)")


def escaped(text: str) -> str:
    """One backslash more behind the first sign of every mark; ``unescaped`` takes it away."""
    return _HELD.sub(r"\1\\\2\3", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def _segments(role: str, text: str) -> list[tuple[int | None, str, bool]]:
    """A turn as (mark or None, text, learnt)."""
    if role == USER:
        return [(0, "", False), (None, escaped(text), False), (1, "", False)]
    if role == ASSISTANT:
        return [(2, "", False), (None, escaped(text), True), (3, "", False)]
    return [(4, "", False), (None, escaped(role), False), (5, "", False), (None, escaped(text), False), (6, "", False)]


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        base = open_tokenizer(path).get_vocab_size()
        reserved = [np.array([base + i], dtype="<u4").tobytes() for i in range(len(MARKS))]
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                turns = [_segments(r, t) for r, t in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
                texts = iter(encode([text for turn in turns for mark, text, _ in turn if mark is None]))
                ids, masks = [], []
                for turn in turns:
                    pieces = [next(texts) if mark is None else reserved[mark] for mark, _, _ in turn]
                    ends = np.cumsum([0] + [len(p) // 4 for p in pieces])
                    edges = np.zeros(ends[-1] + 1, dtype=np.int8)
                    for (_, _, learnt), first, last in zip(turn, ends[:-1], ends[1:], strict=True):
                        edges[first] += learnt
                        edges[last] -= learnt
                    ids.append(b"".join(pieces))
                    masks.append(np.cumsum(edges[:-1], dtype=np.int8).tobytes())
                columns = [part.column(0), part.column(1), pa.array(ids, pa.binary()), pa.array(masks, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "turn", "ids", "mask"])

    return run


def formatted(
    conversations: DataFrame, tokenizer: str, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row a turn: conv_id, turn, ids (unsigned 32-bit little-endian), mask (a byte a token).

    A conversation's sequence is that of its rows in the order of turn, then ids. Null
    texts and roles are empty, a null turn comes first, rows with a null conversation
    belong together; repeated rows are turns of their own. Other columns are not read.
    Turns are encoded where they lie, so one long conversation keeps no task busy alone.
    """
    source = conversations.select(
        named(conv).cast("long").alias("conv_id"), named(turn).cast("long").alias("turn"), text_of(role).alias("role"), text_of(text).alias("text")
    )
    return source.mapInArrow(_encode(tokenizer), "conv_id long, turn long, ids binary, mask binary")


class _Reader:
    """Reads one conversation's turns in order from ids and mask alone; holds digests, not texts."""

    def __init__(self, tokenizer, base: int):
        self.tokenizer, self.base = tokenizer, base
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def _text(self, ids: np.ndarray) -> str:
        return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False) if len(ids) else ""

    def turn(self, ids: np.ndarray, mask: np.ndarray) -> None:
        at = np.flatnonzero(ids >= self.base)
        marks = [int(ids[i]) - self.base for i in at]
        texts = [self._text(ids[a + 1 : b]) for a, b in zip(at[:-1], at[1:], strict=True)]
        if marks == [4, 5, 6]:
            role, text = unescaped(texts[0]), unescaped(texts[1])
        elif marks in ([0, 1], [2, 3]):
            role, text = (USER if marks[0] == 0 else ASSISTANT), unescaped(texts[0])
        else:
            raise ValueError(f"not a turn: marks {marks}")
        self.n_turns += 1
        self.turns.update(f"{role}\n{text}\n".encode())
        self.formatted_chars += sum(len(MARKS[m]) for m in marks) + sum(map(len, texts))
        learnt = unescaped(self._text(ids[mask.astype(bool)]))
        self.loss.update(learnt.encode())
        self.loss_chars += len(learnt)

    def row(self, conv_id: int | None) -> tuple:
        return conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars


_KINDS = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
_NAMES = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def _read_back(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = open_tokenizer(path)
        base = tokenizer.get_vocab_size()
        reader, current = None, None

        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [[]] * len(_NAMES)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], names=_NAMES)

        for batch in batches:
            rows = []
            for conv_id, ids, mask in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                if reader is None or conv_id != current:
                    if reader is not None:
                        rows.append(reader.row(current))
                    reader, current = _Reader(tokenizer, base), conv_id
                reader.turn(np.frombuffer(ids, dtype="<u4"), np.frombuffer(mask, dtype=np.int8))
            yield table(rows)
        if reader is not None:
            yield table([reader.row(current)])

    return run


def read_back(turns: DataFrame, tokenizer: str) -> DataFrame:
    """Per conversation what its ids and mask say: n_turns and digests of turns and learnt text.

    ``turns`` is what :func:`formatted` returns; of other columns none is read. Turns count in
    the order of their number (null first), then of their ids; rows with a null conversation
    are one; repeated rows are turns of their own, and an empty table gives no row. Rows are
    sorted within their partition and pass one by one, so a conversation of any length needs
    no more memory than its longest turn.
    """
    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "ids")
    return dealt.mapInArrow(
        _read_back(tokenizer),
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
