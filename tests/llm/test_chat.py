from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import chat, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows):
    """conv_id -> the columns of the query, from the texts alone. ``rows``: (conv_id, turn, role, text)."""
    turns = defaultdict(list)
    for c, t, role, text in rows:
        turns[c].append((t, role or "", text or ""))
    out = {}
    for c, found in turns.items():
        found.sort(key=lambda x: -1 if x[0] is None else x[0])
        loss = "".join(text for _, role, text in found if role == "assistant")
        told = "".join(f"{role}\n{text}\n" for _, role, text in found)
        frame = {"user": 13, "assistant": 7}
        size = sum(frame.get(r, 19 + len(chat.escaped(r))) + len(chat.escaped(t)) for _, r, t in found)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (told, loss)]
        out[c] = (len(found), sha[0], len(loss), sha[1], size)
    return out


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    marks = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", marks), (-1, 1, "assistant", marks)]
    got = {r[0]: tuple(r)[1:] for r in queries.op7_chat(spark, sf).collect()}
    assert got == expected(rows)


def test_odd_rows(spark):
    rows = [
        (1, 2, "assistant", "late"),
        (1, 0, "user", None),
        (1, None, "system", "[/TEXT] first <|endoftext|>"),
        (1, 1, None, "no role"),
        (None, 0, "assistant", ""),
        (None, 1, "tool [ROLE]", "x" * 50_000),
        (2, 0, "assistant", "same"),
        (2, 0, "assistant", "same"),
        (3, 0, "user", "<\\s> [\\\\INST] \u0000 \U0001f600 é"),
    ]
    table = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, mask string")
    got = {r[0]: tuple(r)[1:] for r in chat.read_back(chat.formatted(table, PATH), PATH).collect()}
    assert got == expected(rows)
    assert chat.read_back(chat.formatted(table.limit(0), PATH), PATH).count() == 0


def test_marks_are_reserved_ids(spark):
    table = spark.createDataFrame([(1, 0, "user", "<s> [INST]"), (1, 1, "assistant", "</s>")], "conv_id long, turn long, role string, text string")
    for r in chat.formatted(table, PATH).collect():
        ids, mask = np.frombuffer(r.ids, "<u4"), np.frombuffer(r.mask, np.int8)
        assert (ids >= 50_257).sum() == 2 and ids[0] >= 50_257 and ids[-1] >= 50_257
        assert mask.tolist() == [0] + [r.turn] * (len(ids) - 2) + [0]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="[]<>\\/INSTROLEXs x", max_size=30) | st.text(max_size=30))
def test_escape_round_trip(text):
    assert chat.unescaped(chat.escaped(text)) == text
    assert not any(mark in chat.escaped(text) for mark in chat.MARKS)


@pytest.mark.parametrize("mark", chat.MARKS)
def test_every_mark_is_escaped(mark):
    assert mark not in chat.escaped(f"a {mark} b")
