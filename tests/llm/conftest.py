from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

#: Columns beside id and text, with names that operators use inside.
EXTRA = ("node", "kept", "mark", "__key", "__leaks", "a.b", "Shard", "n_words")


@pytest.fixture(scope="session")
def documents_of(spark):
    """A table of (doc_id, text) pairs with clashing extra columns."""
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
        + [T.StructField(c, T.StringType()) for c in EXTRA]
        + [T.StructField("n_chars", T.LongType())]
    )

    def make(rows):
        return spark.createDataFrame(
            [(i, t, *[f"{c}{i}" for c in EXTRA], None if t is None else len(t)) for i, t in rows], schema
        )

    return make


def prose(seed: int, n: int) -> str:
    """``n`` words in lines of sentences."""
    pick = random.Random(seed)
    words = ["".join(pick.choices("abcdefghijklmnopqrstuvwxyzéß", k=pick.randint(2, 9))) for _ in range(n)]
    for i in range(11, n, 12):
        words[i] += "." if i % 36 != 35 else ".\n"
    return " ".join(words).replace("\n ", "\n") + "."


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, ties, repeated rows, one very long text."""
    a, b = prose(1, 120), prose(2, 90)
    return [
        (1, a),
        (1, a),
        (2, a),
        (3, b),
        (3, None),
        (4, None),
        (None, None),
        (5, ""),
        (6, " \t\n \x0b\r\n"),
        (None, b),
        (None, b + " tail."),
        (7, "one"),
        (8, "日本語のテキスト。" * 40),
        (9, prose(3, 60_000)),
        (10, "x" * 100_000),
        (11, "a " * 3_000),
        (12, "\n" * 500),
    ]
