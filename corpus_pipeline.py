"""A corpus from raw documents to packed sequences, stage by stage.

Every stage takes what its predecessor kept, whatever other columns it has, and but for the
last returns those columns. A null text is an empty one; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, lines, packing, quality, setsketch
from tidemark.llm.queries import VOCABULARY, piece_digests, table
from tidemark.session import materialize, scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that fail or lose too much.

    Null, empty and blank texts have too few words and go; repeated rows are judged alike.
    """
    return quality.cleaned(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of similar lines the first one stays, by id (null first), then place; documents left without any line go.

    Rows with equal id and text count as one document and share its answer; documents that
    had no line stay.
    """
    return lines.without_duplicate_lines(spark, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates the document with the smallest id stays, of repeated rows one.

    Documents without words are linked with none; where no document of a group has an id,
    the one with the smallest hash stays.
    """
    return setsketch.without_near_duplicates(spark, docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; repeated rows go or stay together.

    Items without words and an empty benchmark drop nothing.
    """
    return decontamination.decontaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, in sequences of 2048 tokens.

    A row a piece; a document without text has its end token alone, repeated rows are
    packed each, ties are settled by id, place and tokens.
    """
    return piece_digests(packing.packed(spark, docs, public_tokenizers.path(VOCABULARY)))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: Near duplicates and token ids are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written, and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), scratch(spark, name.replace(" ", "-")))
    return docs
