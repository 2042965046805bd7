"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, decontamination, extraction, licenses, lines, middle, packing, periodic, quality, rans, secrets, setsketch, sharding
from tidemark.llm.columns import text_of, words_of
from tidemark.llm.oracles import ORACLES
from tidemark.session import scratch

VOCABULARY, WORDS = "byte_bpe_50k.json", "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(
        packing.packed(spark, table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    )


def piece_digests(pieces: DataFrame) -> DataFrame:
    columns = ("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
    return pieces.select(*columns)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    figures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_kept_words")
    return quality.judged(table(spark, sf_dir, "documents")).select("doc_id", *figures)


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = setsketch.near_duplicates(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.document_rows(table(spark, sf_dir, "documents")).select("doc_id", "size", "text_crc32", "text_group")
    placed = sharding.sharded(spark, rows, "size", "text_group")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extracted(table(spark, sf_dir, "pages"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.duplicate_lines(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", "line_no", "first_doc_id", "first_line_no", "kept")


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, chat.USER, marks), (-1, 1, chat.ASSISTANT, marks)], told.schema)
    path = public_tokenizers.path(VOCABULARY)
    return chat.read_back(chat.formatted(told.unionByName(more), path), path)


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    found = licenses.licensed(spark, docs.select("text", path.alias("path")))
    doc_id = F.regexp_extract("path", r"(\d+)\.txt$", 1).cast("long").alias("doc_id")
    columns = ("header_licence", "header_score", "inherited_licence", "inherited_from", "licence")
    return found.select(doc_id, "path", *columns)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontamination.mark_leaks(spark, docs, table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id",
        F.array_sort(F.transform("leaks", lambda x: x["item_id"])).alias("item_ids"),
        F.aggregate("leaks", F.lit(0).cast("long"), lambda n, x: n + x["covered"]).alias("covered_words"),
        (F.size("leaks") == 0).alias("kept"),
    )


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.findings(spark, table(spark, sf_dir, "documents"), scratch(spark, "secret-ledger"))
    base = F.filter("spans", lambda s: s["kind"] < len(secrets.BASE))


    def count_of(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count_of(k).alias(f"n_{rule.kind}") for k, rule in enumerate(secrets.BASE)]
    return found.select(
        "doc_id", *counts, F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans")
    )


def op11_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = middle.middle_last(table(spark, sf_dir, "documents"))
    again = middle.restored(F.col("form"), F.col("output"))
    digests = (F.sha2("output", 256).alias("output_sha256"), F.sha2(again, 256).alias("restored_sha256"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): of every tenth document, by a hash of its id, the end repeats a stretch of words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", text_of().alias("text"), (h % 10 == 0).alias("planted"), F.floor(h / 10).alias("g"))
    words = F.when(F.col("planted"), words_of(F.col("text")))
    rows = rows.withColumn("words", words).withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    period = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))
    rows = rows.withColumn("p", period.cast("int"))
    left = F.col("n") - F.col("a")
    block = F.slice("words", F.col("a") + 1, F.col("p"))
    again = F.slice(F.flatten(F.array_repeat(block, F.ceil(left / F.col("p")).cast("int"))), 1, left)
    text = F.array_join(F.concat(F.slice("words", 1, F.col("a")), again), " ")
    return rows.select("doc_id", F.when(F.col("planted") & (F.col("n") > 0), text).otherwise(F.col("text")).alias("text"))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(planted_runs(table(spark, sf_dir, "documents")))
    best = periodic.strongest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.array_join(lines, "").alias("listed"), "collapsed")
    return rows.select(
        "doc_id",
        "n_runs",
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "token-files")
    rans.write_tokens(spark, table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS), folder)
    return rans.read_tokens(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_quality,
        op3_near_duplicates,
        op4_sharding,
        op5_extraction,
        op6_line_dedup,
        op7_chat,
        op8_licenses,
        op9_decontamination,
        op10_secrets,
        op11_middle,
        op12_periodic,
        op13_token_files,
    )
}
