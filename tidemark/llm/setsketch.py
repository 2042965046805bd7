"""Near-duplicate documents by SetSketch registers.

Every document's set of word shingles is reduced to registers of exponentially
spaced, truncated minima. Registers merge by their maximum, and equal registers of
two sets become likelier the more the sets share, so runs of registers serve as
band keys. Candidates that share a band are judged by the joint likelihood of their
registers, and those left are confirmed on their full sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from tidemark.llm import graph
from tidemark.llm.columns import hidden, named, text_of
from tidemark.llm.hashing import ascii_lower, shingle_sets, white_space
from tidemark.session import stage_in

WORDS = 5
PERCENT = 75
#: Registers, their base and rate (spacing 0.1 %), and the registers of a band. A pair at
#: the threshold is missed by all 32 bands with a probability of 5 in a million.
REGISTERS, BASE, RATE, LAST, ROWS = 128, 1.001, 20.0, 65534, 4
#: A candidate is dropped if its estimated similarity lies five standard errors below the threshold.
ERRORS = 5.0

_ODD = (np.random.Generator(np.random.PCG64(7)).integers(0, 2**32, REGISTERS, dtype=np.uint32) | np.uint32(1))


def registers(hashes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """One row of registers for each set that is not empty."""
    starts = begins[:-1][np.diff(begins) > 0]
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.empty((len(starts), REGISTERS), dtype=np.uint32)
    for i in range(REGISTERS):
        least[:, i] = np.minimum.reduceat(low * _ODD[i], starts)
    exponential = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    value = np.floor(1.0 - np.log(exponential) / math.log(BASE))
    return np.clip(value, 0, LAST + 1).astype("<u2")


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The registers of the union of two sets."""
    return np.maximum(a, b)


def likely_similarity(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The most likely Jaccard similarity, row by row, given registers and set sizes."""
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    u, v = n / (n + m), m / (n + m)
    top = np.minimum(u / v, v / u)

    def p(x):
        return -np.log1p(-x * (BASE - 1) / BASE) / math.log(BASE)

    def slope(j):
        x, y = u - v * j, v - u * j
        dx = -v * (BASE - 1) / BASE / (1 - x * (BASE - 1) / BASE) / math.log(BASE)
        dy = -u * (BASE - 1) / BASE / (1 - y * (BASE - 1) / BASE) / math.log(BASE)
        px, py = np.maximum(p(x), 1e-12), np.maximum(p(y), 1e-12)
        return more * dx / px + less * dy / py - same * (dx + dy) / np.maximum(1 - px - py, 1e-12)

    # The likelihood is concave: halve the interval in which its slope changes sign.
    low, high = np.zeros_like(top), top.copy()
    for _ in range(30):
        mid = (low + high) / 2
        rising = slope(mid) > 0
        low, high = np.where(rising, mid, low), np.where(rising, high, mid)
    return (low + high) / 2


def _sketches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, fold = white_space(), ascii_lower()
        for batch in batches:
            sizes, prints, rows = [], [], []
            for hashes, begins in shingle_sets(batch.column(2), k, parts, fold):
                sizes.append(np.diff(begins))
                full = np.flatnonzero(sizes[-1])
                of = registers(hashes, begins) if len(full) else np.zeros((0, REGISTERS), "<u2")
                own: list = [None] * len(sizes[-1])
                for i, row in zip(full, of, strict=True):
                    own[i] = row.tobytes()
                rows += own
                prints += [
                    hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest()
                    for a, b in zip(begins[:-1], begins[1:], strict=True)
                ]
            n = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(prints, pa.binary()), pa.array(rows, pa.binary())],
                names=["doc_id", "mark", "n_shingles", "print", "registers"],
            )

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, fold = white_space(), ascii_lower()
        for batch in batches:
            for hashes, begins in shingle_sets(batch.column(0), k, parts, fold):
                prints = [
                    hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest()
                    for a, b in zip(begins[:-1], begins[1:], strict=True)
                ]
                items = pa.LargeListArray.from_arrays(pa.array(begins, pa.int64()), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prints, pa.binary()), items.cast(pa.list_(pa.int64()))], names=["print", "items"]
                )

    return run


@pandas_udf(DoubleType())
def _likely(a: pd.Series, b: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    def table(s: pd.Series) -> np.ndarray:
        return np.frombuffer(b"".join(s), dtype="<u2").reshape(len(s), -1)

    if not len(a):
        return pd.Series([], dtype="float64")
    return pd.Series(likely_similarity(table(a), table(b), n.to_numpy(float), m.to_numpy(float)))


def near_duplicates(spark: SparkSession, docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, mark, n_shingles, component_id, kept.

    ``mark`` is the 64-bit hash of the text, to find the row again. A text without
    words (null, empty, white space) has no shingle and is linked with nothing. Rows
    with equal sets are linked whatever their ids. Rows without an id take the
    smallest id of their component; in a component without any id the text with the
    smallest mark is kept. Repeated rows all get the same answer. Columns of other
    names are not read.

    Equal sets become one node first, so a third of all rows being copies of one
    text costs no more than the shuffle of their ids. Text is read once for the
    registers, and once more for the nodes that share a band.
    """
    stage = stage_in(spark, "near-duplicates")
    source = docs.select(named(id).cast("long").alias("doc_id"), F.xxhash64(text_of(text)).alias("mark"), text_of(text).alias("text"))
    sketched = stage(
        source.mapInArrow(_sketches(WORDS), "doc_id long, mark long, n_shingles long, print binary, registers binary")
    )
    classes = (
        sketched.where("n_shingles > 0")
        .groupBy("print")
        .agg(
            F.min("doc_id").alias("first_id"),
            F.min("mark").alias("mark"),
            F.first("n_shingles").alias("n"),
            F.first("registers").alias("registers"),
        )
    )
    classes = stage(classes.withColumn("node", F.monotonically_increasing_id()))

    width = 2 * ROWS
    bands = F.array(
        *[
            F.xxhash64(F.lit(i), F.substring("registers", 1 + i * width, width))
            for i in range(REGISTERS // ROWS)
        ]
    )
    buckets = classes.select("node", F.explode(bands).alias("bucket"))
    members = stage(graph.shared_buckets(buckets))

    sketch = classes.select("node", "n", "registers")
    left = sketch.toDF("a", "n", "left")
    right = sketch.toDF("b", "m", "right")
    near = F.least("n", "m") * 100 >= F.greatest("n", "m") * PERCENT
    judged = graph.star_pairs(members).join(left, "a").join(right, "b").where(near)
    floor = PERCENT / 100 - ERRORS * math.sqrt(PERCENT / 100 * (1 - PERCENT / 100) / REGISTERS)
    candidates = stage(judged.where(_likely("left", "right", "n", "m") >= floor).select("a", "b"))

    held = classes.join(members.select("node").distinct(), "node", "left_semi").select("node", "mark", "print")
    texts = source.join(held.select("mark").distinct(), "mark", "left_semi").dropDuplicates(["mark", "text"]).select("text")
    sets = texts.mapInArrow(_sets(WORDS), "print binary, items array<long>")
    items = stage(sets.join(held, "print").select("node", "items"))

    comps = graph.linked_components(members, candidates, items, PERCENT, stage)
    rooted = classes.join(comps, "node", "left")
    rooted = stage(rooted.select("print", "first_id", "mark", F.coalesce("comp", "node").alias("comp")))
    roots = rooted.groupBy("comp").agg(F.min("first_id").alias("root_id"), F.min("mark").alias("root_mark"))
    answer = rooted.join(roots, "comp").select("print", "root_id", "root_mark")
    linked = F.col("n_shingles") > 0
    component = F.when(linked, F.col("root_id")).otherwise(F.col("doc_id"))
    first = F.when(linked & F.col("root_id").isNull(), F.col("mark") == F.col("root_mark"))
    return (
        sketched.drop("registers")
        .join(answer, "print", "left")
        .withColumn("component_id", component)
        .withColumn("kept", F.coalesce(first, F.col("doc_id") == F.col("component_id"), ~linked))
        .select("doc_id", "mark", "n_shingles", "component_id", F.coalesce("kept", F.lit(False)).alias("kept"))
    )


def without_near_duplicates(spark: SparkSession, docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one document of each component, all of its columns.

    Of repeated rows with equal id and text one stays.
    """
    key, mark = hidden(docs, "key"), hidden(docs, "mark")
    found = near_duplicates(spark, docs, id, text)
    keep = found.where("kept").select(F.col("doc_id").alias(key), F.col("mark").alias(mark)).distinct()
    marked = docs.withColumn(mark, F.xxhash64(text_of(text))).withColumn(key, named(id).cast("long"))
    same = [marked[key].eqNullSafe(keep[key]), marked[mark] == keep[mark]]
    return marked.join(keep, same, "left_semi").dropDuplicates([key, mark]).drop(key, mark)
