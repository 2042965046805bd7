"""Fuzzy deduplication of lines by MinHash over character shingles.

Equal lines are one node. A node's signature holds minima of its shingles' hashes; runs
of them are band keys, candidates that share a band are confirmed by the Jaccard
similarity of their whole shingle sets, and of every component of linked lines the
first one is kept. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import graph
from tidemark.llm.columns import hidden, named, text_of
from tidemark.session import stage_in

#: A shingle: ten characters from every character on, as long as ten are left; a shorter line is one.
SHINGLE = r"(?s)(?=(.{10}|^.{1,9}$))."
#: The shingles a signature is made of, a quarter of all in prose: those behind any character
#: but a to u. A line has a line feed put before it, so its first shingle is among them.
SIGNED = r"(?s)[^a-u](?=(.{10}))"
PERCENT = 75
#: Bands and their rows. Measured over edited lines with a similarity of all their shingles
#: of 0.75 to 0.8, the bands miss 1 % of the pairs, from 0.8 to 0.9 0.2 %; a line linked
#: with several others is found by any.
BANDS, ROWS = 10, 3


def _masks() -> list[int]:
    """One 32-bit mask for each minimum, spread evenly, with the lower bits mixed."""
    n = BANDS * ROWS
    spread = [(i * (1 << 32) // n) ^ ((0x9E3779B9 * (i + 1) % (1 << 32)) >> 6) for i in range(n)]
    return [x - (1 << 32) if x >= 1 << 31 else x for x in spread]


def shingles(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit(SHINGLE), F.lit(1))


def hashes(line: Column) -> Column:
    """The 64-bit hashes of a line's distinct shingles."""
    return F.array_distinct(F.transform(shingles(line), lambda s: F.xxhash64(s)))


def short_hashes(line: Column) -> Column:
    """The 32-bit hashes of a line's distinct shingles, for comparisons within buckets, where
    sets pass shuffles: they take half the room, and two of a line's shingles coincide in one
    of some hundred thousand lines."""
    return F.array_distinct(F.transform(shingles(line), lambda s: F.hash(s)))


def _rest_links(members: DataFrame, comps: DataFrame, items: DataFrame, percent: int, stage: graph.Stage, sets: graph.Sets) -> DataFrame | None:
    return graph.dense_rest_links(members, comps, items, percent, stage, short_hashes)


def lines_of(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(doc_id, mark, line_no, line, node): the lines with a visible character, in lower case without outer blanks.

    ``mark`` is the text's hash, ``node`` the line's (64 bits).
    """
    body = text_of(text)
    split = docs.select(
        named(id).cast("long").alias("doc_id"), F.xxhash64(body).alias("mark"), F.posexplode(F.split(body, "\n")).alias("line_no", "line")
    )
    split = split.withColumn("line", F.lower(F.trim("line"))).where(F.col("line").rlike(r"\S"))
    return split.withColumn("node", F.xxhash64("line"))


def signed(line: Column) -> Column:
    """The shingles of a line that its signature is made of; a line shorter than one is its own."""
    found = F.regexp_extract_all(F.concat(F.lit("\n"), line), F.lit(SIGNED), F.lit(1))
    return F.when(F.length(line) < 10, F.array(line)).otherwise(found)


def signatures(lines: DataFrame) -> DataFrame:
    """(node, bucket): the band keys of every distinct line.

    The minimum of the hashes under a mask picks a random shingle, as a permutation would.
    Minima are formed before the shuffle, which carries no text, over all of a line's shingles.
    """
    hashed = lines.select("node", F.explode(shingles(F.col("line"))).alias("shingle")).select("node", F.hash("shingle").alias("h"))
    least = hashed.groupBy("node").agg(
        *[F.min(F.col("h").bitwiseXOR(F.lit(m))).alias(f"m{i}") for i, m in enumerate(_masks())]
    )
    bands = F.array(
        *[F.xxhash64(F.lit(b), *[F.col(f"m{b * ROWS + r}") for r in range(ROWS)]) for b in range(BANDS)]
    )
    return least.select("node", F.explode(bands).alias("bucket"))


def duplicate_lines(spark: SparkSession, docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per line with a visible character: doc_id, mark, line_no, component, first_doc_id, first_line_no, kept.

    The first line of a component, by doc_id (null first), mark, and line_no, is kept.
    ``mark`` is the hash of the document's text. Blank lines are not listed; null and
    empty texts have no lines. Repeated rows with equal id and text count as one
    document, so all of them get its answer. Other columns are not read.
    """
    stage = stage_in(spark, "lines")
    lines = lines_of(docs, id, text)
    members = stage(graph.shared_buckets(signatures(lines)))
    candidates = stage(graph.star_pairs(members))
    wanted = members.select("node").distinct()
    texts = lines.select("node", "line").join(wanted, "node", "left_semi").dropDuplicates(["node"])
    # A line's shingles take eight times its room, so joins carry the line.
    items = stage(texts.select("node", F.col("line").alias("items")))
    comps = graph.linked_components(members, candidates, items, PERCENT, stage, hashes, _rest_links)

    places = stage(lines.select("doc_id", "mark", "line_no", "node"))
    firsts = places.groupBy("node").agg(F.min(F.struct("doc_id", "mark", "line_no")).alias("first"), F.count("*").alias("n"))
    firsts = firsts.join(comps, "node", "left")
    # A line that occurs once and is linked with none is its own first, without a join.
    firsts = firsts.where("n > 1 or comp is not null").withColumn("comp", F.coalesce("comp", "node"))
    firsts = stage(firsts.select("node", "comp", "first"))
    roots = firsts.groupBy("comp").agg(F.min("first").alias("first"))
    answer = firsts.drop("first").join(roots, "comp").select("node", "comp", "first")
    own = F.struct("doc_id", "mark", "line_no")
    first = F.coalesce("first", own)
    return (
        places.join(answer, "node", "left")
        .withColumns({"component": F.coalesce("comp", "node"), "first": first})
        .select(
            "doc_id",
            "mark",
            "line_no",
            "component",
            F.col("first.doc_id").alias("first_doc_id"),
            F.col("first.line_no").alias("first_line_no"),
            (F.col("first") == own).alias("kept"),
        )
    )


def without_duplicate_lines(
    spark: SparkSession, docs: DataFrame, id: str = "doc_id", text: str = "text", length: str | None = "n_chars"
) -> DataFrame:
    """``docs`` with only the kept lines in their texts, all columns in place.

    A document whose every line lives on in another one goes; one without lines stays as
    it is, and blank lines stay. ``length``, if ``docs`` has it, becomes the new length
    in code points.
    """
    key, mark, gone = hidden(docs, "key"), hidden(docs, "mark"), hidden(docs, "gone")
    dropped = duplicate_lines(spark, docs, id, text).where("not kept")
    dropped = dropped.groupBy("doc_id", "mark").agg(F.collect_set("line_no").alias(gone)).toDF(key, mark, gone)
    marked = docs.withColumns({key: named(id).cast("long"), mark: F.xxhash64(text_of(text))})
    joined = marked.join(
        dropped, marked[key].eqNullSafe(dropped[key]) & (marked[mark] == dropped[mark]), "left"
    ).select(*[marked[f"`{c}`"] for c in docs.columns], F.col(gone))
    split = F.split(text_of(text), "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(gone))
    rest = F.array_join(F.transform(stay, lambda i: F.get(split, i)), "\n")
    after = hidden(joined, "after")
    joined = joined.withColumn(after, F.when(F.col(gone).isNull(), named(text)).otherwise(rest))
    held = joined.where(F.col(gone).isNull() | (F.col(after).rlike(r"\S") & (F.spark_partition_id() >= 0)))

    def column(name: str) -> Column:
        if name == text:
            return F.col(after).alias(name)
        if name == length:
            kind = docs.schema[name].dataType
            return F.when(F.col(gone).isNull(), named(name)).otherwise(F.length(after)).cast(kind).alias(name)
        return named(name)

    return held.select(*[column(c) for c in docs.columns])
