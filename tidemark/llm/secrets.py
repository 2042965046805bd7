"""Secrets in every version of every text, by an incremental ledger of blobs.

A version's text is addressed by its SHA-256. The ledger holds, for each blob and each
version of a rule, what the rule found; a run scans only pairs the ledger lacks, then
joins the findings back to all paths that hold the blob. Only DataFrame functions are
used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.columns import named, text_of

SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: the pattern of a match, and how long its value must be.

    ``value`` is what remains of a match once this pattern is taken off its front; a
    match whose value is shorter than ``least`` is dropped. A changed rule gets a new
    ``version``.
    """

    kind: str
    version: int
    pattern: str
    least: int
    value: str = ""

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


_KEY = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
#: The rules in the order in which spans of one start are listed (fixed values).
BASE = (
    Rule("assign", 1, _KEY + r"[A-Za-z0-9+/_.=-]+", 12, _KEY),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}", 18),
    Rule("hex", 1, r"[0-9a-f]{16,}", 16),
)
MORE = (
    # No repeated group: Java's matcher would recurse for each repetition.
    Rule("private_key", 2, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1),
    # A bound on the head keeps long runs without a dot from being tried anew from each eyJ.
    Rule("web_token", 2, r"eyJ[A-Za-z0-9_-]{8,1000}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 1),
    Rule("url_password", 1, r"[a-z][a-z0-9+.-]{1,30}://[^\s:/@]{1,100}:[^\s:/@]{3,100}@", 1),
    Rule("prefixed", 1, r"(?:ghp_|gho_|ghs_|xox[abp]-|sk_live_|rk_live_|glpat-)[A-Za-z0-9_-]{16,}", 1),
)
RULES = BASE + MORE


def spans(text: Column, rule: Rule, kind: int) -> Column:
    """The matches of one rule as (start, kind, end) in code points, in order.

    What stands between matches and the matches themselves alternate, so their lengths
    sum up to the places.
    """
    between = F.split(text, rule.pattern, -1)
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPANS).alias("spans"))

    def step(acc: Column, pair: Column) -> Column:
        begin = acc["at"] + F.length(pair["between"])
        end = begin + F.length(pair["found"])
        value = F.regexp_replace(pair["found"], "^(?:" + rule.value + ")", "") if rule.value else pair["found"]
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        own = F.when(F.length(value) >= rule.least, F.array(span)).otherwise(F.array().cast(SPANS))
        return F.struct(end.alias("at"), F.concat(acc["spans"], own).alias("spans"))

    pairs = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda x, y: F.struct(x.alias("between"), y.alias("found")))
    return F.when(text.rlike(rule.pattern), F.aggregate(pairs, start, step, lambda acc: acc["spans"])).otherwise(
        F.array().cast(SPANS)
    )


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """(blob, rule, spans), each pair once; None if nothing was recorded yet."""
    try:
        return spark.read.parquet(path).dropDuplicates(["blob", "rule"])
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def scan_unseen(spark: SparkSession, versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> None:
    """Append to the ledger what the rules find in blobs they have not seen.

    ``versions``: (blob, text). Each blob is scanned once however many paths hold it,
    and only by the rules it lacks. A run that dies leaves the ledger as it was, or with
    whole rows; its repetition scans what is missing.
    """
    names = F.array(*[F.lit(r.name) for r in rules])
    seen = read_ledger(spark, ledger)
    if seen is None:
        todo = versions.withColumn("todo", names)
    else:
        of_blob = seen.select("blob", "rule").groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        todo = versions.join(of_blob, "blob", "left")
        todo = todo.withColumn("todo", F.array_except(names, F.coalesce("seen", F.array().cast("array<string>")))).drop("seen")
    todo = todo.where(F.size("todo") > 0).groupBy("blob").agg(F.first("text").alias("text"), F.first("todo").alias("todo"))
    found = [
        F.when(
            F.array_contains("todo", rule.name),
            F.struct(F.lit(rule.name).alias("rule"), spans(F.col("text"), rule, kind).alias("spans")),
        )
        for kind, rule in enumerate(rules)
    ]
    rows = todo.select("blob", F.explode(F.array_compact(F.array(*found))).alias("found"))
    rows.select("blob", "found.rule", "found.spans").write.mode("append").parquet(ledger)


def findings(
    spark: SparkSession,
    docs: DataFrame,
    ledger: str,
    id: str = "doc_id",
    text: str = "text",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Per row of ``docs``: doc_id, blob, and ``spans``, all (start, kind, end) sorted by start, then kind.

    ``kind`` is the rule's place in ``rules``. A null text is empty and holds nothing;
    null ids stay; rows with equal text get the same spans. Texts are scanned whole,
    however long: no rule's pattern recurses or tries a stretch anew from each of its
    characters. Other columns are not read.
    ``ledger`` is a folder all executors share; it is read, completed and kept.
    """
    versions = docs.select(named(id).alias("doc_id"), text_of(text).alias("text"))
    versions = versions.withColumn("blob", F.unhex(F.sha2("text", 256)))
    scan_unseen(spark, versions.select("blob", "text"), ledger, rules)
    recorded = spark.read.parquet(ledger).where(F.col("rule").isin([r.name for r in rules]) & (F.size("spans") > 0))
    # A rule's place may differ from the one it had when it was recorded.
    place = F.create_map(*[x for k, r in enumerate(rules) for x in (F.lit(r.name), F.lit(k))])
    placed = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), place[F.col("rule")].alias("kind"), s["end"].alias("end")))
    recorded = recorded.select("blob", F.explode(placed).alias("span")).distinct()
    by_blob = recorded.groupBy("blob").agg(F.array_sort(F.collect_list("span")).alias("spans"))
    return (
        versions.select("doc_id", "blob")
        .join(by_blob, "blob", "left")
        .withColumn("spans", F.coalesce("spans", F.array().cast(SPANS)))
        .select("doc_id", "blob", "spans")
    )


def listed(found: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Spans as kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(
        F.transform(
            found,
            lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
