"""Linked entities, labels and nested arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.associations import association_catchup, referenced_only
from tidemark.operators.explode import explode_stages, explode_subform
from tidemark.operators.filters import delta_filter, orphans, orphans_of
from tidemark.operators.labels import resolve_labels, resolve_labels_exact
from tidemark.workloads.registry import table, utc, workload


def _deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the ids of one or two customers."""
    two = F.concat_ws(", ", F.col("o_custkey"), F.col("o_custkey") % 7)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderdate",
        F.when(F.col("o_orderstatus") == "P", two)
        .when(F.col("o_orderstatus") == "F", F.col("o_custkey").cast("string"))
        .alias("associated_company_ids"),
    )


def _companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").withColumn("id", F.col("c_custkey").cast("string"))


_NAMED = """
    SELECT o_custkey FROM orders WHERE o_orderstatus IN ('P', 'F') {and_since}
    UNION SELECT o_custkey % 7 FROM orders WHERE o_orderstatus = 'P' {and_since}
"""


@workload(
    "referenced_only",
    "SELECT *, c_custkey::VARCHAR AS id FROM customer WHERE c_custkey IN ("
    + _NAMED.format(and_since="")
    + ")",
)
def referenced_only_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return referenced_only(
        _companies(spark, sf_dir), _deals(spark, sf_dir), "associated_company_ids"
    )


@workload(
    "association_catchup",
    "SELECT *, c_custkey::VARCHAR AS id FROM customer WHERE c_acctbal > 9000 OR c_custkey IN ("
    + _NAMED.format(and_since="AND o_orderdate >= TIMESTAMP '2001-06-01'")
    + ")",
)
def association_catchup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    companies = _companies(spark, sf_dir)
    changed = companies.filter(F.col("c_acctbal") > 9000)
    deals = delta_filter(_deals(spark, sf_dir), "o_orderdate", utc("2001-06-01T00:00:00"))
    return association_catchup(changed, deals, companies, "associated_company_ids")


@workload(
    "orphans",
    """
    SELECT doc_id, source, 'unlabelled' AS reason FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    UNION ALL
    SELECT doc_id, source, 'no language' FROM documents WHERE lang = 'en'
    """,
)
def orphans_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    unlabelled = orphans_of(documents, "doc_id", table(spark, sf_dir, "labels"), "doc_id")
    blanked = documents.withColumn("lang", F.when(F.col("lang") != "en", F.col("lang")))
    return (
        unlabelled.withColumn("reason", F.lit("unlabelled"))
        .unionByName(orphans(blanked, "lang").withColumn("reason", F.lit("no language")))
        .drop("lang")
    )


# Labels. Parts stand for catalog entries.

LABELS = ["Economy", "red_widget", "Brand#17", "BRAND #4", "Small", "small ring", "No Such Label"]


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("sequence"),
        F.col("p_type").alias("plural_label"),
        F.col("p_name").alias("singular_label"),
        F.col("p_brand").alias("api_name"),
    )


def _norm(column: str) -> str:
    return f"lower(replace(replace({column}, '_', ''), ' ', ''))"


_WANTED = "VALUES " + ", ".join(f"('{label}')" for label in LABELS)


@workload(
    "resolve_labels",
    f"""
    WITH RECURSIVE wanted(label) AS ({_WANTED}),
    entries AS (
      SELECT row_number() OVER (ORDER BY p_partkey) AS i, p_brand AS api,
             a.label AS la, b.label AS lb, c.label AS lc
      FROM part LEFT JOIN wanted a ON {_norm('a.label')} = {_norm('p_type')}
                LEFT JOIN wanted b ON {_norm('b.label')} = {_norm('p_name')}
                LEFT JOIN wanted c ON {_norm('c.label')} = {_norm('p_brand')}
      WHERE a.label IS NOT NULL OR b.label IS NOT NULL OR c.label IS NOT NULL),
    walk(i, pick, api, taken) AS (
      SELECT 0::BIGINT, NULL::VARCHAR, NULL::VARCHAR, []::VARCHAR[]
      UNION ALL
      SELECT w.i + 1, p.pick, e.api,
             CASE WHEN p.pick IS NULL THEN w.taken ELSE list_append(w.taken, p.pick) END
      FROM walk w JOIN entries e ON e.i = w.i + 1,
      LATERAL (SELECT CASE
          WHEN e.la IS NOT NULL AND NOT list_contains(w.taken, e.la) THEN e.la
          WHEN e.lb IS NOT NULL AND NOT list_contains(w.taken, e.lb) THEN e.lb
          WHEN e.lc IS NOT NULL AND NOT list_contains(w.taken, e.lc) THEN e.lc END AS pick) p)
    SELECT label, coalesce(walk.api, label) AS api_name
    FROM wanted LEFT JOIN walk ON walk.pick = label
    """,
)
def resolve_labels_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_labels(_catalog(spark, sf_dir), LABELS)


EXACT = ["ECONOMY", "Brand#7", "small ring", "Brand#7", "No Such Label"]


@workload(
    "resolve_labels_exact",
    """
    WITH wanted(label) AS (VALUES ('ECONOMY'), ('Brand#7'), ('small ring'), ('No Such Label')),
    matched AS (
      SELECT p_type AS label, p_brand AS api_name,
             row_number() OVER (PARTITION BY p_type ORDER BY p_partkey DESC) AS rn
      FROM part WHERE p_type IN (FROM wanted) OR p_brand IN (FROM wanted))
    SELECT label, api_name FROM matched WHERE rn = 1
    UNION ALL
    SELECT label, NULL FROM wanted WHERE label NOT IN (SELECT label FROM matched)
    """,
)
def resolve_labels_exact_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_labels_exact(_catalog(spark, sf_dir), EXACT)


# Nested arrays


def pipelines_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pipeline per customer whose stages are three states of the account; one market
    segment has none."""
    stages = F.array(
        *[
            F.struct(
                F.concat_ws("-", F.lit(name), F.col("c_custkey")).alias("id"),
                F.lit(name).alias("label"),
                F.lit(i).alias("displayOrder"),
            )
            for i, name in enumerate(("open", "won", "lost"))
        ]
    )
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("label"),
        F.when(F.col("c_mktsegment") != "MACHINERY", stages).alias("stages"),
    )


@workload(
    "explode_stages",
    """
    SELECT c_custkey::VARCHAR AS pipeline_id, c_name AS pipeline_label,
           s.name || '-' || c_custkey AS stage_id, s.name AS stage_label, s.i AS display_order
    FROM customer, (VALUES ('open', 0), ('won', 1), ('lost', 2)) s(name, i)
    WHERE c_mktsegment <> 'MACHINERY'
    """,
)
def explode_stages_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_stages(pipelines_of(spark, sf_dir))


def blocks_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as blocks with two arrays that may hold their site splits."""
    key = F.col("c_custkey")

    def split(site: str, share: int):
        return F.struct(
            F.concat(F.lit(site), key.cast("string")).alias("Site"), F.lit(share).alias("Site_Percentage")
        )

    plain = F.array(F.struct(F.col("c_nationkey").alias("Site"), F.lit("old").alias("Remark")))
    return table(spark, sf_dir, "customer").select(
        key.cast("string").alias("id"),
        F.when(key % 4 != 0, F.col("c_name")).otherwise("").alias("Name"),
        F.concat(F.lit("Block "), key.cast("string")).alias("Block_Name"),
        F.array(F.struct(F.lit(1).alias("other"))).alias("Notes"),
        F.when(key % 3 == 0, F.array(split("a", 40), split("b", 60)))
        .when(key % 3 == 1, F.filter(F.array(split("a", 1)), lambda x: F.lit(False)))
        .alias("Splits"),
        F.when(key % 2 == 0, plain).alias("Old_Splits"),
        F.lit("2024-05-01T00:00:00Z").alias("Modified_Time"),
    )


_SPLITS = """
    WITH parents AS (
      SELECT c_custkey, c_nationkey, c_custkey::VARCHAR AS "Parent_Id_id",
             CASE WHEN c_custkey % 4 <> 0 THEN c_name ELSE 'Block ' || c_custkey END AS "Parent_Id_name"
      FROM customer)
    SELECT 'a' || c_custkey AS "Site", 40 AS "Site_Percentage", NULL::VARCHAR AS "Remark",
           "Parent_Id_id", "Parent_Id_name" FROM parents WHERE c_custkey % 3 = 0
    UNION ALL
    SELECT 'b' || c_custkey, 60, NULL, "Parent_Id_id", "Parent_Id_name" FROM parents WHERE c_custkey % 3 = 0
    UNION ALL
    SELECT c_nationkey::VARCHAR, NULL, 'old', "Parent_Id_id", "Parent_Id_name"
    FROM parents WHERE c_custkey % 3 <> 0 AND c_custkey % 2 = 0
"""


@workload("explode_subform", _SPLITS)
def explode_subform_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_subform(blocks_of(spark, sf_dir))
