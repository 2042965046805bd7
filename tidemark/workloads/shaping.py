"""Normalisation, scalar functions and type inference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions import text, times
from tidemark.functions.arrays import association_ids, first_association
from tidemark.operators import normalize as N
from tidemark.operators.associations import explode_id_list
from tidemark.operators.infer import infer_types
from tidemark.operators.select import fuzzy_amount, lookup_struct, project_visible
from tidemark.workloads.registry import table, workload


def nested_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw records: a lookup struct, a deeper struct, an array, odd names."""
    o = table(spark, sf_dir, "orders")
    priority = F.split("o_orderpriority", "-")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.when(
            F.col("o_orderstatus") != "P",
            F.struct(
                F.col("o_custkey").alias("id"),
                F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("name"),
                F.struct(F.col("o_orderstatus").alias("code")).alias("more"),
            ),
        ).alias("Owner"),
        priority.alias("tags"),
        F.col("o_totalprice").alias("deal.amount"),
        F.col("o_orderstatus").alias("$deal-stage"),
        F.col("o_orderdate").alias("Modified Time"),
        (F.col("o_totalprice") > 250000).alias("9large"),
    )


@workload(
    "flatten_one_level",
    """
    SELECT o_orderkey AS id,
           CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS "Owner_id",
           CASE WHEN o_orderstatus <> 'P' THEN 'Customer ' || o_custkey END AS "Owner_name",
           CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS owner_more_code,
           split_part(o_orderpriority, '-', 1) AS first_tag,
           o_totalprice AS amount
    FROM orders
    """,
)
def flatten_one_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = N.flatten_one_level(nested_orders(spark, sf_dir))
    return flat.select(
        "id",
        "Owner_id",
        "Owner_name",
        F.col("Owner_more.code").alias("owner_more_code"),
        F.get("tags", F.lit(0)).alias("first_tag"),
        F.col("`deal.amount`").alias("amount"),
    )


_RENAMED = """
    SELECT o_orderkey AS id, o_totalprice AS deal_amount, o_orderstatus AS deal_stage,
           o_orderdate AS "Modified_Time", o_totalprice > 250000 AS "_9large"
    FROM orders
"""
_ODD_NAMES = ["`id`", "`deal.amount`", "`$deal-stage`", "`Modified Time`", "`9large`"]


@workload("sanitize_columns", _RENAMED)
def sanitize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.sanitize_columns(nested_orders(spark, sf_dir).select(*_ODD_NAMES))


@workload("sanitize_columns_strict", _RENAMED)
def sanitize_columns_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.sanitize_columns_strict(nested_orders(spark, sf_dir).select(*_ODD_NAMES))


@workload(
    "normalize_values",
    """
    SELECT o_orderkey AS id,
           CASE WHEN o_orderstatus <> 'P' THEN
             '{"id":' || o_custkey || ',"name":"Customer ' || o_custkey ||
             '","more":{"code":"' || o_orderstatus || '"}}' END AS "Owner",
           '["' || replace(o_orderpriority, '-', '","') || '"]' AS tags,
           o_totalprice AS deal_amount, o_orderstatus AS deal_stage,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "Modified_Time",
           o_totalprice > 250000 AS "_9large"
    FROM orders
    """,
)
def normalize_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.normalize_values(N.sanitize_columns(nested_orders(spark, sf_dir)))


@workload(
    "ids_to_string",
    """
    SELECT o_orderkey::VARCHAR AS id, o_custkey::VARCHAR AS "customerId",
           o_totalprice::VARCHAR AS paid, o_totalprice AS price
    FROM orders
    """,
)
def ids_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return N.ids_to_string(
        o.select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("customerId"),
            F.col("o_totalprice").alias("paid"),
            F.col("o_totalprice").alias("price"),
        )
    )


@workload(
    "stringify_all",
    """
    SELECT l_orderkey::VARCHAR AS l_orderkey, l_partkey::VARCHAR AS l_partkey,
           l_suppkey::VARCHAR AS l_suppkey, l_linenumber::VARCHAR AS l_linenumber,
           l_quantity::VARCHAR AS l_quantity, l_extendedprice::VARCHAR AS l_extendedprice,
           l_discount::VARCHAR AS l_discount, l_tax::VARCHAR AS l_tax, l_returnflag,
           l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate,
           (l_extendedprice * 1000)::VARCHAR AS large
    FROM lineitem
    """,
)
def stringify_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return N.stringify_all(lines.withColumn("large", F.col("l_extendedprice") * 1000))


@workload(
    "null_tokens",
    """
    SELECT event_id,
           CASE WHEN event_type IN ('error', 'click', 'view') THEN NULL ELSE event_type END AS kind,
           CASE WHEN user_id % 2 = 0 THEN NULL ELSE user_id::VARCHAR END AS member
    FROM events
    """,
)
def null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return N.null_tokens(
        table(spark, sf_dir, "events").select(
            "event_id",
            F.when(kind == "error", "nan")
            .when(kind == "click", "None")
            .when(kind == "view", "<NA>")
            .otherwise(kind)
            .alias("kind"),
            F.when(F.col("user_id") % 2 == 0, "").otherwise(F.col("user_id").cast("string")).alias("member"),
        )
    )


@workload(
    "infer_types",
    """
    WITH typed AS (
      SELECT 'id' AS col, 'STRING' AS kind FROM orders
      UNION ALL SELECT 'amount', 'FLOAT' FROM orders
      UNION ALL SELECT 'custkey', 'INTEGER' FROM orders
      UNION ALL SELECT 'active', 'BOOLEAN' FROM orders
      UNION ALL SELECT 'deal_stage', 'STRING' FROM orders
      UNION ALL SELECT 'deal_stage', 'INTEGER' FROM orders
      UNION ALL SELECT '_9mixed', CASE WHEN o_orderstatus = 'O' THEN 'INTEGER' ELSE 'STRING' END FROM orders
      UNION ALL SELECT 'number', CASE WHEN o_orderstatus = 'O' THEN 'INTEGER' ELSE 'FLOAT' END FROM orders
      UNION ALL SELECT 'sparse', CASE WHEN o_orderstatus = 'P' THEN 'INTEGER' END FROM orders
      UNION ALL SELECT 'notes', NULL FROM orders
      UNION ALL SELECT 'Owner', 'STRING' FROM orders
      UNION ALL SELECT 'tags', 'STRING' FROM orders)
    SELECT col AS "column", CASE WHEN count(DISTINCT kind) = 1 THEN max(kind) ELSE 'STRING' END AS type
    FROM typed GROUP BY col
    """,
)
def infer_types_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_open = F.col("o_orderstatus") == "O"
    shared = [
        F.col("o_orderkey").cast("string").alias("id"),
        (F.col("o_totalprice") + 0.001).alias("amount"),
        F.col("o_custkey").alias("custkey"),
        (F.col("o_totalprice") > 250000).alias("active"),
        F.col("o_orderstatus").alias("$deal-stage"),
        F.col("o_custkey").alias("deal stage"),
        F.lit(None).cast("string").alias("notes"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_custkey")).alias("sparse"),
        F.struct(F.col("o_custkey").alias("id")).alias("Owner"),
        F.array("o_orderpriority").alias("tags"),
    ]
    keep_nulls = {"ignoreNullFields": "false"}
    whole = F.to_json(
        F.struct(*shared, F.col("o_custkey").alias("9mixed"), F.col("o_custkey").alias("number")), keep_nulls
    )
    worded = F.to_json(
        F.struct(*shared, F.col("o_orderstatus").alias("9mixed"), (F.col("o_custkey") + 0.5).alias("number")),
        keep_nulls,
    )
    records = table(spark, sf_dir, "orders").select(F.when(is_open, whole).otherwise(worded).alias("json"))
    return infer_types(records, "json")


@workload("project_visible", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def project_visible_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    hidden = {"o_orderstatus": True, "o_orderpriority": True, "o_orderkey": False}
    catalog = spark.createDataFrame(
        [(c, hidden.get(c)) for c in orders.columns], "name string, hidden boolean"
    )
    return project_visible(orders, catalog)


def _owner_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.split("c_name", "#")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_nationkey") % 3 != 0, name[0]).alias("first"),
        F.when(F.col("c_nationkey") % 4 != 0, name[1]).otherwise(
            F.when(F.col("c_nationkey") % 8 == 0, "")
        ).alias("last"),
    )


@workload(
    "full_name",
    """
    WITH n AS (
      SELECT c_custkey,
             CASE WHEN c_nationkey % 3 <> 0 THEN split_part(c_name, '#', 1) END AS f,
             CASE WHEN c_nationkey % 4 <> 0 THEN split_part(c_name, '#', 2)
                  WHEN c_nationkey % 8 = 0 THEN '' END AS l
      FROM customer)
    SELECT c_custkey, nullif(trim(coalesce(f, '') || ' ' || coalesce(l, '')), '') AS full_name,
           CASE WHEN f <> '' AND l <> '' THEN f || ' ' || l END AS strict_name
    FROM n
    """,
)
def full_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = F.col("first"), F.col("last")
    return _owner_names(spark, sf_dir).select(
        "c_custkey",
        text.full_name(first, last).alias("full_name"),
        text.full_name(first, last, strict=True).alias("strict_name"),
    )


def _linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    def entry(c: Column) -> Column:
        return F.struct(c.cast("string").alias("id"))

    custkey = F.col("o_custkey")
    blank = F.when(custkey % 3 == 0, "").otherwise(custkey.cast("string"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.when(
            F.col("o_orderstatus") != "P",
            F.array(entry(blank), entry(custkey % 5), entry(blank), entry(F.lit(None))),
        ).alias("companies"),
    )


@workload(
    "association_ids",
    """
    WITH e AS (
      SELECT o_orderkey, o_orderstatus,
             CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_custkey::VARCHAR END AS a,
             (o_custkey % 5)::VARCHAR AS b
      FROM orders)
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'P' THEN NULL WHEN a IS NULL OR a = b THEN b
                WHEN a < b THEN a || ',' || b ELSE b || ',' || a END AS company_ids
    FROM e
    """,
)
def association_ids_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _linked(spark, sf_dir).select(
        "o_orderkey", association_ids(F.col("companies")).alias("company_ids")
    )


@workload(
    "first_association",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_custkey % 3 = 0 THEN ''
                            ELSE o_custkey::VARCHAR END AS company_id
    FROM orders
    """,
)
def first_association_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _linked(spark, sf_dir).select(
        "o_orderkey", first_association(F.col("companies")).alias("company_id")
    )


@workload(
    "explode_id_list",
    """
    SELECT DISTINCT id FROM (
      SELECT (o_custkey % 5)::VARCHAR AS id FROM orders WHERE o_orderstatus <> 'P'
      UNION ALL
      SELECT o_custkey::VARCHAR FROM orders WHERE o_orderstatus <> 'P' AND o_custkey % 3 <> 0)
    """,
)
def explode_id_list_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = _linked(spark, sf_dir).select(
        F.array_join(F.transform("companies", lambda e: e["id"]), " , ", "").alias("ids")
    )
    return explode_id_list(parents, "ids")


@workload(
    "lookup_struct",
    """
    SELECT o_orderkey AS id,
           CASE WHEN o_orderstatus <> 'P' THEN o_custkey::VARCHAR END AS nested_id,
           CASE WHEN o_orderstatus <> 'P' THEN 'Customer ' || o_custkey END AS nested_name,
           CASE WHEN o_orderstatus <> 'P' THEN o_custkey::VARCHAR END AS flat_id,
           CASE WHEN o_orderstatus <> 'P' THEN 'Customer ' || o_custkey END AS flat_name
    FROM orders
    """,
)
def lookup_struct_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = nested_orders(spark, sf_dir)
    both = raw.select("id", "Owner", F.col("Owner.id").alias("Boss_id"), F.col("Owner.name").alias("Boss_name"))
    nested, flat = lookup_struct(both, "Owner"), lookup_struct(both, "Boss")
    return both.select(
        "id",
        nested[0].alias("nested_id"),
        nested[1].alias("nested_name"),
        flat[0].alias("flat_id"),
        flat[1].alias("flat_name"),
    )


@workload(
    "first_nonempty",
    """
    SELECT event_id, CASE WHEN event_type <> 'click' THEN event_type
                          WHEN user_id % 2 = 0 THEN 'even' WHEN user_id % 3 = 0 THEN props
                          ELSE '' END AS name
    FROM events
    """,
)
def first_nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        text.first_nonempty(
            F.when(F.col("event_type") != "click", F.col("event_type")).otherwise(""),
            F.when(user % 2 == 0, "even"),
            F.when(user % 3 == 0, F.col("props")),
        ).alias("name"),
    )


@workload(
    "fuzzy_amount",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'O' THEN floor(o_totalprice)::BIGINT::VARCHAR
                WHEN o_orderstatus = 'F' THEN regexp_replace(o_totalprice::VARCHAR, '\\.0$', '')
                WHEN o_custkey % 2 = 0 THEN o_custkey::VARCHAR END AS amount
    FROM orders
    """,
)
def fuzzy_amount_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    records = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(status == "F", F.struct(F.lit("USD").alias("currency"), F.col("o_totalprice").alias("value"))).alias(
            "Total_Amount"
        ),
        F.when(status == "O", F.floor("o_totalprice").cast("double")).alias("Amount"),
        F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey")).alias("amount_due"),
    )
    return records.select("o_orderkey", fuzzy_amount(records).alias("amount"))


@workload(
    "canonical_amount",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           regexp_replace((l_extendedprice * 1000)::VARCHAR, '\\.0$', '') AS amount,
           CASE WHEN l_returnflag <> 'R' THEN regexp_replace(l_quantity::VARCHAR, '\\.0$', '') END AS quantity
    FROM lineitem
    """,
)
def canonical_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit(" "), text.float_text(F.col("l_quantity")), F.lit("\t"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        text.canonical_amount(text.float_text(F.col("l_extendedprice") * 1000)).alias("amount"),
        text.canonical_amount(F.when(F.col("l_returnflag") != "R", padded).otherwise("  ")).alias("quantity"),
    )


@workload(
    "parse_iso_ts",
    """
    SELECT event_id, CASE event_type WHEN 'error' THEN NULL
                       WHEN 'click' THEN ts - INTERVAL 330 MINUTE ELSE ts END AS parsed
    FROM events
    """,
)
def parse_iso_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    stamp = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    written = (
        F.when(kind == "error", F.concat(F.lit("on "), stamp))
        .when(kind == "click", F.concat(stamp, F.lit("+05:30")))
        .when(kind == "view", F.concat(stamp, F.lit("Z")))
        .otherwise(stamp)
    )
    return table(spark, sf_dir, "events").select(
        "event_id", times.parse_iso_ts(written).cast("timestamp_ntz").alias("parsed")
    )


@workload("epoch_millis", "SELECT event_id, epoch_us(ts) // 1000 AS millis FROM events")
def epoch_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", times.epoch_millis(F.col("ts")).alias("millis")
    )


@workload(
    "rfc1123",
    "SELECT event_id, strftime(ts, '%a, %d %b %Y %H:%M:%S +0000') AS header FROM events",
)
def rfc1123(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", times.rfc1123(F.col("ts")).alias("header"))


@workload(
    "offset_time",
    "SELECT event_id, strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') AS local_time FROM events",
)
def offset_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", times.offset_time(F.col("ts")).alias("local_time")
    )


@workload(
    "elapsed_seconds",
    """
    SELECT event_id, (epoch_us(ts) - epoch_us(date_trunc('day', ts))) / 1e6::DOUBLE AS seconds
    FROM events
    """,
)
def elapsed_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id", times.elapsed_seconds(F.date_trunc("day", ts), ts).alias("seconds")
    )


@workload(
    "norm_label",
    "SELECT p_partkey, replace(replace(lower(p_name || '_' || p_brand), ' ', ''), '_', '') AS label FROM part",
)
def norm_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.norm_label(F.concat_ws("_", "p_name", "p_brand")).alias("label")
    )
