"""Upsert, ranking, unions and change history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.text import action_id, float_text
from tidemark.operators.filters import active_history, delta_filter
from tidemark.operators.history import (
    detect_deletes,
    history_state,
    latest_history,
    replacement_match,
    snapshot_diff,
    snapshot_diff_full,
)
from tidemark.operators.ranking import latest_per_key
from tidemark.operators.union import missing_labels, tagged_projection, union_evolving
from tidemark.operators.upsert import dedupe_keep_last, upsert
from tidemark.operators.watermark import get_watermark
from tidemark.plans.store import from_micros
from tidemark.session import stage_in
from tidemark.workloads.registry import table, utc, workload

RUN = utc("2024-06-01T12:00:00")

# Upsert. The target holds the orders up to a cut-off; the feed brings the rest, and
# every seventh order again with a new price.

CUTOFF = utc("1998-01-01T00:00:00")


def _changed_orders(orders: DataFrame) -> DataFrame:
    return orders.withColumn(
        "o_totalprice",
        F.when(F.col("o_orderkey") % 7 == 0, F.col("o_totalprice") + 100).otherwise(F.col("o_totalprice")),
    )


_UPSERTED = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority,
           CASE WHEN o_orderdate >= TIMESTAMP '1997-12-31 23:45:00' AND o_orderkey % 7 = 0
                THEN o_totalprice + 100 ELSE o_totalprice END AS o_totalprice,
           CASE WHEN o_orderdate >= TIMESTAMP '1997-12-31 23:45:00' THEN o_orderkey % 3 END AS channel
    FROM orders
"""


@workload("upsert", _UPSERTED)
def upsert_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read the mark, take the delta with its overlap, apply it to the snapshot."""
    orders = table(spark, sf_dir, "orders")
    marks = spark.range(1).select(
        F.lit("crm").alias("source"),
        F.lit("deals").alias("module"),
        F.lit("1998-01-01 00:00:00Z").cast("timestamp").alias("last_synced_at"),
    )
    since = get_watermark(marks, "crm", "deals", RUN).select(F.unix_micros("since").alias("m"))
    delta = delta_filter(orders, "o_orderdate", from_micros(since.first()["m"]))
    target = orders.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    fresh = _changed_orders(delta).withColumn("channel", F.col("o_orderkey") % 3)
    return upsert(target, fresh, ["o_orderkey"], [F.col("o_orderdate")])


@workload(
    "upsert_custom_key",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
               ORDER BY CASE WHEN l_shipdate >= TIMESTAMP '1999-01-01' THEN 1 ELSE 0 END DESC,
                        l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn
      FROM lineitem)
    WHERE rn = 1
    """,
)
def upsert_custom_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    order = [F.col(c) for c in ("l_shipdate", "l_partkey", "l_suppkey")]
    late = F.col("l_shipdate") >= F.lit("1999-01-01").cast("timestamp_ntz")
    target = upsert(None, lines.filter(~late), keys, order)
    merged = upsert(target, lines.filter(late), keys, order)
    return merged.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@workload(
    "dedupe_keep_last",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
               ORDER BY (l_returnflag = 'R')::INT DESC, l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn
      FROM lineitem)
    WHERE rn = 1
    """,
)
def dedupe_keep_last_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    returned = F.col("l_returnflag") == "R"
    return dedupe_keep_last(
        lines.filter(~returned).select(*columns),
        lines.filter(returned).select(*columns),
        ["l_orderkey", "l_linenumber"],
        [F.col(c) for c in ("l_shipdate", "l_partkey", "l_suppkey")],
    )


@workload(
    "latest_per_key",
    """
    SELECT event_id, user_id, ts, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
      FROM events)
    WHERE rn = 1
    """,
)
def latest_per_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").drop("props")
    return latest_per_key(events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])


# Change history. Orders stand for revenue records: the block is one of 50, the date is
# the status, both sometimes missing. The log knows all but the urgent orders; some were
# changed since, some logged as deleted. The snapshot lacks the orders of low priority.

_STATES = """
    WITH history AS (
      SELECT o_orderkey::VARCHAR AS id, nullif(o_custkey % 50, 0)::VARCHAR AS block,
             nullif(o_orderstatus, 'P') AS date, o_totalprice::VARCHAR AS amount,
             CASE WHEN o_orderkey % 17 = 0 THEN 'Delete'
                  WHEN o_orderkey % 5 = 0 THEN 'Amount changed' ELSE 'Create' END AS type
      FROM orders WHERE o_orderpriority <> '1-URGENT'),
    previous AS (
      SELECT id, block, 'Block ' || block AS name, date,
             regexp_replace(amount, '\\.0$', '') AS amount, type FROM history),
    current AS (
      SELECT o_orderkey::VARCHAR AS id, nullif(o_custkey % 50, 0)::VARCHAR AS block,
             'Block ' || nullif(o_custkey % 50, 0)::VARCHAR AS name,
             CASE WHEN o_orderkey % 13 = 0 THEN 'moved' ELSE nullif(o_orderstatus, 'P') END AS date,
             CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE regexp_replace(
               (CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END)::VARCHAR,
               '\\.0$', '') END AS amount
      FROM orders WHERE o_orderpriority <> '5-LOW'),
    active AS (SELECT * FROM previous WHERE type <> 'Delete')
"""
# Keys logged as deleted and seen again are created anew.
_ENTRY = """
    SELECT 'A' || sha256('run-1' || chr(31) || id || chr(31) || type) AS action_id,
           '2024-06-01 17:30:00' AS action_timestamp, block AS "Block_id", id AS revenue_id,
           name AS block_name, date AS "Revenue_date", amount, type AS "Type"
    FROM entries
"""
_CHANGE = """
    concat_ws(' and ', CASE WHEN c.amount IS DISTINCT FROM p.amount THEN 'Amount changed' END,
                       CASE WHEN c.date IS DISTINCT FROM p.date THEN 'Date changed' END)
"""


def _block() -> Column:
    return F.nullif(F.col("o_custkey") % 50, F.lit(0))


def revenue_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History rows: a creation for each known order, then for some a later entry."""
    known = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") != "1-URGENT")
    later = F.when(F.col("o_orderkey") % 17 == 0, "Delete").when(
        F.col("o_orderkey") % 5 == 0, "Amount changed"
    )
    created = F.struct(
        F.lit("2024-01-01 09:00:00").alias("at"),
        F.lit("Create").alias("Type"),
        F.when(later.isNull(), F.col("o_totalprice")).otherwise(F.col("o_totalprice") - 5).alias("price"),
    )
    followed = F.struct(
        F.lit("2024-02-01 09:00:00").alias("at"), later.alias("Type"), F.col("o_totalprice").alias("price")
    )
    logged = known.select(
        F.col("o_orderkey").cast("string").alias("revenue_id"),
        _block().cast("string").alias("Block_id"),
        F.nullif("o_orderstatus", F.lit("P")).alias("Revenue_date"),
        F.explode(F.when(later.isNull(), F.array(created)).otherwise(F.array(created, followed))).alias("e"),
    )
    return logged.select(
        action_id("run-0", F.col("revenue_id"), F.col("e.Type")).alias("action_id"),
        F.col("e.at").alias("action_timestamp"),
        "Block_id",
        "revenue_id",
        F.concat(F.lit("Block "), F.col("Block_id")).alias("block_name"),
        "Revenue_date",
        float_text(F.col("e.price")).alias("amount"),
        F.col("e.Type"),
    )


def revenue_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot as raw records with a lookup struct and a numeric amount."""
    key = F.col("o_orderkey")
    raised = F.when(key % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderpriority") != "5-LOW")
        .select(
            key.cast("string").alias("id"),
            F.when(key % 23 != 0, raised).alias("Amount"),
            F.when(key % 13 == 0, "moved").otherwise(F.nullif("o_orderstatus", F.lit("P"))).alias("Date"),
            F.when(
                _block().isNotNull(),
                F.struct(
                    _block().cast("string").alias("id"),
                    F.concat(F.lit("Block "), _block().cast("string")).alias("name"),
                ),
            ).alias("Parent_Id"),
        )
    )


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return (
        history_state(revenue_records(spark, sf_dir)),
        latest_history(revenue_log(spark, sf_dir)),
    )


@workload(
    "latest_history",
    _STATES
    + """SELECT id, amount, date AS "Revenue_date", block AS "Block_id", name AS block_name,
                type AS "Type" FROM previous""",
)
def latest_history_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_history(revenue_log(spark, sf_dir))


@workload(
    "snapshot_diff",
    _STATES
    + ", entries AS (SELECT * FROM (SELECT c.id, c.block, c.name, c.date, c.amount,"
    + f" CASE WHEN p.id IS NULL THEN 'Create' ELSE {_CHANGE} END AS type"
    + " FROM current c LEFT JOIN active p USING (id)) WHERE type <> '')"
    + _ENTRY,
)
def snapshot_diff_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_diff(*_sides(spark, sf_dir), "run-1", RUN)


@workload(
    "detect_deletes",
    _STATES
    + """SELECT id, amount, date AS "Revenue_date", block AS "Block_id", name AS block_name, type AS "Type"
         FROM active WHERE id NOT IN (SELECT id FROM current)""",
)
def detect_deletes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_deletes(*_sides(spark, sf_dir))


_PAIRS = """
    , appeared AS (SELECT * FROM current WHERE id NOT IN (SELECT id FROM active)),
    vanished AS (SELECT * FROM active WHERE id NOT IN (SELECT id FROM current)),
    pairs AS (
      SELECT n.id AS new_id, o.id AS old_id FROM
        (SELECT *, row_number() OVER (PARTITION BY block, date ORDER BY id) AS rn
         FROM appeared) n
        JOIN
        (SELECT *, row_number() OVER (PARTITION BY block, date ORDER BY id) AS rn
         FROM vanished) o
        ON n.block IS NOT DISTINCT FROM o.block AND n.date IS NOT DISTINCT FROM o.date AND n.rn = o.rn)
"""


@workload("replacement_match", _STATES + _PAIRS + "SELECT new_id, old_id FROM pairs")
def replacement_match_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    current, previous = _sides(spark, sf_dir)
    active = previous.filter(active_history(F.col("Type")))
    appeared = current.join(active.select("id"), "id", "left_anti")
    return replacement_match(appeared, detect_deletes(current, previous), stage_in(spark, "pairs"))


_FULL = (
    _STATES
    + _PAIRS
    + f"""
    , entries AS (
      SELECT * FROM (
        SELECT c.id, c.block, c.name, c.date, c.amount, {_CHANGE} AS type
        FROM current c JOIN active p USING (id)) WHERE type <> ''
      UNION ALL
      SELECT a.id, a.block, a.name, a.date, a.amount, coalesce('Replaced ' || old_id, 'Create')
      FROM appeared a LEFT JOIN pairs ON a.id = new_id
      UNION ALL
      SELECT v.id, v.block, v.name, v.date, v.amount,
             coalesce('Deleted (Replaced by ' || new_id || ')', 'Delete')
      FROM vanished v LEFT JOIN pairs ON v.id = old_id)
"""
)


@workload("snapshot_diff_full", _FULL + _ENTRY)
def snapshot_diff_full_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_diff_full(
        *_sides(spark, sf_dir), "run-1", RUN, stage=stage_in(spark, "diff")
    )


# Unions


@workload(
    "union_view",
    """
    SELECT o_orderkey AS id, 'Order ' || o_orderkey AS name, o_totalprice AS amount,
           o_orderstatus AS stage, 'orders' AS source, o_orderdate AS last_modified FROM orders
    UNION ALL
    SELECT l_orderkey, 'Line ' || l_linenumber, l_extendedprice, l_linestatus, 'lines', l_shipdate
    FROM lineitem
    """,
)
def union_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tagged_projection(
        table(spark, sf_dir, "orders"),
        {
            "id": F.col("o_orderkey"),
            "name": F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")),
            "amount": F.col("o_totalprice"),
            "stage": F.col("o_orderstatus"),
            "last_modified": F.col("o_orderdate"),
        },
        "orders",
    )
    lines = tagged_projection(
        table(spark, sf_dir, "lineitem"),
        {
            "id": F.col("l_orderkey"),
            "name": F.concat(F.lit("Line "), F.col("l_linenumber").cast("string")),
            "amount": F.col("l_extendedprice"),
            "stage": F.col("l_linestatus"),
            "last_modified": F.col("l_shipdate"),
        },
        "lines",
    )
    return orders.unionByName(lines)


@workload(
    "union_evolving",
    """
    SELECT c_custkey AS id, c_nationkey::VARCHAR AS code, c_acctbal AS balance, NULL::VARCHAR AS kind
    FROM customer
    UNION ALL
    SELECT p_partkey, p_brand, NULL, p_type FROM part
    """,
)
def union_evolving_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("code"), F.col("c_acctbal").alias("balance")
    )
    right = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_brand").alias("code"), F.col("p_type").alias("kind")
    )
    return union_evolving(left, right)


@workload(
    "missing_labels",
    "SELECT DISTINCT doc_id AS label FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def missing_labels_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("label"))
    found = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("label"))
    return missing_labels(wanted, found)
