"""Sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.text import float_text
from tidemark.operators.associations import lookup_by_ids
from tidemark.operators.infer import typed_records
from tidemark.operators.union import tagged_passes
from tidemark.operators.watermark import WATERMARK_SCHEMA, point_lookup
from tidemark.session import materialize, scratch, shared_root
from tidemark.sinks import tables as sinks
from tidemark.sources.ndjson import load_ndjson
from tidemark.sources.pages import (
    feed_complete,
    read_module_pages,
    read_object_pages,
    read_variant_pages,
    unwrap_line_items,
    unwrap_module_pages,
    unwrap_objects,
    variant_records,
)
from tidemark.sources.tables import scan_table
from tidemark.workloads.registry import table, workload


def iso(ts: Column) -> Column:
    return F.date_format(ts.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def links(*ids: Column) -> Column:
    """An association list of the given ids."""
    return F.struct(F.array(*[F.struct(i.cast("string").alias("id")) for i in ids]).alias("results"))


def land(pages: DataFrame, name: str) -> str:
    """Write pages as gzipped JSON lines below the shared folder; readers of JSON open
    them by their suffix."""
    path = scratch(pages.sparkSession, name)
    pages.write.option("compression", "gzip").json(path)
    return path


def deal_pages(orders: DataFrame) -> DataFrame:
    """Object pages of an order and its renewal, each linked to customers."""

    def deal(suffix: str, amount: Column, archived: Column) -> Column:
        return F.struct(
            F.concat(F.col("o_orderkey").cast("string"), F.lit(suffix)).alias("id"),
            F.create_map(
                F.lit("amount"),
                float_text(amount),
                F.lit("dealstage"),
                F.col("o_orderstatus"),
                F.lit("lastmodifieddate"),
                iso(F.col("o_orderdate")),
            ).alias("properties"),
            iso(F.col("o_orderdate")).alias("createdAt"),
            iso(F.col("o_orderdate")).alias("updatedAt"),
            archived.alias("archived"),
            F.struct(
                links(F.col("o_custkey"), F.col("o_custkey") % 7, F.col("o_custkey")).alias("companies")
            ).alias("associations"),
        )

    return orders.select(
        F.array(
            deal("", F.col("o_totalprice"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F")),
            deal("-renewal", F.col("o_totalprice") * 2, F.lit(None).cast("boolean")),
        ).alias("results")
    )


@workload(
    "scan_object_pages",
    """
    WITH deals AS (
      SELECT o_orderkey::VARCHAR AS id, o_totalprice AS price,
             coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus = 'F' END, false) AS archived,
             o_orderdate, o_orderstatus, o_custkey FROM orders
      UNION ALL
      SELECT o_orderkey::VARCHAR || '-renewal', o_totalprice * 2, false,
             o_orderdate, o_orderstatus, o_custkey FROM orders)
    SELECT id, price::VARCHAR AS amount, o_orderstatus AS dealstage,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS lastmodifieddate,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS "createdAt",
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS "updatedAt",
           archived,
           CASE WHEN o_custkey = o_custkey % 7 THEN o_custkey::VARCHAR
                WHEN o_custkey::VARCHAR < (o_custkey % 7)::VARCHAR
                  THEN o_custkey::VARCHAR || ',' || (o_custkey % 7)::VARCHAR
                ELSE (o_custkey % 7)::VARCHAR || ',' || o_custkey::VARCHAR END AS associated_company_ids
    FROM deals
    """,
)
def scan_object_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = land(deal_pages(table(spark, sf_dir, "orders")), "deal-pages")
    return unwrap_objects(
        read_object_pages(spark, path),
        ["amount", "dealstage", "lastmodifieddate"],
        companies=True,
    )


CUSTOMER_RECORD = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("Name", T.StringType()),
        T.StructField("Segment", T.StringType()),
        T.StructField("Balance", T.DoubleType()),
    ]
)


def customer_pages(customer: DataFrame) -> DataFrame:
    """Numbered module pages, the last of which says that no more follow."""
    record = F.struct(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("Name"),
        F.col("c_mktsegment").alias("Segment"),
        F.col("c_acctbal").alias("Balance"),
    )
    last = customer.agg(F.max("c_custkey")).scalar()
    return customer.select(
        (F.col("c_custkey") + 1).alias("page"),
        F.array(record).alias("data"),
        F.struct((F.col("c_custkey") < last).alias("more_records")).alias("info"),
    )


@workload(
    "scan_module_pages",
    """
    SELECT c_custkey::VARCHAR AS id, c_name AS "Name", c_mktsegment AS "Segment",
           c_acctbal AS "Balance", true AS complete
    FROM customer
    """,
)
def scan_module_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = land(customer_pages(table(spark, sf_dir, "customer")), "customer-pages")
    pages = read_module_pages(spark, path, CUSTOMER_RECORD)
    complete = feed_complete(pages).select("complete").scalar()
    return unwrap_module_pages(pages).withColumn("complete", complete)


@workload(
    "scan_schemaless_pages",
    """
    SELECT o_orderkey AS id, o_custkey AS "Owner_id", 'Customer ' || o_custkey AS "Owner_name",
           o_totalprice AS deal_amount, o_totalprice > 250000 AS large,
           CASE WHEN o_orderstatus = 'O' THEN o_custkey::VARCHAR ELSE o_orderpriority END AS mixed,
           '["' || o_orderstatus || '"]' AS tags,
           CASE WHEN o_orderstatus = 'P' THEN o_custkey END AS sparse
    FROM orders
    """,
)
def scan_schemaless_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose fields and types are only known from the records."""

    def record(*fields: Column) -> Column:
        owner = F.struct(
            F.col("o_custkey").alias("id"),
            F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("name"),
        )
        return F.to_json(
            F.struct(
                F.col("o_orderkey").alias("id"),
                owner.alias("Owner"),
                F.col("o_totalprice").alias("deal.amount"),
                (F.col("o_totalprice") > 250000).alias("$large"),
                F.array("o_orderstatus").alias("tags"),
                *fields,
            )
        )

    status = F.col("o_orderstatus")
    number, word = F.col("o_custkey").alias("mixed"), F.col("o_orderpriority").alias("mixed")
    text = (
        F.when(status == "O", record(number))
        .when(status == "P", record(word, F.col("o_custkey").alias("sparse")))
        .otherwise(record(word))
    )
    page = F.concat(F.lit('{"data": ['), text, F.lit('], "info": {"more_records": true}}'))
    path = scratch(spark, "schemaless-pages")
    table(spark, sf_dir, "orders").select(page.alias("value")).write.text(path)
    landed = materialize(variant_records(read_variant_pages(spark, path)), scratch(spark, "landed"))
    return typed_records(landed, "record")


def line_item_pages(lineitem: DataFrame) -> DataFrame:
    """Pages of line items; returned ones are linked to no deal."""
    item = F.struct(
        F.concat_ws(
            "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"
        ).alias("id"),
        F.create_map(
            F.lit("name"),
            F.concat(F.lit("part "), F.col("l_partkey").cast("string")),
            F.lit("price"),
            float_text(F.col("l_extendedprice")),
            F.lit("quantity"),
            float_text(F.col("l_quantity")),
            F.lit("amount"),
            float_text(F.col("l_extendedprice")),
            F.lit("hs_product_id"),
            F.col("l_partkey").cast("string"),
            F.lit("lastmodifieddate"),
            iso(F.col("l_shipdate")),
        ).alias("properties"),
        F.when(
            F.col("l_returnflag") != "R",
            F.struct(links(F.col("l_orderkey"), F.col("l_orderkey") + 1).alias("deals")),
        ).alias("associations"),
    )
    return lineitem.select(F.array(item).alias("results"))


@workload(
    "scan_line_items",
    """
    SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag) AS id,
           'part ' || l_partkey AS name, l_extendedprice::VARCHAR AS price,
           l_quantity::VARCHAR AS quantity, l_extendedprice::VARCHAR AS amount,
           l_partkey::VARCHAR AS hs_product_id, NULL::VARCHAR AS description,
           NULL::VARCHAR AS recurringbillingfrequency,
           NULL::VARCHAR AS hs_recurring_billing_start_date,
           strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS lastmodifieddate,
           CASE WHEN l_returnflag <> 'R' THEN l_orderkey::VARCHAR END AS associated_deal_id
    FROM lineitem
    """,
)
def scan_line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = land(line_item_pages(table(spark, sf_dir, "lineitem")), "line-item-pages")
    return unwrap_line_items(read_object_pages(spark, path))


@workload(
    "lookup_by_ids",
    "SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')",
)
def lookup_by_ids_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F").select("o_custkey")
    return lookup_by_ids(table(spark, sf_dir, "customer"), ids, "c_custkey")


@workload("scan_tagged_passes", "SELECT *, s_acctbal < 0 AS archived FROM supplier")
def scan_tagged_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    owners = table(spark, sf_dir, "supplier")
    return tagged_passes(
        owners.filter(F.col("s_acctbal") >= 0), owners.filter(F.col("s_acctbal") < 0)
    )


@workload("scan_table", "SELECT * FROM lineitem")
def scan_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_table(spark, f"{sf_dir}/lineitem.parquet")


def event_marks(events: DataFrame) -> DataFrame:
    """Watermarks by event type and user, as a stand-in for source and module."""
    return events.groupBy(
        F.col("event_type").alias("source"), F.col("user_id").cast("string").alias("module")
    ).agg(F.max(F.col("ts").cast("timestamp")).alias("last_synced_at"))


@workload(
    "point_lookup",
    """
    SELECT event_type AS source, user_id::VARCHAR AS module, max(ts) AS last_synced_at
    FROM events WHERE event_type = 'click' AND user_id = 7 GROUP BY 1, 2
    """,
)
def point_lookup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = point_lookup(event_marks(table(spark, sf_dir, "events")), "click", "7")
    return found.withColumn("last_synced_at", F.col("last_synced_at").cast("timestamp_ntz"))


@workload("load_ndjson", "SELECT event_id, user_id, event_type, value, props FROM events")
def load_ndjson_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    known = "event_id bigint, user_id bigint, event_type string, value double, props string"
    good = events.select(F.to_json(F.struct("event_id", "user_id", "event_type", "value", "props", "ts")))
    broken = table(spark, sf_dir, "region").select(F.concat(F.lit('{"event_id": '), "r_name"))
    path = scratch(spark, "events-ndjson")
    good.union(broken).toDF("value").write.text(path)
    schema = spark.createDataFrame([], known).schema
    return load_ndjson(spark, path, scratch(spark, "events-staging"), schema)


def _earlier_and_later(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    open_orders = F.col("o_orderstatus") == "O"
    return orders.filter(~open_orders), orders.filter(open_orders)


@workload(
    "sink_overwrite",
    "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'O'",
)
def sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "overwrite")
    for batch in _earlier_and_later(spark, sf_dir):
        sinks.overwrite(batch, path)
    return spark.read.parquet(path)


@workload("sink_append", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "append")
    for batch in _earlier_and_later(spark, sf_dir):
        sinks.append(batch, path)
    return spark.read.parquet(path)


@workload(
    "sink_router",
    """
    SELECT 'Deals' AS table_name, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'
    UNION ALL
    SELECT 'revenue_history', o_orderkey, o_totalprice FROM orders
    """,
)
def sink_router(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "router")
    earlier, later = _earlier_and_later(spark, sf_dir)
    for batch in (earlier, later, later.limit(0)):
        for name in ("Deals", "revenue_history"):
            sinks.route(batch, root, name)
    return (
        spark.read.parquet(f"{root}/Deals")
        .withColumn("table_name", F.lit("Deals"))
        .unionByName(
            spark.read.parquet(f"{root}/revenue_history").withColumn(
                "table_name", F.lit("revenue_history")
            )
        )
        .select("table_name", "o_orderkey", "o_totalprice")
    )


@workload("create_from_staging", "SELECT * FROM orders")
def create_from_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "created")
    sinks.create_from_staging(table(spark, sf_dir, "orders"), path)
    return spark.read.parquet(path)


@workload("replace_table", "SELECT * FROM customer")
def replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "replaced")
    sinks.overwrite(table(spark, sf_dir, "orders"), path)
    sinks.overwrite(table(spark, sf_dir, "customer"), path)
    return spark.read.parquet(path)


def _new_table(spark: SparkSession, name: str) -> str:
    """An unused table name in the database of the checks."""
    sinks.ensure_database(spark, "tidemark_checks", f"{shared_root(spark)}/tidemark_checks")
    return f"tidemark_checks.{name}_{uuid.uuid4().hex}"


@workload(
    "ensure_table",
    """
    SELECT event_type AS source, user_id::VARCHAR AS module, max(ts) AS last_synced_at,
           max(ts) AS updated_at
    FROM events GROUP BY 1, 2
    """,
)
def ensure_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _new_table(spark, "watermarks")
    marks = event_marks(table(spark, sf_dir, "events"))
    for _ in range(2):
        sinks.ensure_table(spark, name, WATERMARK_SCHEMA, ["source"])
    full = marks.withColumn("updated_at", F.col("last_synced_at"))
    full.select(spark.table(name).columns).write.insertInto(name)
    return spark.table(name).select(
        "source",
        "module",
        F.col("last_synced_at").cast("timestamp_ntz").alias("last_synced_at"),
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
    )


@workload(
    "drop_table",
    "SELECT count(*) AS rows_before, true AS existed, false AS exists_now FROM orders",
)
def drop_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _new_table(spark, "old_orders")
    table(spark, sf_dir, "orders").write.saveAsTable(name)
    rows = spark.table(name).count()
    existed = spark.catalog.tableExists(name)
    for _ in range(2):
        sinks.drop_table(spark, name)
    return spark.range(1).select(
        F.lit(rows).cast("bigint").alias("rows_before"),
        F.lit(existed).alias("existed"),
        F.lit(spark.catalog.tableExists(name)).alias("exists_now"),
    )
