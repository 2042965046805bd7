"""Whole syncs over landed data, run more than once, and the streaming upsert."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.text import float_text
from tidemark.operators.filters import delta_filter
from tidemark.plans.history import History
from tidemark.plans.modules import Module, sync_modules
from tidemark.plans.objects import ObjectSource, sync_objects
from tidemark.plans.refresh import PagedModule, RefreshSource, refresh_objects, refresh_with_history
from tidemark.plans.store import Store
from tidemark.operators.watermark import INITIAL_LOOKBACK
from tidemark.session import materialize, scratch
from tidemark.sinks.partitioned import PartitionedTable
from tidemark.sinks.snapshot import SnapshotTable
from tidemark.sources.pages import (
    feed_complete,
    read_module_pages,
    read_object_pages,
    read_variant_pages,
    unwrap_line_items,
    unwrap_objects,
)
from tidemark.streaming.upsert import stream_upsert
from tidemark.workloads.changes import _CHANGE, _ENTRY, _FULL, _STATES, revenue_records
from tidemark.workloads.links import _SPLITS, blocks_of, pipelines_of
from tidemark.workloads.registry import table, utc, workload
from tidemark.workloads.scans import deal_pages, land, line_item_pages


def _rows(df: DataFrame, name: str, key: Column, detail: Column) -> DataFrame:
    return df.select(
        F.lit(name).alias("table_name"), key.cast("string").alias("id"), detail.cast("string").alias("detail")
    )


def _together(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# Modules. The first run sees the orders before 1998; the second all of them, every
# seventh with a new price.


def _orders_feed(spark: SparkSession, sf_dir: str, second: bool):
    def feed(since):
        orders = table(spark, sf_dir, "orders")
        price = F.col("o_totalprice")
        if second:
            price = F.when(F.col("o_orderkey") % 7 == 0, price + 100).otherwise(price)
        else:
            orders = orders.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
        return delta_filter(orders, "o_orderdate", since).select(
            F.col("o_orderkey").cast("string").alias("id"),
            F.struct(F.col("o_custkey").alias("id")).alias("Account"),
            price.alias("Amount"),
            F.col("o_orderdate").alias("Modified_Time"),
        )

    return feed


def _accounts_feed(spark: SparkSession, sf_dir: str, second: bool):
    def feed(since):
        name = F.upper("c_name") if second else F.col("c_name")
        start = F.lit("1997-01-01").cast("timestamp_ntz")
        rows = table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("id"),
            name.alias("Account Name"),
            (start + F.make_dt_interval(mins=F.col("c_custkey").cast("int"))).alias("Modified_Time"),
        )
        return delta_filter(rows, "Modified_Time", since, inclusive=False)

    return feed


def _unreachable(spark: SparkSession):
    return lambda since: spark.read.json(scratch(spark, "never-landed"))


def _modules(spark: SparkSession, sf_dir: str, second: bool) -> list[Module]:
    return [
        Module("Accounts", "Accounts", _accounts_feed(spark, sf_dir, second)),
        Module("Deals", "Deals", _orders_feed(spark, sf_dir, second)),
        Module("Blocks", "Blocks", lambda since: blocks_of(spark, sf_dir)),
        Module(
            "Site Splits",
            "Site_Splits",
            _unreachable(spark),
            key=("Parent_Id_id", "Site"),
            subform_of="Blocks",
        ),
        Module("Stage History", "Deal_History", _unreachable(spark)),
    ]


@workload(
    "sync_modules",
    f"""
    WITH splits AS ({_SPLITS}),
    overlap AS (SELECT max(o_orderdate) - INTERVAL 15 MINUTE AS since FROM orders
                WHERE o_orderdate < TIMESTAMP '1998-01-01'),
    last AS (SELECT max(c_custkey) AS k FROM customer),
    n AS (SELECT (SELECT count(*) FROM customer) AS accounts, (SELECT count(*) FROM splits) AS splits)
    SELECT 'Deals' AS table_name, o_orderkey::VARCHAR AS id,
           o_custkey || ' ' || (CASE WHEN o_orderkey % 7 = 0 AND o_orderdate >= since
                                     THEN o_totalprice + 100 ELSE o_totalprice END)::VARCHAR AS detail
    FROM orders, overlap
    UNION ALL
    SELECT 'Accounts', c_custkey::VARCHAR, CASE WHEN c_custkey > k - 15 THEN upper(c_name) ELSE c_name END
    FROM customer, last
    UNION ALL SELECT 'Site_Splits', "Parent_Id_id", "Site" FROM splits
    UNION ALL
    SELECT 'watermark', 'Deals', strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') FROM orders
    UNION ALL
    SELECT 'watermark', 'Accounts',
           strftime(TIMESTAMP '1997-01-01' + to_minutes(k::INTEGER), '%Y-%m-%d %H:%M:%S') FROM last
    UNION ALL
    SELECT 'run_log', 'SUCCESS', (accounts + accounts + splits +
           (SELECT count(*) FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'))::VARCHAR FROM n
    UNION ALL
    SELECT 'run_log', 'SUCCESS', (15 + accounts + splits +
           (SELECT count(*) FROM orders, overlap WHERE o_orderdate >= since))::VARCHAR FROM n
    """,
)
def sync_modules_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs; one module without a feed is taken from its parent, one is skipped."""
    store = Store(spark, scratch(spark, "modules"))
    for run, at in enumerate((utc("1998-01-01T00:00:00"), utc("2003-01-01T00:00:00"))):
        sync_modules(store, "crm", _modules(spark, sf_dir, run == 1), f"run-{run}", at)
    marks = store.watermarks().filter(F.col("module").isin("Deals", "Accounts"))
    amount = F.concat_ws(" ", "Account_id", float_text(F.col("Amount")))
    return _together(
        [
            _rows(store.read("Deals"), "Deals", F.col("id"), amount),
            _rows(store.read("Accounts"), "Accounts", F.col("id"), F.col("Account_Name")),
            _rows(store.read("Site_Splits"), "Site_Splits", F.col("Parent_Id_id"), F.col("Site")),
            _rows(marks, "watermark", F.col("module"), F.col("last_synced_at")),
            _rows(store.run_log(), "run_log", F.col("status"), F.col("records_processed")),
        ]
    )


# History. The first run creates all but the urgent records, the second brings the
# changes.

_KNOWN = _STATES.replace(
    """CASE WHEN o_orderkey % 17 = 0 THEN 'Delete'
                  WHEN o_orderkey % 5 = 0 THEN 'Amount changed' ELSE 'Create' END""",
    "'Create'",
)
_CREATED = """
    SELECT 'A' || sha256('run-0' || chr(31) || id || chr(31) || 'Create') AS action_id,
           '2024-05-01 17:30:00' AS action_timestamp, block AS "Block_id", id AS revenue_id,
           name AS block_name, date AS "Revenue_date", amount, 'Create' AS "Type"
    FROM previous
"""


def first_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records a history starts with."""
    block = F.nullif(F.col("o_custkey") % 50, F.lit(0)).cast("string")
    lookup = F.struct(block.alias("id"), F.concat(F.lit("Block "), block).alias("name"))
    return (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderpriority") != "1-URGENT")
        .select(
            F.col("o_orderkey").cast("string").alias("id"),
            F.col("o_totalprice").alias("Amount"),
            F.nullif("o_orderstatus", F.lit("P")).alias("Date"),
            F.when(block.isNotNull(), lookup).alias("Parent_Id"),
        )
    )


@workload(
    "sync_with_history",
    _KNOWN
    + ", entries AS (SELECT * FROM (SELECT c.id, c.block, c.name, c.date, c.amount,"
    + f" CASE WHEN p.id IS NULL THEN 'Create' ELSE {_CHANGE} END AS type"
    + " FROM current c LEFT JOIN previous p USING (id)) WHERE type <> '')"
    + _ENTRY
    + " UNION ALL "
    + _CREATED,
)
def sync_with_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, scratch(spark, "history"))
    for run, (records, at) in enumerate(
        (
            (first_records(spark, sf_dir), "2024-05-01T12:00:00"),
            (revenue_records(spark, sf_dir), "2024-06-01T12:00:00"),
        )
    ):
        feed = records.withColumn("Modified_Time", F.lit(at + "Z"))
        module = Module(
            "Revenue Recognition", "Revenue_Recognition", lambda since, feed=feed: feed, keeps_history=True
        )
        sync_modules(store, "crm", [module], f"run-{run}", utc(at))
    return History(store).read()


# Objects


def _owners(spark: SparkSession, sf_dir: str):
    def feed(archived: bool) -> DataFrame:
        part = F.split("s_name", "#")
        in_pass = F.col("s_acctbal") < 0 if archived else F.col("s_acctbal") >= 0
        return (
            table(spark, sf_dir, "supplier")
            .filter(in_pass)
            .select(
                F.col("s_suppkey").cast("string").alias("id"),
                F.when(F.col("s_nationkey") != 3, part[0]).alias("firstName"),
                part[1].alias("lastName"),
            )
        )

    return feed


def _all_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as companies; the rich ones were modified lately."""
    lately = F.when(F.col("c_acctbal") > 9000, "2024-05-30T00:00:00Z").otherwise("1980-01-01T00:00:00Z")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        lately.alias("hs_lastmodifieddate"),
    )


def _deal_objects(spark: SparkSession, path: str) -> DataFrame:
    return unwrap_objects(
        read_object_pages(spark, path), ["amount", "dealstage", "lastmodifieddate"], companies=True
    )


_OBJECTS = """
    WITH deals AS (
      SELECT o_orderkey::VARCHAR AS id, o_totalprice AS price, o_custkey, o_orderdate FROM orders
      UNION ALL
      SELECT o_orderkey::VARCHAR || '-renewal', o_totalprice * 2, o_custkey, o_orderdate FROM orders),
    fetched AS (SELECT * FROM deals WHERE {deal_filter}),
    named AS (SELECT o_custkey AS k FROM fetched UNION SELECT o_custkey % 7 FROM fetched)
    SELECT 'Pipelines' AS table_name, s.name || '-' || c_custkey AS id, s.i::VARCHAR AS detail
    FROM customer, (VALUES ('open', 0), ('won', 1), ('lost', 2)) s(name, i)
    WHERE c_mktsegment <> 'MACHINERY'
    UNION ALL
    SELECT 'Owners', s_suppkey::VARCHAR,
           CASE WHEN s_nationkey <> 3 THEN replace(s_name, '#', ' ') {unnamed} END
           || ' ' || (s_acctbal < 0)::VARCHAR FROM supplier
    UNION ALL SELECT 'Deals', id, price::VARCHAR FROM fetched
    UNION ALL
    SELECT 'Companies', c_custkey::VARCHAR, c_name FROM customer
    WHERE c_custkey IN (SELECT k FROM named) {delta}
    UNION ALL
    SELECT {distinct} 'Line_Items',
           concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag),
           CASE WHEN l_returnflag <> 'R' THEN l_orderkey::VARCHAR END FROM lineitem
"""


def _object_tables(store: Store) -> DataFrame:
    owner = F.concat(F.col("fullName"), F.lit(" "), F.col("archived").cast("string"))
    return _together(
        [
            _rows(store.read("Pipelines"), "Pipelines", F.col("stage_id"), F.col("display_order")),
            _rows(store.read("Owners"), "Owners", F.col("id"), owner),
            _rows(store.read("Deals"), "Deals", F.col("id"), F.col("amount")),
            _rows(store.read("Companies"), "Companies", F.col("id"), F.col("name")),
            _rows(store.read("Line_Items"), "Line_Items", F.col("id"), F.col("associated_deal_id")),
        ]
    )


@workload(
    "sync_objects",
    _OBJECTS.format(
        deal_filter="o_orderdate >= TIMESTAMP '1999-10-10 12:00:00'",
        unnamed="ELSE split_part(s_name, '#', 2)",
        delta="OR c_acctbal > 9000",
        distinct="DISTINCT",
    )
    + """
    UNION ALL
    SELECT 'watermark', 'deals', strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') FROM orders
    UNION ALL SELECT 'watermark', 'companies', '2024-05-30 00:00:00'
    UNION ALL
    SELECT 'watermark', 'line_items', strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') FROM lineitem
    """,
)
def sync_objects_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run over landed pages: the deals of a past mark on, and the companies
    they name beside the ones modified lately."""
    deals = land(deal_pages(table(spark, sf_dir, "orders")), "deal-pages")
    items = land(line_item_pages(table(spark, sf_dir, "lineitem")), "line-item-pages")
    store = Store(spark, scratch(spark, "objects"))
    now = utc("2024-06-01T12:00:00")
    start = utc("1999-10-10T12:15:00")
    store.advance("crm", "deals", start, start, "start")
    store.advance("crm", "line_items", utc("1990-01-01T00:00:00"), start, "start")
    feeds = ObjectSource(
        pipelines=lambda: pipelines_of(spark, sf_dir),
        owners=_owners(spark, sf_dir),
        deals=lambda since: delta_filter(_deal_objects(spark, deals), "lastmodifieddate", since),
        companies=lambda since: delta_filter(
            _all_companies(spark, sf_dir), "hs_lastmodifieddate", since
        ),
        all_companies=lambda: _all_companies(spark, sf_dir),
        line_items=lambda since: delta_filter(
            unwrap_line_items(read_object_pages(spark, items)), "lastmodifieddate", since
        ),
    )
    sync_objects(store, "crm", feeds, "run-0", now, lookback=INITIAL_LOOKBACK)
    marks = _rows(store.watermarks(), "watermark", F.col("module"), F.col("last_synced_at"))
    return _object_tables(store).unionByName(marks)


@workload(
    "full_refresh_objects",
    _OBJECTS.format(deal_filter="true", unnamed="", delta="", distinct="")
    + """
    UNION ALL
    SELECT 'etl_logs', 'SUCCESS', (
      (SELECT 3 * count(*) FROM customer WHERE c_mktsegment <> 'MACHINERY') + (SELECT count(*) FROM supplier)
      + (SELECT count(*) FROM deals) + (SELECT count(*) FROM customer WHERE c_custkey IN (SELECT k FROM named))
      + (SELECT count(*) FROM lineitem))::VARCHAR
    """,
)
def full_refresh_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    deals = land(deal_pages(table(spark, sf_dir, "orders")), "deal-pages")
    items = land(line_item_pages(table(spark, sf_dir, "lineitem")), "line-item-pages")
    store = Store(spark, scratch(spark, "refresh"))
    feeds = RefreshSource(
        pipelines=lambda: pipelines_of(spark, sf_dir),
        owners=_owners(spark, sf_dir),
        deals=lambda: _deal_objects(spark, deals),
        companies=lambda: _all_companies(spark, sf_dir),
        line_items=lambda: unwrap_line_items(read_object_pages(spark, items)),
    )
    refresh_objects(store, feeds, "run-0", utc("2024-06-01T12:00:00"))
    log = spark.read.parquet(f"{store.root}/meta/etl_logs")
    return _object_tables(store).unionByName(
        _rows(log, "etl_logs", F.col("status"), F.col("total_records_processed"))
    )


# Full refresh with history


def _landed_pages(
    spark: SparkSession, sf_dir: str, records: DataFrame, *, cut: bool = False
) -> DataFrame:
    """A numbered page for every order, empty where the snapshot lacks it. A cut feed
    ends with a page that announces more."""
    pages = (
        table(spark, sf_dir, "orders")
        .select(F.col("o_orderkey").cast("string").alias("id"), (F.col("o_orderkey") + 1).alias("page"))
        .join(records.select("id", F.struct(records.columns).alias("record")), "id", "left")
    )
    last = table(spark, sf_dir, "orders").agg(F.max("o_orderkey") + 1).scalar()
    more = F.lit(True) if cut else F.col("page") < last
    data = F.when(F.col("record").isNull(), F.array()).otherwise(F.array("record"))
    path = land(
        pages.select("page", data.alias("data"), F.struct(more.alias("more_records")).alias("info")),
        "revenue-pages",
    )
    return read_module_pages(spark, path, records.schema)


@workload(
    "full_refresh_history",
    _FULL.replace(_STATES, _KNOWN)
    + f"""
    , logged AS ({_ENTRY} UNION ALL {_CREATED})
    SELECT revenue_id AS id, action_id, action_timestamp, "Type" AS type, amount, "Revenue_date" AS date,
           "Block_id" AS block FROM logged
    UNION ALL SELECT id, NULL, NULL, 'current', amount, date, block FROM current
    """,
)
def full_refresh_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two whole snapshots, then a cut one, which changes nothing."""
    store = Store(spark, scratch(spark, "refresh-history"))
    current = revenue_records(spark, sf_dir)
    snapshots = (
        (_landed_pages(spark, sf_dir, first_records(spark, sf_dir)), "2024-05-01T12:00:00"),
        (_landed_pages(spark, sf_dir, current), "2024-06-01T12:00:00"),
        (_landed_pages(spark, sf_dir, current.filter(F.col("Date") == "O"), cut=True), "2024-07-01T12:00:00"),
    )
    for run, (pages, at) in enumerate(snapshots):
        module = PagedModule(
            "Revenue Recognition", "Revenue_Recognition", lambda pages=pages: pages, keeps_history=True
        )
        refresh_with_history(store, [module], f"run-{run}", utc(at))
    logged = History(store).read().select(
        F.col("revenue_id").alias("id"),
        "action_id",
        "action_timestamp",
        F.col("Type").alias("type"),
        "amount",
        F.col("Revenue_date").alias("date"),
        F.col("Block_id").alias("block"),
    )
    kept = store.read("Revenue_Recognition").select(
        "id",
        F.lit("current").alias("type"),
        F.regexp_replace("Amount", r"\.0$", "").alias("amount"),
        F.col("Date").alias("date"),
        F.col("Parent_Id_id").alias("block"),
    )
    return logged.unionByName(kept, allowMissingColumns=True)


# Streaming


@workload(
    "stream_upsert",
    """
    SELECT user_id, event_id, ts, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1
    """,
)
def stream_upsert_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of events arrive in no order of time, two per batch."""
    root = scratch(spark, "stream")
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    events.repartition(4, "event_id").write.parquet(f"{root}/landing")
    stream = (
        spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/landing")
    )
    target = SnapshotTable(spark, f"{root}/target")
    query = stream_upsert(
        stream,
        target,
        ["user_id"],
        [F.col("ts"), F.col("event_id")],
        name=f"upsert_{root.rsplit('-', 1)[-1]}",
        checkpoint=f"{root}/checkpoint",
        staging=f"{root}/staging",
    )
    query.awaitTermination()
    return target.read()


@workload(
    "stream_upsert_partitioned",
    """
    SELECT user_id, event_id, ts, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1
    """,
)
def stream_upsert_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same stream into a table of key buckets, of which a batch rewrites only its own."""
    root = scratch(spark, "stream")
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    events.repartition(4, "event_id").write.parquet(f"{root}/landing")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/landing")
    target = PartitionedTable(spark, f"{root}/target")
    query = stream_upsert(
        stream,
        target,
        ["user_id"],
        [F.col("ts"), F.col("event_id")],
        name=f"upsert_{root.rsplit('-', 1)[-1]}",
        checkpoint=f"{root}/checkpoint",
        staging=f"{root}/staging",
        partition_by=8,
    )
    query.awaitTermination()
    return target.read()


@workload(
    "upsert_partitioned",
    """
    SELECT o_orderkey, o_orderdate,
           CASE WHEN o_orderkey % 10 = 3 AND o_orderdate >= TIMESTAMP '1998-06-01'
                THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
           (SELECT count(DISTINCT date_trunc('month', o_orderdate)) FROM orders
            WHERE o_orderkey % 10 = 3 AND o_orderdate >= TIMESTAMP '1998-06-01') AS rewritten
    FROM orders
    """,
)
def upsert_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delta of the last months into a table partitioned by month: only its months are
    rewritten, which the result counts."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    target = PartitionedTable(spark, f"{scratch(spark, 'partitioned')}/orders")
    month = F.date_format("o_orderdate", "yyyy-MM")
    target.upsert(orders, ["o_orderkey"], month)
    late = (F.col("o_orderdate") >= F.lit("1998-06-01").cast("timestamp_ntz")) & (F.col("o_orderkey") % 10 == 3)
    delta = orders.filter(late).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    rewritten = target.upsert(delta, ["o_orderkey"], month)
    return target.read().withColumn("rewritten", F.lit(rewritten).cast("bigint"))


@workload(
    "upsert_drift",
    """
    SELECT layout, c_custkey AS id, CASE WHEN c_custkey % 5 = 0 THEN 2.0 ELSE c_acctbal END AS balance,
           CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_nationkey END AS nation,
           CASE WHEN c_custkey % 5 = 0 THEN 'word' ELSE (c_custkey % 100)::VARCHAR END AS code
    FROM customer, (VALUES ('whole'), ('partitioned')) AS t(layout)
    """,
)
def upsert_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delta with an integer for a float, a column of nulls only, and text for a number."""
    stored = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_nationkey").cast("int").alias("nation"),
        (F.col("c_custkey") % 100).alias("code"),
    )
    drifted = stored.filter(F.col("id") % 5 == 0).select(
        "id", F.lit(2).cast("bigint").alias("balance"), F.lit(None).cast("string").alias("nation"), F.lit("word").alias("code")
    )
    store = Store(spark, scratch(spark, "drift"))
    for run, staged in enumerate((store.stage(stored, "stored"), store.stage(drifted, "drifted"))):
        store.upsert("whole", staged, ["id"], [], f"run-{run}")
        store.upsert("partitioned", staged, ["id"], [], f"run-{run}", partition_by=4)

    def read(name: str) -> DataFrame:
        return store.read(name).select(F.lit(name).alias("layout"), "id", "balance", "nation", "code")

    return read("whole").unionByName(read("partitioned"))


@workload(
    "feed_completeness",
    """
    SELECT feed, feed IN ('whole', 'numbered_in_info', 'unnumbered') AS complete
    FROM (VALUES ('whole'), ('numbered_in_info'), ('unnumbered'), ('cut'), ('gap'), ('broken'), ('silent')) AS t(feed)
    WHERE (SELECT count(*) FROM supplier) > 0
    """,
)
def feed_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds of the suppliers' pages: whole, cut, with a page or a line missing, and with
    a last page that does not say that it is the last."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    number = (F.col("s_suppkey") / 4).cast("bigint")
    last = suppliers.agg(F.max(number).alias("last")).first()["last"] + 2
    paged = suppliers.groupBy((number + 1).alias("page")).agg(F.collect_list(F.struct("s_suppkey", "s_name")).alias("data"))
    # Pages of four, then an empty last one.
    paged = paged.unionByName(spark.createDataFrame([(last, [])], paged.schema))
    paged = materialize(paged.withColumn("more", F.col("page") < last), scratch(spark, "pages"))
    page, more = F.col("page").alias("page"), F.col("more").alias("more_records")
    top = F.struct(page, "data", F.struct(more).alias("info"))
    feeds = {
        "whole": paged.select(top.alias("j")),
        "numbered_in_info": paged.select(F.struct("data", F.struct(page, more).alias("info")).alias("j")),
        "unnumbered": paged.select(F.struct("data", F.struct(more).alias("info")).alias("j")),
        "cut": paged.filter("more").select(top.alias("j")),
        "gap": paged.filter("page <> 1").select(top.alias("j")),
        "broken": paged.select(top.alias("j")),
        "silent": paged.select(
            F.struct(page, "data", F.struct(F.when(F.col("more"), True).alias("more_records")).alias("info")).alias("j")
        ),
    }
    found = []
    for name, rows in feeds.items():
        path = scratch(spark, f"feed-{name}")
        lines = rows.select(F.to_json("j").alias("value"))
        if name == "broken":
            lines = lines.unionByName(spark.createDataFrame([("{broken",)], "value string"))
        lines.write.text(path)
        found.append(feed_complete(read_variant_pages(spark, path)).select(F.lit(name).alias("feed"), "complete"))
    return reduce(DataFrame.unionByName, found)
