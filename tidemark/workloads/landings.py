"""Landed feeds that come in parts, twice, late or damaged; tables merged on read; streams with state."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark import jobs
from tidemark.functions.text import float_text
from tidemark.operators.history import CHANGED, history_state
from tidemark.plans.modules import Module, Synced, sync_modules
from tidemark.plans.store import Store
from tidemark.session import scratch
from tidemark.sinks.commits import CommittedLog, Commits
from tidemark.sinks.merged import MergedTable
from tidemark.streaming.changes import stream_changes
from tidemark.streaming.dedupe import dedupe_stream, late_rows
from tidemark.streaming.upsert import stream_upsert
from tidemark.workloads.changes import _CHANGE, revenue_records
from tidemark.workloads.registry import table, utc, workload
from tidemark.workloads.scans import iso, line_item_pages, links
from tidemark.workloads.syncs import _KNOWN, _rows, _together, first_records

# Merge on read. The table holds the orders before 1998; three deltas bring every seventh
# order with another price, one brings versions that came late, one deletes.


def _merged_orders(spark: SparkSession, sf_dir: str) -> MergedTable:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    target = MergedTable(spark, f"{scratch(spark, 'merged')}/orders", ["o_orderkey"], 16, newest=True)
    target.upsert(orders.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")), ["o_orderdate"])
    for days in range(3):
        delta = orders.filter(F.col("o_orderkey") % 7 == days).select(
            "o_orderkey",
            (F.col("o_orderdate") + F.make_dt_interval(days=F.lit(days))).alias("o_orderdate"),
            (F.col("o_totalprice") + (days + 1)).alias("o_totalprice"),
        )
        target.upsert(delta, ["o_orderdate"])
    old = F.lit("1900-01-01").cast("timestamp_ntz")
    late = orders.filter(F.col("o_orderkey") % 7 == 1).withColumns({"o_orderdate": old, "o_totalprice": F.lit(0.0)})
    target.upsert(late, ["o_orderdate"])
    gone = orders.filter(F.col("o_orderkey") % 11 == 0).select("o_orderkey", F.lit("2100-01-01").cast("timestamp_ntz").alias("o_orderdate"))
    target.delete(gone, ["o_orderdate"])
    return target


_MERGED = """
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 7 < 3 THEN o_orderdate + to_days((o_orderkey % 7)::INTEGER) ELSE o_orderdate END AS o_orderdate,
           CASE WHEN o_orderkey % 7 < 3 THEN o_totalprice + (o_orderkey % 7 + 1) ELSE o_totalprice END AS o_totalprice
    FROM orders
    WHERE (o_orderdate < TIMESTAMP '1998-01-01' OR o_orderkey % 7 < 3) AND o_orderkey % 11 <> 0
"""


@workload("upsert_merge_on_read", _MERGED)
def upsert_merge_on_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deltas and tombstones on top of a base, in any order of time."""
    return _merged_orders(spark, sf_dir).read()


@workload("compact", f"SELECT *, 0::BIGINT AS rows_left FROM ({_MERGED})")
def compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table once its parts are written anew: only tombstones are left on top."""
    target = _merged_orders(spark, sf_dir)
    target.compact(all_parts=True)
    again = MergedTable(spark, target.path)
    left = again._deltas(again._state(), None)
    rows = F.lit(0 if left is None else left.filter("NOT __gone").count()).cast("bigint")
    return again.read().withColumn("rows_left", rows)


@workload("append_exactly_once", "SELECT event_id, user_id, ts, 3::BIGINT AS commits FROM events")
def append_exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs append a third of the events each; the second dies before its commit, is
    repeated, and repeated again."""
    root = scratch(spark, "log")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")

    def log() -> CommittedLog:
        return CommittedLog(spark, f"{root}/log", Commits(spark, f"{root}/commits"), "events", {"day": F.to_date("ts").cast("string")})

    def third(run: int) -> DataFrame:
        return events.filter(F.col("event_id") % 3 == run)

    log().append(third(0), "run-0")
    log().stage(third(1))
    for _ in range(2):
        log().append(third(1), "run-1")
    log().append(third(2), "run-2")
    return log().read().withColumn("commits", F.lit(len(log().commits.all())).cast("bigint"))


# A landing. Pages of some hundred orders, every fifth of them only in a later run.


def _land(lines: DataFrame, landing: str, feed: str, part: str) -> None:
    """Lines of text as files of a feed."""
    lines.write.text(f"{landing}/{feed}/{part}")


def _order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page, value): numbered module pages of orders as JSON text."""
    orders = table(spark, sf_dir, "orders")
    number = (F.floor(F.col("o_orderkey") / 100) + 1).alias("page")
    last = orders.agg(F.max(number).alias("last"))
    key = F.col("o_orderkey")
    record = F.struct(
        F.when(key % 50 != 7, key.cast("string")).alias("id"),
        F.concat(F.lit("order "), key.cast("string")).alias("tag"),
        F.col("o_totalprice").alias("Amount"),
        iso(F.col("o_orderdate")).alias("Modified_Time"),
    )
    pages = orders.groupBy(number).agg(F.collect_list(record).alias("data"))
    info = F.struct((F.col("page") < last.scalar()).alias("more_records"))
    return pages.select("page", F.to_json(F.struct("page", "data", info.alias("info"))).alias("value"))


def _synced(results: list[list[Synced]], label: str) -> list[tuple[str, str, str]]:
    out = []
    for run, each in enumerate(results):
        for r in each:
            if r.label == label:
                mark = "" if r.watermark is None else f"{r.watermark:%Y-%m-%d %H:%M:%S}"
                out.append((f"run {run}", r.status, f"{r.records} {str(r.complete).lower()} {mark}".strip()))
    return out


def _facts(spark: SparkSession, rows: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rows, "table_name string, id string, detail string")


def _run_landing(spark: SparkSession, sf_dir: str) -> tuple[Store, list[list[Synced]]]:
    """Three runs: most pages and a few broken lines, then the pages in between, then nothing new."""
    root = scratch(spark, "landing")
    store, landing = Store(spark, f"{root}/store"), f"{root}/landing"
    pages = _order_pages(spark, sf_dir)
    broken = table(spark, sf_dir, "nation").filter("n_nationkey < 5").select(F.concat(F.lit("{broken "), F.col("n_nationkey").cast("string")).alias("value"))
    parts = [pages.filter("page % 5 <> 2").select("value").unionByName(broken), pages.filter("page % 5 = 2").select("value"), None]
    results = []
    for run, part in enumerate(parts):
        if part is not None:
            _land(part, landing, "Deals", f"run-{run}")
        feeds = jobs.Landing(store, landing, f"run-{run}", utc(f"2024-06-0{run + 1}T00:00:00"))
        module = Module("Deals", "Deals", feeds.module("Deals"))
        results.append(sync_modules(store, "crm", [module], f"run-{run}", feeds.at))
    return store, results


@workload(
    "arrivals",
    """
    WITH o AS (SELECT *, o_orderkey // 100 + 1 AS page FROM orders),
    n AS (SELECT count(*) FILTER (page % 5 <> 2) AS first, count(*) FILTER (page % 5 = 2) AS later,
                 max(o_orderdate) FILTER (o_orderkey >= 0) AS mark FROM o)
    SELECT 'Deals' AS table_name, o_orderkey::VARCHAR AS id, o_totalprice::VARCHAR AS detail FROM o WHERE o_orderkey % 50 <> 7
    UNION ALL SELECT 'run 0', 'synced', first || ' false' FROM n
    UNION ALL SELECT 'run 1', 'synced', later || ' true ' || strftime(mark, '%Y-%m-%d %H:%M:%S') FROM n
    UNION ALL SELECT 'run 2', 'idle', '0 true ' || strftime(mark, '%Y-%m-%d %H:%M:%S') FROM n
    """,
)
def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older pages that come later are loaded, the mark waits for them, and a run without
    new files reads none."""
    store, results = _run_landing(spark, sf_dir)
    rows = _rows(store.read("Deals"), "Deals", F.col("id"), float_text(F.col("Amount")))
    return rows.unionByName(_facts(spark, _synced(results, "Deals")))


@workload(
    "quarantine",
    """
    SELECT 'Deals' AS table_name, 'unreadable' AS reason, 'run-0' AS run_id, '{broken ' || n_nationkey AS detail
    FROM nation WHERE n_nationkey < 5
    UNION ALL
    SELECT 'Deals', 'no key', CASE WHEN (o_orderkey // 100 + 1) % 5 = 2 THEN 'run-1' ELSE 'run-0' END, 'order ' || o_orderkey
    FROM orders WHERE o_orderkey % 50 = 7
    """,
)
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What could not be loaded: lines that are no JSON, counted in one run only, and records without a key."""
    store, _ = _run_landing(spark, sf_dir)
    detail = F.coalesce(F.get_json_object("row", "$.unreadable"), F.get_json_object("row", "$.tag"))
    return store.quarantined().select("table_name", "reason", "run_id", detail.alias("detail"))


# Objects whose time of change stands in one property, in the other, in both, is
# unreadable or missing; the feed is cut and goes on in the next run.


def _damaged_deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, value): a page for each order."""
    kind, at = F.col("o_orderkey") % 5, iso(F.col("o_orderdate"))

    def stated(name: str, value: Column) -> Column:
        return F.create_map(F.lit(name), value)

    amount = stated("amount", float_text(F.col("o_totalprice")))
    time = (
        F.when(kind == 0, stated("lastmodifieddate", at))
        .when(kind == 1, stated("hs_lastmodifieddate", at))
        .when(kind == 2, stated("lastmodifieddate", F.lit("soon")))
        .when(kind == 4, F.map_concat(stated("lastmodifieddate", at), stated("hs_lastmodifieddate", F.lit("1980-01-01T00:00:00Z"))))
        .otherwise(F.create_map().cast("map<string,string>"))
    )
    deal = F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        F.map_concat(amount, time).alias("properties"),
        F.struct(links(F.col("o_custkey")).alias("companies")).alias("associations"),
    )
    last = table(spark, sf_dir, "orders").agg(F.max("o_orderkey").alias("last"))
    after = F.when(F.col("o_orderkey") < last.scalar(), F.col("o_orderkey").cast("string"))
    paging = F.struct(F.struct(after.alias("after")).alias("next"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.to_json(F.struct(F.array(deal).alias("results"), paging.alias("paging"))).alias("value"))


@workload(
    "sync_objects_damaged",
    """
    WITH last AS (SELECT max(o_orderkey) AS k FROM orders),
    n AS (SELECT count(*) FILTER (o_orderkey % 3 > 0 AND o_orderkey <> k) AS first,
                 count(*) FILTER (o_orderkey % 3 = 0 OR o_orderkey = k) AS later,
                 max(o_orderdate) FILTER (o_orderkey % 5 IN (0, 1, 4)) AS mark FROM orders, last)
    SELECT 'Deals' AS table_name, o_orderkey::VARCHAR AS id, o_totalprice::VARCHAR AS detail FROM orders
    UNION ALL SELECT 'Companies', c_custkey::VARCHAR, c_name FROM customer
    UNION ALL SELECT 'quarantine', 'deals unreadable', '{cut ' || r_name FROM region
    UNION ALL SELECT 'run 0', 'synced', first || ' false' FROM n
    UNION ALL SELECT 'run 1', 'synced', later || ' true ' || strftime(mark, '%Y-%m-%d %H:%M:%S') FROM n
    UNION ALL SELECT 'run 2', 'idle', '0 true ' || strftime(mark, '%Y-%m-%d %H:%M:%S') FROM n
    """,
)
def sync_objects_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing that landed is lost: it is loaded, or set aside with its reason."""
    root = scratch(spark, "damaged")
    store, landing = Store(spark, f"{root}/store"), f"{root}/landing"
    deals = _damaged_deals(spark, sf_dir)
    last = table(spark, sf_dir, "orders").agg(F.max("o_orderkey").alias("last"))
    later = (F.col("o_orderkey") % 3 == 0) | (F.col("o_orderkey") == last.scalar())
    cut = table(spark, sf_dir, "region").select(F.concat(F.lit("{cut "), F.col("r_name")).alias("value"))
    company = F.struct(F.col("c_custkey").cast("string").alias("id"), F.create_map(F.lit("name"), F.col("c_name")).alias("properties"))
    companies = table(spark, sf_dir, "customer").select(F.to_json(F.struct(F.array(company).alias("results"))).alias("value"))
    stage = F.array(F.struct(F.lit("s").alias("id"), F.lit("S").alias("label"), F.lit(0).alias("displayOrder")))
    pipeline = F.struct(F.col("r_name").alias("id"), F.col("r_name").alias("label"), stage.alias("stages"))
    owner = F.struct(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("firstName"))
    items = line_item_pages(table(spark, sf_dir, "lineitem").filter("l_linenumber = 1"))
    _land(table(spark, sf_dir, "region").select(F.to_json(F.struct(F.array(pipeline).alias("results"))).alias("value")), landing, "pipelines", "all")
    for name, part in (("owners", "n_nationkey % 2 = 0"), ("owners_archived", "n_nationkey % 2 = 1")):
        _land(table(spark, sf_dir, "nation").filter(part).select(F.to_json(F.struct(F.array(owner).alias("results"))).alias("value")), landing, name, "all")
    _land(companies, landing, "companies", "all")
    _land(items.select(F.to_json(F.struct("results")).alias("value")), landing, "line_items", "all")
    results = []
    for run, part in enumerate((deals.filter(~later).select("value").unionByName(cut), deals.filter(later).select("value"), None)):
        if part is not None:
            _land(part, landing, "deals", f"run-{run}")
        feeds = jobs.Landing(store, landing, f"run-{run}", utc(f"2024-06-0{run + 1}T00:00:00"))
        results.append(jobs.objects(feeds, "crm", feeds.at, "hold"))
    kept = store.quarantined().select(
        F.lit("quarantine").alias("table_name"), F.concat_ws(" ", "table_name", "reason").alias("id"), F.get_json_object("row", "$.unreadable").alias("detail")
    )
    return _together(
        [
            _rows(store.read("Deals"), "Deals", F.col("id"), F.col("amount")),
            _rows(store.read("Companies"), "Companies", F.col("id"), F.col("name")),
            kept,
            _facts(spark, _synced(results, "deals")),
        ]
    )


@workload(
    "refresh_discovered",
    """
    SELECT 'raw_Geschaefte' AS table_name, o_orderkey::VARCHAR AS id, o_totalprice::VARCHAR AS detail FROM orders
    UNION ALL SELECT 'raw_Blocks', 'b' || n_nationkey, n_name FROM nation
    UNION ALL SELECT 'run 0', 'Geschaefte', 'replaced ' || count(*) FROM orders
    UNION ALL SELECT 'run 0', 'Blocks', 'replaced ' || count(*) FROM nation
    UNION ALL SELECT 'run 0', 'Firmen', 'incomplete 0' FROM region WHERE r_regionkey = 0
    """,
)
def refresh_discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The modules are those the source lists, under its names; one of three feeds is cut."""
    root = scratch(spark, "discovered")
    store, landing = Store(spark, f"{root}/store"), f"{root}/landing"
    listed = [("Geschaefte", "Deals"), ("Blocks", "Blocks"), ("Firmen", "Companies"), ("Other", "Others")]
    names = F.array(*[F.struct(F.lit(a).alias("api_name"), F.lit(p).alias("plural_label"), F.lit(p).alias("singular_label")) for a, p in listed])
    one = table(spark, sf_dir, "region").filter("r_regionkey = 0")
    _land(one.select(F.to_json(F.struct(names.alias("modules"))).alias("value")), landing, "modules", "all")
    nation = F.struct(F.concat(F.lit("b"), F.col("n_nationkey").cast("string")).alias("id"), F.col("n_name").alias("Name"))
    order = F.struct(F.col("o_orderkey").cast("string").alias("id"), F.col("o_totalprice").alias("Amount"))

    def page(number: Column, record: Column, more: Column) -> Column:
        info = F.struct(more.alias("more_records"))
        return F.to_json(F.struct(number.alias("page"), F.array(record).alias("data"), info.alias("info"))).alias("value")

    orders, nations = table(spark, sf_dir, "orders"), table(spark, sf_dir, "nation")
    ranked = orders.withColumn("page", F.col("o_orderkey") + 1)
    last = ranked.agg(F.max("page")).scalar()
    _land(ranked.select(page(F.col("page"), order, F.col("page") < last)), landing, "Geschaefte", "all")
    _land(nations.select(page(F.col("n_nationkey") + 1, nation, F.col("n_nationkey") < 24)), landing, "Blocks", "all")
    _land(nations.select(page(F.col("n_nationkey") + 1, nation, F.lit(True))), landing, "Firmen", "all")
    feeds = jobs.Landing(store, landing, "run-0", utc("2024-06-01T00:00:00"))
    results = jobs.refresh_all_modules(feeds, "crm", feeds.at, "hold")
    told = [("run 0", r.label, f"{r.status} {r.records}") for r in results]
    return _together(
        [
            _rows(store.read("raw_Geschaefte"), "raw_Geschaefte", F.col("id"), F.col("Amount")),
            _rows(store.read("raw_Blocks"), "raw_Blocks", F.col("id"), F.col("Name")),
            _facts(spark, told),
        ]
    )


# Streams with state


def _files(parts: list[DataFrame], path: str) -> None:
    """One file a part, in the order in which a stream is to read them."""
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)


def _stream(spark: SparkSession, path: str, schema, files: int | None = 1) -> DataFrame:
    """``files`` a batch, or all that are there."""
    reader = spark.readStream.schema(schema)
    return (reader if files is None else reader.option("maxFilesPerTrigger", files)).parquet(path)


@workload(
    "stream_dedupe",
    """
    WITH e AS (SELECT *, floor(4 * (epoch_us(ts) - lo) / (hi - lo + 1)) AS part
               FROM events, (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events))
    SELECT event_id, user_id, ts, CASE WHEN part = 0 AND event_id % 11 = 0 THEN 'late' ELSE 'on time' END AS kind FROM e
    """,
)
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four files of events by time; some of the first quarter come only with the last file,
    and every fifth event comes again with the file after its own."""
    root = scratch(spark, "dedupe")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    ends = events.agg(F.min(F.unix_micros("ts")).alias("lo"), F.max(F.unix_micros("ts")).alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    parted = events.withColumn("part", F.floor((F.unix_micros("ts") - lo) * 4 / (hi - lo + 1)))
    held = (F.col("part") == 0) & (F.col("event_id") % 11 == 0)
    again = (F.col("event_id") % 5 == 0) & ~held

    def file(k: int) -> DataFrame:
        come = ((F.col("part") == k) & ~held) | (again & (F.col("part") == k - 1))
        return parted.filter(come | held if k == 3 else come).drop("part")

    _files([file(k) for k in range(4)], f"{root}/landing")
    commits = Commits(spark, f"{root}/commits")
    by = {"day": F.to_date("ts").cast("string")}
    log = CommittedLog(spark, f"{root}/log", commits, "events", by)
    late = CommittedLog(spark, f"{root}/late", commits, "late", by)
    name = f"dedupe_{root.rsplit('-', 1)[-1]}"
    stream = _stream(spark, f"{root}/landing", events.schema)
    dedupe_stream(stream, log, ["event_id"], "ts", "1 hour", name=name, checkpoint=f"{root}/check").awaitTermination()
    late_rows(
        stream, log, late, ["event_id"], "ts", "1 hour",
        name=f"{name}_late", checkpoint=f"{root}/check-late", staging=f"{root}/staging",
    ).awaitTermination()
    found = [(log, "on time"), (late, "late")]
    return _together([x.read().select("event_id", "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), F.lit(k).alias("kind")) for x, k in found])


@workload(
    "stream_changes",
    _KNOWN
    + f"""
    , changed AS (SELECT c.id, c.block, c.name, c.date, c.amount,
                         CASE WHEN p.id IS NULL THEN 'Create' ELSE {_CHANGE} END AS type
                  FROM current c LEFT JOIN previous p USING (id))
    SELECT id AS revenue_id, block AS "Block_id", name AS block_name, date AS "Revenue_date", amount, type AS "Type"
    FROM changed WHERE type <> ''
    UNION ALL SELECT id, block, name, date, amount, 'Create' FROM previous
    """,
)
def stream_changes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings of states, a batch each; the stream is stopped between them and goes on from its checkpoint."""
    root = scratch(spark, "changes")
    log = CommittedLog(spark, f"{root}/log", Commits(spark, f"{root}/commits"), "changes")
    for run, records in enumerate((first_records(spark, sf_dir), revenue_records(spark, sf_dir))):
        at: datetime = utc(f"2024-0{run + 5}-01T12:00:00")
        states = history_state(records).withColumn(CHANGED, F.lit(f"{at:%Y-%m-%d %H:%M:%S}Z").cast("timestamp"))
        states.write.mode("append").parquet(f"{root}/landing")  # as many files as it takes
        stream = _stream(spark, f"{root}/landing", states.schema, None)
        name = f"changes_{root.rsplit('-', 1)[-1]}"
        stream_changes(stream, log, at, name=name, checkpoint=f"{root}/check").awaitTermination()
    return log.read().drop("action_id", "action_timestamp")


@workload(
    "stream_upsert_merged",
    """
    SELECT user_id, event_id, ts, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1
    """,
)
def stream_upsert_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of events in no order of time into a table merged on read: a batch writes its own rows only."""
    root = scratch(spark, "stream")
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    events.repartition(4, "event_id").write.parquet(f"{root}/landing")
    target = MergedTable(spark, f"{root}/target", ["user_id"], newest=True)
    stream_upsert(
        _stream(spark, f"{root}/landing", events.schema, 2), target, ["user_id"], ["ts", "event_id"],
        name=f"upsert_{root.rsplit('-', 1)[-1]}", checkpoint=f"{root}/checkpoint", staging=f"{root}/staging",
    ).awaitTermination()
    return target.read()
