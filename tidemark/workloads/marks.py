"""Watermarks, delta filters, checks and report orderings."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.times import as_utc
from tidemark.operators import quality as Q
from tidemark.operators import watermark as M
from tidemark.operators.filters import delta_filter
from tidemark.operators.ranking import latest_per_key
from tidemark.operators.upsert import upsert
from tidemark.session import materialize, scratch
from tidemark.workloads.registry import table, utc, workload
from tidemark.workloads.scans import event_marks, iso

RUN = utc("2024-06-01T12:00:00")
SINCE = utc("1998-01-01T00:00:00")


def _ntz(df: DataFrame, *columns: str) -> DataFrame:
    """Instants as UTC wall-clock values, the form the SQL side gives."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def stored_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mark per event type and user, as of the end of the events."""
    return event_marks(table(spark, sf_dir, "events")).withColumn(
        "updated_at", F.col("last_synced_at")
    )


_MARKS = """
    WITH marks AS (
      SELECT event_type AS source, user_id::VARCHAR AS module, max(ts) AS last_synced_at,
             max(ts) AS updated_at FROM events GROUP BY 1, 2)
"""


@workload("delta_filter", "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'")
def delta_filter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta_filter(table(spark, sf_dir, "orders"), "o_orderdate", SINCE)


@workload(
    "delta_filter_strict",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS modified
    FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'
    """,
)
def delta_filter_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "orders").select("o_orderkey", iso(F.col("o_orderdate")).alias("modified"))
    return delta_filter(texts, "modified", SINCE, inclusive=False)


@workload("row_count", "SELECT count(*) AS row_count FROM lineitem")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.row_count(table(spark, sf_dir, "lineitem"))


@workload(
    "new_watermark",
    """
    SELECT greatest(TIMESTAMP '1998-01-01',
                    max(o_orderdate) FILTER (WHERE o_orderstatus <> 'P')) AS new_watermark
    FROM orders
    """,
)
def new_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = iso(F.col("o_orderdate"))
    status = F.col("o_orderstatus")
    batch = table(spark, sf_dir, "orders").select(
        F.when(status == "O", stamp).when(status == "F", "").otherwise("unknown").alias("lastmodifieddate"),
        F.when(status == "F", stamp).alias("hs_lastmodifieddate"),
    )
    return _ntz(M.new_watermark(batch, SINCE, "lastmodifieddate", "hs_lastmodifieddate"), "new_watermark")


@workload(
    "run_totals",
    """
    SELECT o_orderstatus AS module, count(*) AS total_records FROM orders GROUP BY 1
    UNION ALL SELECT NULL, count(*) FROM orders
    """,
)
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("module")).agg(
        F.count(F.lit(1)).alias("records")
    )
    return Q.run_totals(counts)


@workload(
    "get_watermark",
    _MARKS
    + """
    SELECT 'stored' AS kind, max(last_synced_at) - INTERVAL 15 MINUTE AS since
    FROM marks WHERE source = 'click' AND module = '7'
    UNION ALL SELECT 'first run', TIMESTAMP '2024-06-01 12:00:00' - INTERVAL 3650 DAY
    """,
)
def get_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = stored_marks(spark, sf_dir)
    stored = M.get_watermark(marks, "click", "7", RUN).withColumn("kind", F.lit("stored"))
    first = M.get_watermark(marks, "click", "nobody", RUN).withColumn("kind", F.lit("first run"))
    return _ntz(stored.unionByName(first).drop("stored"), "since")


@workload(
    "set_watermark",
    _MARKS
    + """
    SELECT * FROM marks WHERE NOT (source = 'click' AND module IN ('7', '8'))
    UNION ALL SELECT 'click', '7', TIMESTAMP '2024-06-01 11:00:00', TIMESTAMP '2024-06-01 12:00:00'
    UNION ALL SELECT 'click', '8', coalesce(max(last_synced_at), TIMESTAMP '2000-01-01'), TIMESTAMP '2024-06-01 12:00:00'
              FROM marks WHERE source = 'click' AND module = '8'
    UNION ALL SELECT 'click', 'new', TIMESTAMP '2024-06-01 11:00:00', TIMESTAMP '2024-06-01 12:00:00'
    """,
)
def set_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One mark advanced, one that must not go back, one that is new."""
    marks = stored_marks(spark, sf_dir)
    seen = utc("2024-06-01T11:00:00")
    for module, value in (("7", seen), ("8", utc("2000-01-01T00:00:00")), ("new", seen)):
        marks = materialize(M.set_watermark(marks, "click", module, value, RUN), scratch(spark, "marks"))
    return _ntz(marks, "last_synced_at", "updated_at")


@workload("reset_watermark", _MARKS + "SELECT * FROM marks WHERE module <> '7'")
def reset_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(M.reset_watermark(stored_marks(spark, sf_dir), "7"), "last_synced_at", "updated_at")


@workload(
    "watermark_policy",
    """
    WITH s AS (
      SELECT user_id, max(ts) FILTER (WHERE event_type = 'click') AS stored,
             max(ts) FILTER (WHERE event_type = 'view') AS observed,
             count(*) FILTER (WHERE event_type = 'view') AS n
      FROM events GROUP BY 1)
    SELECT user_id,
           CASE WHEN n > 0 AND observed > stored THEN observed ELSE stored END AS held,
           CASE WHEN n > 0 AND observed > stored THEN observed
                ELSE TIMESTAMP '2024-06-01 12:00:00' END AS moved
    FROM s WHERE stored IS NOT NULL
    """,
)
def watermark_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts, kind = F.col("ts").cast("timestamp"), F.col("event_type")
    state = (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(
            F.max(F.when(kind == "click", ts)).alias("stored"),
            F.max(F.when(kind == "view", ts)).alias("observed"),
            F.count(F.when(kind == "view", ts)).alias("n"),
        )
        .filter(F.col("stored").isNotNull())
    )
    run = F.lit("2024-06-01 12:00:00Z").cast("timestamp")
    inputs = (F.col("stored"), F.col("observed"), F.col("n"), run)
    return _ntz(
        state.select(
            "user_id", M.advance(*inputs).alias("held"), M.advance(*inputs, policy="now").alias("moved")
        ),
        "held",
        "moved",
    )


@workload(
    "overlap_replay",
    """
    SELECT user_id, event_id, ts, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1
    """,
)
def overlap_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs whose deltas overlap: the rows read twice change nothing."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "value")
    order = [F.col("ts"), F.col("event_id")]
    mark = as_utc(utc("2024-01-10T00:00:00"))
    early = events.filter(F.col("ts") <= F.lit("2024-01-10").cast("timestamp_ntz"))
    target = upsert(None, early, ["user_id"], order)
    replayed = delta_filter(events, "ts", mark - M.OVERLAP)
    once = materialize(upsert(target, replayed, ["user_id"], order), scratch(spark, "replay"))
    again = delta_filter(events, "ts", mark + timedelta(days=1) - M.OVERLAP)
    return upsert(once, again, ["user_id"], order)


# Report orderings


@workload("sort_modified", "SELECT * FROM orders ORDER BY o_orderdate, o_orderkey")
def sort_modified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").orderBy("o_orderdate", "o_orderkey")


def run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as run-log rows."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"),
        F.col("user_id").alias("records_processed"),
        F.col("value").alias("duration_seconds"),
        F.col("ts").alias("started_at"),
    )


@workload(
    "recent_runs",
    """
    SELECT event_type AS source, CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
           user_id AS records_processed, value AS duration_seconds, ts AS started_at
    FROM events ORDER BY ts DESC LIMIT 20
    """,
)
def recent_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_records(spark, sf_dir).orderBy(F.col("started_at").desc()).limit(20)


@workload("watermark_state", _MARKS + "SELECT * FROM marks ORDER BY source, module")
def watermark_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(stored_marks(spark, sf_dir), "last_synced_at", "updated_at").orderBy("source", "module")


# Checks


@workload(
    "check_min_rows",
    """
    SELECT 'orders' AS table_name, count(*) AS actual, 1::BIGINT AS expected_min, count(*) >= 1 AS healthy FROM orders
    UNION ALL
    SELECT 'region', count(*), 1000, count(*) >= 1000 FROM region
    """,
)
def check_min_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.check_min_rows(table(spark, sf_dir, "orders"), "orders", 1).unionByName(
        Q.check_min_rows(table(spark, sf_dir, "region"), "region", 1000)
    )


@workload(
    "check_columns",
    """
    SELECT 'o_orderkey' AS column_name, true AS present, count(o_orderkey) AS filled, count(*) AS rows FROM orders
    UNION ALL SELECT 'bidding', false, 0, count(*) FROM orders
    """,
)
def check_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.check_columns(table(spark, sf_dir, "orders"), ["o_orderkey", "bidding"])


@workload(
    "check_loaded",
    "SELECT count(*) AS expected, count(*) AS loaded, true AS complete FROM lineitem",
)
def check_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return Q.check_loaded(materialize(lines, scratch(spark, "loaded")), lines)


@workload(
    "run_log",
    """
    SELECT 'crm' AS source, 'SUCCESS' AS status, count(*) AS records_processed, 0::BIGINT AS api_calls,
           90.5::DOUBLE AS duration_seconds, '' AS error_message, TIMESTAMP '2024-06-01 12:00:00' AS started_at,
           TIMESTAMP '2024-06-01 12:01:30.5' AS finished_at
    FROM orders
    """,
)
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table(spark, sf_dir, "orders").count()
    end = RUN + timedelta(seconds=90.5)
    path = scratch(spark, "run-log")
    Q.run_log_row(spark, "crm", "SUCCESS", records, RUN, end).write.mode("append").parquet(path)
    return _ntz(spark.read.parquet(path), "started_at", "finished_at")
