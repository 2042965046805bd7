"""Load checks and run records; each check is a one-row DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.times import as_utc, elapsed_seconds, offset_time, time_literal

RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("records_processed", T.LongType()),
        T.StructField("api_calls", T.LongType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
    ]
)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def check_min_rows(df: DataFrame, table: str, expected_min: int) -> DataFrame:
    """Is the table at least as long as expected? Reported, never raised."""
    return df.agg(F.count(F.lit(1)).alias("actual")).select(
        F.lit(table).alias("table_name"),
        "actual",
        F.lit(expected_min).cast("bigint").alias("expected_min"),
        (F.col("actual") >= expected_min).alias("healthy"),
    )


def check_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row per required column: is it there, and how many rows have a value?"""
    present = [c for c in required if c in df.columns]
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(F.col(f"`{c}`")).alias(f"has_{c}") for c in present]
    )
    checks = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(c in present).alias("present"),
                (F.col(f"has_{c}") if c in present else F.lit(0).cast("bigint")).alias("filled"),
                F.col("rows"),
            )
            for c in required
        ]
    )
    return counts.select(F.inline(checks))


def check_loaded(written: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows meant to be written against rows found in the written table."""
    want = expected.agg(F.count(F.lit(1)).alias("expected"))
    return written.agg(F.count(F.lit(1)).alias("loaded")).select(
        want.scalar().alias("expected"), "loaded", (F.col("loaded") == want.scalar()).alias("complete")
    )


def run_totals(counts: DataFrame, by: str = "module") -> DataFrame:
    """Records per module and over the whole run (module null)."""
    return counts.rollup(by).agg(F.sum("records").alias("total_records"))


def run_log_row(
    spark: SparkSession,
    source: str,
    status: str,
    records: int,
    started_at: datetime,
    finished_at: datetime,
    *,
    error: str = "",
    api_calls: int = 0,
) -> DataFrame:
    """The typed run record."""
    instant = T.TimestampType()
    start, end = time_literal(started_at, instant), time_literal(finished_at, instant)
    return spark.range(1).select(
        F.lit(source).alias("source"),
        F.lit(status).alias("status"),
        F.lit(records).cast("bigint").alias("records_processed"),
        F.lit(api_calls).cast("bigint").alias("api_calls"),
        elapsed_seconds(start, end).alias("duration_seconds"),
        F.lit(error).alias("error_message"),
        start.alias("started_at"),
        end.alias("finished_at"),
    )


def full_refresh_log_row(
    spark: SparkSession,
    status: str,
    records: int,
    started_at: datetime,
    finished_at: datetime,
    *,
    error: str = "",
    api_calls: int = 0,
) -> DataFrame:
    """The run record of the full refresh; the start time at the fixed local offset."""
    seconds = (as_utc(finished_at) - as_utc(started_at)).total_seconds()
    start = time_literal(started_at, T.TimestampType())
    return spark.range(1).select(
        offset_time(start).alias("timestamp"),
        F.lit(seconds).alias("duration_seconds"),
        F.lit(status).alias("status"),
        F.lit(api_calls).cast("bigint").alias("api_calls"),
        F.lit(records).cast("bigint").alias("total_records_processed"),
        F.lit(error).alias("error_message"),
    )
