"""High-water marks."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.times import as_utc, event_time, time_literal

# The reach of a first run and the overlap of later ones.
INITIAL_LOOKBACK = timedelta(days=3650)
OVERLAP = timedelta(minutes=15)

# The time a first run without a lookback reads from.
BEGINNING = datetime(1900, 1, 1, tzinfo=timezone.utc)

WATERMARK_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType(), False),
        T.StructField("module", T.StringType(), False),
        T.StructField("last_synced_at", T.TimestampType(), False),
        T.StructField("updated_at", T.TimestampType(), False),
    ]
)


def _instant(value: datetime) -> Column:
    return time_literal(value, T.TimestampType())


def _mine(source: str, module: str) -> Column:
    return (F.col("source") == source) & (F.col("module") == module)


def point_lookup(marks: DataFrame, source: str, module: str) -> DataFrame:
    return marks.filter(_mine(source, module)).limit(1)


def get_watermark(
    marks: DataFrame,
    source: str,
    module: str,
    run_ts: datetime,
    *,
    overlap: timedelta = OVERLAP,
    lookback: timedelta | None = INITIAL_LOOKBACK,
) -> DataFrame:
    """One row: the stored mark, null before the first run, and the time to read from,
    which is the mark less the overlap, else the reach of a first run. Without a
    ``lookback`` a first run reads everything."""
    stored = marks.filter(_mine(source, module)).agg(F.max("last_synced_at").alias("stored"))
    reach = F.make_dt_interval(secs=F.lit(overlap.total_seconds()))
    first = _instant(BEGINNING if lookback is None else as_utc(run_ts) - lookback)
    return stored.select("stored", F.coalesce(F.col("stored") - reach, first).alias("since"))


def set_watermark(
    marks: DataFrame, source: str, module: str, value: datetime, run_ts: datetime
) -> DataFrame:
    """The watermark table with one mark put to ``value``, but never moved back.

    The key is a constant, so the upsert is a filter and a union, without a join.
    """
    mine = _mine(source, module)
    row = marks.filter(mine).agg(F.max("last_synced_at").alias("stored")).select(
        F.lit(source).alias("source"),
        F.lit(module).alias("module"),
        F.greatest(_instant(value), F.col("stored")).alias("last_synced_at"),
        _instant(run_ts).alias("updated_at"),
    )
    return marks.filter(~mine).unionByName(row)


def reset_watermark(marks: DataFrame, module: str, source: str | None = None) -> DataFrame:
    """The table without a module's mark: its next run reads the whole lookback again."""
    dropped = F.col("module") == module
    if source is not None:
        dropped = dropped & (F.col("source") == source)
    return marks.filter(~dropped)


def modified_time(df: DataFrame, *columns: str) -> Column:
    """Per row the time in the first given column with text; unreadable text is null."""
    times = []
    for name in columns:
        dtype = df.schema[name].dataType
        column = F.col(name)
        times.append(F.nullif(column, F.lit("")) if isinstance(dtype, T.StringType) else column)
    return event_time(F.coalesce(*times), df.schema[columns[0]].dataType)


def observed_watermark(df: DataFrame, *columns: str) -> Column:
    """Aggregate: the newest time in a batch; unreadable text is ignored."""
    return F.max(modified_time(df, *columns))


def new_watermark(df: DataFrame, start: datetime, *columns: str) -> DataFrame:
    """One row: the newest time in a batch, but never less than ``start``."""
    return df.agg(F.greatest(_instant(start), observed_watermark(df, *columns)).alias("new_watermark"))


def advance(
    stored: Column, observed: Column, rows: Column, run_ts: Column, policy: str = "hold"
) -> Column:
    """The next mark. ``hold`` keeps the stored one when a batch brings nothing newer;
    ``now`` moves it to the run time. No policy moves it back."""
    newer = (rows > 0) & F.coalesce(observed > stored, observed.isNotNull())
    idle = {"hold": stored, "now": F.greatest(stored, run_ts)}[policy]
    return F.when(newer, observed).otherwise(idle)
