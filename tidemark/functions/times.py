"""Time forms. The session time zone is expected to be UTC."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F, types as T

# Accepted ISO-8601 text, and the fixed local offset of the run log.
ISO_8601 = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
LOCAL_OFFSET_MINUTES = 330


def parse_iso_ts(text: Column) -> Column:
    """Instant of ISO-8601 text; anything else is null. No zone means UTC."""
    seconds = F.regexp_replace(text, r"^(.{10}[T ]\d{2}:\d{2})(Z|[+-].*)?$", "$1:00$2")
    colon = F.regexp_replace(seconds, r"(:\d{2}(?:\.\d+)?[+-]\d{2})(\d{2})$", "$1:$2")
    zoned = (
        F.when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00Z")))
        .when(colon.rlike(r":\d{2}(\.\d+)?(Z|[+-]\d{2}(:\d{2})?)$"), colon)
        .otherwise(F.concat(colon, F.lit("Z")))
    )
    return F.when(text.rlike(ISO_8601), F.try_to_timestamp(zoned))


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def rfc1123(ts: Column) -> Column:
    """``Sat, 01 Jun 2024 12:00:00 +0000`` of a UTC time."""
    text = F.date_format(ts.cast("timestamp"), "EEE, dd MMM yyyy HH:mm:ss")
    return F.concat(text, F.lit(" +0000"))


def offset_time(ts: Column, minutes: int = LOCAL_OFFSET_MINUTES) -> Column:
    """Wall clock text at a fixed offset from UTC."""
    shifted = ts.cast("timestamp") + F.make_dt_interval(mins=F.lit(minutes))
    return F.date_format(shifted, "yyyy-MM-dd HH:mm:ss")


def elapsed_seconds(start: Column, end: Column) -> Column:
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(1e6)


def as_utc(value: datetime) -> datetime:
    """Aware UTC datetime; a naive value is taken as UTC."""
    if value.tzinfo is None:
        return value.replace(tzinfo=timezone.utc)
    return value.astimezone(timezone.utc)


def time_literal(value: datetime, dtype: T.DataType) -> Column:
    """Literal of the column's own type, so that a comparison reaches the scan."""
    text = as_utc(value).replace(tzinfo=None).isoformat(sep=" ", timespec="microseconds")
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    if isinstance(dtype, T.TimestampType):
        return F.lit(text + "Z").cast("timestamp")
    raise TypeError(f"not a time column: {dtype.simpleString()}")


def event_time(c: Column, dtype: T.DataType) -> Column:
    """The instant a column states: typed columns as they are, text parsed."""
    return parse_iso_ts(c) if isinstance(dtype, T.StringType) else c.cast("timestamp")
