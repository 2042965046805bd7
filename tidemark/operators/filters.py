"""Delta, orphan and completeness predicates."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.text import any_of
from tidemark.functions.times import event_time, time_literal
from tidemark.operators.watermark import modified_time


def delta_filter(
    df: DataFrame, modified: str, since: datetime, *, inclusive: bool = True
) -> DataFrame:
    """Rows modified at or after (strictly after) a watermark.

    A typed column is compared with a literal of its own type and so filters inside
    the scan; a text column has to be parsed first.
    """
    dtype = df.schema[modified].dataType
    if isinstance(dtype, (T.StringType, T.DateType)):
        column, bound = event_time(F.col(modified), dtype), time_literal(since, T.TimestampType())
    else:
        column, bound = F.col(modified), time_literal(since, dtype)
    return df.filter(column >= bound if inclusive else column > bound)


def changed_since(df: DataFrame, modified: Sequence[str], since: datetime) -> DataFrame:
    """Rows modified at or after a time by the first of several columns that a row fills,
    and rows that state no readable time: none of them may be lost."""
    known = [c for c in modified if c in df.columns]
    if not known:
        return df
    stamp = modified_time(df, *known)
    return df.filter(stamp.isNull() | (stamp >= time_literal(since, T.TimestampType())))


def missing_parent(parent: Column) -> Column:
    return F.coalesce(parent.cast("string"), F.lit("")) == ""


def orphans(df: DataFrame, parent: str) -> DataFrame:
    """Rows whose parent link is null or empty."""
    return df.filter(missing_parent(F.col(parent)))


def orphans_of(df: DataFrame, parent: str, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose parent link is missing or names no row of the parent table."""
    known = parents.select(F.col(key).alias(parent)).distinct()
    return df.join(known, parent, "left_anti")


def keyed(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is complete."""
    return df.filter(~null_key(keys))


def null_key(keys: list[str]) -> Column:
    return any_of([F.col(k).isNull() for k in keys])


def active_history(kind: Column) -> Column:
    """False for a logged state that says the key is gone."""
    text = F.coalesce(kind, F.lit(""))
    return (text != "Delete") & ~text.startswith("Deleted")
