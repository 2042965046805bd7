"""Keyed upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.filters import keyed
from tidemark.operators.normalize import quoted
from tidemark.operators.ranking import latest_per_key
from tidemark.operators.union import align_types


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the last in the given ascending order of columns, nulls first."""
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    return latest_per_key(df, keys, [c.desc_nulls_last() for c in columns])


def dedupe_keep_last(
    older: DataFrame, newer: DataFrame, keys: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """Concatenate two tables and keep the last row of each key; the newer table wins."""
    older, newer = align_types(older, newer)
    both = older.withColumn("__source", F.lit(0)).unionByName(
        newer.withColumn("__source", F.lit(1)), allowMissingColumns=True
    )
    return keep_last(both, keys, [F.col("__source"), *order]).drop("__source")


def upsert(
    target: DataFrame | None,
    delta: DataFrame,
    keys: Sequence[str] = ("id",),
    order: Sequence[Column | str] = (),
    *,
    dedupe_target: bool = False,
) -> DataFrame:
    """Target rows whose key is not in the delta, plus the last delta row of each key.

    Rows are replaced whole. Delta rows without a key are left out (the caller counts
    them). The target holds each key once, so it is only filtered: it is neither
    sorted nor, while the delta's keys stay below the broadcast threshold, shuffled.
    ``order`` says which of several delta rows of one key is last; ties, and a delta
    without an order, are settled by the row's hash so that a retry chooses alike.
    ``dedupe_target`` is for a table others have written.
    """
    keys = list(keys)
    delta = keyed(delta, keys)
    order = [*order, F.xxhash64(*[quoted(c) for c in delta.columns])]
    if target is None:
        return keep_last(delta, keys, order)
    target, delta = align_types(target, delta)
    if dedupe_target:
        target = keep_last(target, keys, [F.xxhash64(*[quoted(c) for c in target.columns])])
    replaced = delta.select(*keys).distinct()
    return target.join(replaced, keys, "left_anti").unionByName(
        keep_last(delta, keys, order), allowMissingColumns=True
    )


def upsert_newest(
    target: DataFrame | None,
    delta: DataFrame,
    keys: Sequence[str] = ("id",),
    order: Sequence[Column | str] = (),
) -> DataFrame:
    """Upsert for rows that may come late: a key's row in the target takes part in the
    choice, so an older delta row does not replace it."""
    if target is None:
        return upsert(None, delta, keys, order)
    rivals = target.join(delta.select(*keys).distinct(), list(keys), "left_semi")
    rivals, delta = align_types(rivals, delta)
    return upsert(target, rivals.unionByName(delta, allowMissingColumns=True), keys, order)
