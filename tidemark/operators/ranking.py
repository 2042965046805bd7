"""Row choice and row numbers that hold up under hot keys."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "__rank"
_RANGE = "__range"
_BEFORE = "__before"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    The rank filter makes Spark keep one row per key in every map task before the
    shuffle, so a key that holds a third of the rows costs one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def spread_row_number(
    df: DataFrame, group: str, key: str, name: str, stage: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Number the rows 1..n within each group in the order of ``key``, without one task
    sorting a huge group.

    The rows are dealt by ranges of (group, key), whose bounds Spark draws from a sample,
    so a group of any size lies in as many neighbouring ranges as it needs. Each range
    numbers its own rows, and the group's counts in the ranges before, a small table,
    shift the numbers. ``stage`` writes the dealt rows once, so that their range is the
    same wherever it is read. Rows with equal group and key get numbers in any order.
    ``group`` is one never-null column; a struct serves for several.
    """
    dealt = stage(df.repartitionByRange(group, key).withColumn(_RANGE, F.spark_partition_id()))
    counts = dealt.groupBy(group, _RANGE).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(group).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(group, _RANGE, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(_BEFORE))
    within = Window.partitionBy(group, _RANGE).orderBy(key)
    ranked = dealt.join(shifts, [group, _RANGE]).withColumn(name, F.col(_BEFORE) + F.row_number().over(within))
    return ranked.select(*df.columns, name)
