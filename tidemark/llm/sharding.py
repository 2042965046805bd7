"""Shards of near equal size by longest-processing-time scheduling.

Rows with equal text form a group. Groups in descending size go to the least-loaded
shard, which a heap yields. Groups of one size are alike, so the schedule is made for
the counts per size, whose number is bounded whatever the input; the rows get their
shard and slot by joins and windows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.columns import hidden, text_of
from tidemark.session import stage_in

SHARDS = 16
#: Sizes below 2**EXACT are kept apart, and so is every group above a LARGEth of a shard's
#: even share: there are at most SHARDS * LARGE of these, whatever the input. Sizes between
#: share a class if their first DIGITS bits agree, so there are at most 2**EXACT + 64 *
#: 2**DIGITS classes more, and sizes in one differ by at most a 2**(1 - DIGITS)th: where the
#: schedule takes one for another, a shard's size differs by no more than that part of a
#: LARGEth of its share.
EXACT, DIGITS, LARGE = 16, 12, 10_000
#: Parts in which the rows of one class or shard are numbered, so none is held by one task.
PARTS = 512


def size_class(size: Column) -> Column:
    """The size itself, or rounded down to its first DIGITS bits."""
    bits = F.floor(F.log2(size.cast("double"))).cast("int") - (DIGITS - 1)
    rounded = F.call_function("shiftleft", F.call_function("shiftright", size, bits), bits)
    return F.when(size < (1 << EXACT), size).otherwise(rounded)


def schedule(counts: Iterable[tuple[int, int, int]], shards: int) -> list[tuple[int, list[int]]]:
    """For every class (class, groups, bytes of all), largest first: how many go to each shard.

    All groups of a class count as its mean size. The heap yields the least-loaded shard
    for each; of a class with many groups it yields the last few, as the smallest of all
    loads that the shards pass through are known to be taken before.
    """
    heap = [(0.0, s) for s in range(shards)]
    out = []
    for size, groups, total in sorted(counts, reverse=True):
        mean, dealt = total / groups, [0] * shards
        if groups > 4 * shards:
            dealt = _taken_before(dict((s, load) for load, s in heap), mean, groups)
            heap = [(load + mean * dealt[s], s) for load, s in heap]
            heapq.heapify(heap)
        for _ in range(groups - sum(dealt)):
            load, s = heapq.heappop(heap)
            dealt[s] += 1
            heapq.heappush(heap, (load + mean, s))
        out.append((size, dealt))
    return out


def _taken_before(loads: dict[int, float], mean: float, groups: int) -> list[int]:
    """How many of ``groups`` alike each shard has got when at most one for each shard is left."""
    low, high = min(loads.values()), max(loads.values()) + mean * groups
    while high - low > mean / 4:
        level = (low + high) / 2
        if sum(max(0, int((level - load) / mean)) for load in loads.values()) <= groups:
            low = level
        else:
            high = level
    return [max(0, int((low - loads[s]) / mean)) for s in sorted(loads)]


def numbered(df: DataFrame, by: str, key: Column, to: str, stage) -> DataFrame:
    """``df`` with ``to``: 0, 1, ... within each value of ``by``, gapless.

    The rows of a value are numbered in parts chosen by ``key``'s hash; the counts of
    the parts before give each part its first number. ``df`` must be a written table.
    """
    part, first = hidden(df, "part"), hidden(df, "first")
    dealt = df.withColumn(part, F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int"))
    counts = dealt.groupBy(by, part).count()
    before = Window.partitionBy(by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(by, part, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(first))
    own = Window.partitionBy(by, part).orderBy(key)
    out = dealt.join(counts, [by, part]).withColumn(to, F.col(first) + F.row_number().over(own) - 1)
    return out.drop(part, first)


def sharded(spark: SparkSession, rows: DataFrame, size: str, group: str, shards: int = SHARDS) -> DataFrame:
    """``rows`` with shard and slot: sizes of the shards near equal, equal ``group`` values together.

    ``size`` is a positive long column; rows whose ``group`` is null are one group; columns
    named shard and slot are replaced. Rows of a shard are numbered from 0 without gaps; equal
    rows get numbers of their own. With an empty table nothing is assigned. A group
    larger than an even share makes its shard the largest, as it must stay together.
    """
    stage = stage_in(spark, "shards")
    at, g, n, c = (hidden(rows, x) for x in ("at", "group", "size", "class"))
    held = stage(
        rows.drop("shard", "slot").withColumns(
            {at: F.monotonically_increasing_id(), g: F.struct(F.col(group)), n: F.col(size).cast("long")}
        )
    )
    groups = stage(held.groupBy(g).agg(F.sum(n).alias(n)))
    total = groups.agg(F.sum(n)).first()[0] or 0
    large = F.col(n) >= max(1, total // (shards * LARGE))
    groups = groups.withColumn(c, F.when(large, F.col(n)).otherwise(size_class(F.col(n))))
    counts = [tuple(x) for x in groups.groupBy(c).agg(F.count("*"), F.sum(n)).toLocalIterator()]
    plan = [(size, ends) for size, dealt in schedule(counts, shards) for ends in [_ends(dealt)]]
    planned = spark.createDataFrame(plan, f"`{c}` long, ends array<long>")
    index = hidden(groups, "index")
    placed = numbered(groups, c, F.col(g), index, stage).join(planned, c)
    shard = F.size(F.filter("ends", lambda e: e <= F.col(index)))
    placed = placed.select(g, shard.alias("shard"))
    assigned = stage(held.join(placed, g))
    return numbered(assigned, "shard", F.col(at), "slot", stage).drop(at, g, n)


def _ends(dealt: list[int]) -> list[int]:
    """Where each shard's run of a class's groups ends."""
    out, total = [], 0
    for n in dealt:
        total += n
        out.append(total)
    return out


def document_rows(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with size (UTF-8 bytes plus 1), text_crc32 and text_group, the text's digest; null is empty."""
    body = text_of(text)
    return docs.withColumns(
        {
            "size": F.octet_length(body).cast("long") + 1,
            "text_crc32": F.crc32(body.cast("binary")),
            "text_group": F.unhex(F.md5(body)),
        }
    )
