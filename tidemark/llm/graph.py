"""Links between members of shared buckets, and the components they form.

All of it is DataFrame work on written tables: no list of links or components
reaches the driver, and no group is emitted as all of its pairs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Stage = Callable[[DataFrame], DataFrame]
#: Makes a node's set, an array of distinct values, from its items.
Sets = Callable[[Column], Column]

#: Masks under which the smallest member of a bucket differs (fixed values).
CENTRES = (0x5851F42D4C957F2D, 0x14057B7EF767814F, 0x2545F4914F6CDD1D, 0x369DEA0F31A53F85)


def masked(node: Column, bucket: Column) -> Column:
    """``node`` under one of the masks, chosen by the bucket; applied twice it is ``node``."""
    mask = F.element_at(F.array(*[F.lit(c) for c in CENTRES]), (F.pmod(bucket, F.lit(len(CENTRES))) + 1).cast("int"))
    return node.bitwiseXOR(mask)


def shared_buckets(buckets: DataFrame) -> DataFrame:
    """The rows (bucket, node) of buckets with two nodes or more, with a centre for each bucket.

    The centre comes from an aggregate that is reduced before the shuffle, so a
    bucket that holds a third of all nodes is not gathered anywhere.
    """
    key = masked(F.col("node"), F.col("bucket"))
    centres = (
        buckets.groupBy("bucket")
        .agg(F.min(key).alias("low"), F.max(key).alias("high"))
        .where("low != high")
        .select("bucket", masked(F.col("low"), F.col("bucket")).alias("centre"))
    )
    return buckets.join(centres, "bucket")


def pairs(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def star_pairs(members: DataFrame) -> DataFrame:
    """Each member beside the centre of its bucket, every pair once."""
    return members.where("node != centre").select(*pairs(F.col("node"), F.col("centre"))).distinct()


def similar(left: str, right: str, percent: int) -> Column:
    """Whether 100 |L n R| >= percent |L u R| for two arrays of distinct values."""
    n, m = F.size(left), F.size(right)
    both = F.size(F.array_intersect(left, right))
    near = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    return near & (both * (100 + percent) >= (n + m) * percent)


def confirmed(candidates: DataFrame, items: DataFrame, percent: int, sets: Sets | None = None) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough. ``items``: (node, items)."""
    left = items.select(F.col("node").alias("a"), F.col("items").alias("left"))
    right = items.select(F.col("node").alias("b"), F.col("items").alias("right"))
    both = candidates.join(left, "a").join(right, "b")
    if sets:
        # Made once a pair: what depends on the partition's number is not moved into a condition.
        both = both.withColumns({c: F.when(F.spark_partition_id() >= 0, sets(F.col(c))) for c in ("left", "right")})
    return both.where(similar("left", "right", percent)).select("a", "b")


def components(links: DataFrame, stage: Stage) -> DataFrame:
    """(node, comp) for every node of ``links`` (a, b): the smallest node it is connected with.

    Alternates two star contractions (each node's larger neighbours, then its
    smaller ones, are tied to its smallest neighbour) until only stars are left: no node
    has two smaller neighbours, or smaller and larger ones; a star's centre is its smallest.
    """
    edges = stage(links.where("a != b").select(*pairs(F.col("a"), F.col("b"))).distinct())
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("n"), "low").where("n != low").distinct()
        # Now n > low: the smaller neighbours of n meet at the least of them.
        least = large.groupBy("n").agg(F.min("low").alias("least"))
        met = large.join(least, "n").select("n", "low", "least")
        small = met.select(F.col("least").alias("a"), F.col("n").alias("b")).unionByName(
            met.select(F.col("least").alias("a"), F.col("low").alias("b"))
        )
        edges = stage(small.where("a != b").distinct())
    leaves = edges.select(F.col("b").alias("node"), F.col("a").alias("comp"))
    return stage(leaves.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("comp")).distinct()))


def _stars(edges: DataFrame) -> bool:
    """Is each node the larger one of one edge, or the smaller one of any number?"""
    ends = edges.select(F.col("b").alias("node"), F.lit(1).alias("under"), F.lit(0).alias("over")).unionByName(
        edges.select(F.col("a").alias("node"), F.lit(0).alias("under"), F.lit(1).alias("over"))
    )
    others = ends.groupBy("node").agg(F.sum("under").alias("under"), F.max("over").alias("over"))
    return others.where("under > 1 or (under > 0 and over > 0)").isEmpty()


def rest_links(
    members: DataFrame, comps: DataFrame, items: DataFrame, percent: int, stage: Stage, sets: Sets | None = None
) -> DataFrame | None:
    """Links between members of one bucket that lie in different components so far.

    In each bucket whose members are not yet one component, the members outside its
    most frequent component are compared with all others. The comparison is the
    condition of a join, so only links leave it; a large bucket is cut by the join
    like any skewed key. With it, every pair that shares a bucket is either
    connected already or compared. It suits members of which few are alike once the
    first links have joined them; see :func:`dense_rest_links` for others.
    """
    known = members.select("bucket", "node").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    open_buckets = known.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("n"))
    open_buckets = open_buckets.where("x != y and n > 2").select("bucket")
    held = stage(known.join(open_buckets, "bucket"))
    if held.isEmpty():
        return None
    counts = held.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
    main = counts.groupBy("bucket").agg(F.max(F.struct("n", "comp")).alias("most"))
    main = main.select("bucket", F.col("most.comp").alias("main"))
    if sets:
        items = items.join(held.select("node").distinct(), "node", "left_semi").select("node", sets(F.col("items")).alias("items"))
    wide = held.join(main, "bucket").join(items, "node")
    rest = wide.where("comp != main").select("bucket", F.col("comp").alias("a"), F.col("items").alias("left"))
    every = wide.select("bucket", F.col("comp").alias("b"), (F.col("comp") == F.col("main")).alias("in_main"), F.col("items").alias("right"))
    unlike = (F.col("a") != F.col("b")) & (F.col("in_main") | (F.col("a") < F.col("b")))
    found = rest.join(every, "bucket").where(unlike & similar("left", "right", percent))
    return found.select(*pairs(F.col("a"), F.col("b"))).distinct()


def _open(members: DataFrame, comps: DataFrame) -> DataFrame:
    """(bucket, node, comp) of buckets whose members, their centre aside, are not all of one component."""
    held = members.where("node != centre").select("bucket", "node").join(comps, "node", "left")
    held = held.withColumn("comp", F.coalesce("comp", "node"))
    ends = held.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y"))
    return held.join(ends.where("x != y").select("bucket"), "bucket")


def _beside(rows: DataFrame, having: DataFrame, **names: str) -> DataFrame:
    """Rows with the sets of their nodes, and columns renamed."""
    return rows.join(having, "node").withColumnsRenamed(names)


def dense_rest_links(
    members: DataFrame, comps: DataFrame, items: DataFrame, percent: int, stage: Stage, sets: Sets | None = None
) -> DataFrame | None:
    """Links (a, b) between components of which members share a bucket; None if none is to be compared.

    All members were compared with their bucket's centre before. In a bucket whose members
    are not of one component, those outside the largest one are compared with that, up to the
    first hit. Those without a hit are compared with those that had one, up to the first
    hit, too, and with each other; only links leave that join. So each pair that shares a
    bucket is connected or compared, while a member that is like many others of the largest
    component, or of those connected with it, yields one row; a bucket of many unlike ones
    costs their comparisons.
    """
    held = stage(_open(members, comps))
    if held.isEmpty():
        return None
    items = items.join(held.select("node").distinct(), "node", "left_semi")
    if sets:
        items = items.select("node", sets(F.col("items")).alias("items"))
    alike = (F.col("bucket") == F.col("at")) & similar("left", "right", percent)

    counts = held.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
    largest = counts.groupBy("bucket").agg(F.max(F.struct("n", "comp")).alias("most"))
    wide = held.join(largest.select("bucket", F.col("most.comp").alias("main")), "bucket")
    rest = _beside(wide.where("comp != main"), items, items="left")
    main = _beside(wide.where("comp = main").select("bucket", "node"), items, bucket="at", items="right").select("at", "right")
    hit = rest.join(main, alike, "left_semi").select("bucket", "node", F.lit(True).alias("hit"))
    met = stage(wide.where("comp != main").join(hit, ["bucket", "node"], "left"))

    alone = _beside(met.where("hit is null"), items, items="left")
    ring = _beside(met.where("hit").select("bucket", "node"), items, bucket="at", items="right").select("at", "right")
    second = alone.join(ring, alike, "left_semi").select(*pairs(F.col("comp"), F.col("main")))
    others = _beside(met.where("hit is null").select("bucket", "node", "comp"), items, bucket="at", node="b", comp="other", items="right")
    unlike = (F.col("node") < F.col("b")) & (F.col("comp") != F.col("other"))
    last = alone.join(others, alike & unlike).select(*pairs(F.col("comp"), F.col("other")))
    first = met.where("hit").select(*pairs(F.col("comp"), F.col("main")))
    return first.unionByName(second).unionByName(last).distinct()


def linked_components(
    members: DataFrame,
    candidates: DataFrame,
    items: DataFrame,
    percent: int,
    stage: Stage,
    sets: Sets | None = None,
    rest_of: Callable[..., DataFrame | None] = rest_links,
) -> DataFrame:
    """(node, comp) over all links between nodes that share a bucket.

    First the centre of each bucket is compared with its members (``candidates``),
    then what these links have not joined is compared within its buckets by ``rest_of``.
    ``sets``, if given, makes the set of a node from its ``items``.
    """
    first = components(confirmed(candidates, items, percent, sets), stage)
    rest = rest_of(members, first, items, percent, stage, sets)
    if rest is None:
        return first
    second = components(rest, stage).select(F.col("node").alias("comp"), F.col("comp").alias("root"))
    joined = first.join(second, "comp", "left").select("node", F.coalesce("root", "comp").alias("comp"))
    alone = second.select(F.col("comp").alias("node"), F.col("root").alias("comp")).join(first, "node", "left_anti")
    return joined.unionByName(alone)
