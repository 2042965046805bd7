from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tidemark.llm import queries, sharding

SF = "/root/testdata/sf0.001"


def check(rows, shards=16):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(shards))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_query(spark):
    rows = queries.op4_sharding(spark, SF).collect()
    check(rows)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
    shard_of = defaultdict(set)
    load = Counter()
    for r in rows:
        shard_of[texts[r.doc_id]].add(r.shard)
        load[r.shard] += r.size
    assert all(len(x) == 1 for x in shard_of.values())
    groups = Counter()
    for r in rows:
        groups[texts[r.doc_id]] += r.size
    assert max(load.values()) - min(load[s] for s in range(16)) <= max(groups.values())


def test_schedule_is_greedy():
    """The loads are those of a plain heap over every single group."""
    pick = random.Random(2)
    sizes = [pick.randint(1, 40) for _ in range(900)] + [3] * 2000 + [5000, 4000, 77]
    counts = Counter(sizes)
    out = sharding.schedule([(s, n, s * n) for s, n in counts.items()], 7)
    assert {s: sum(d) for s, d in out} == counts
    loads = [sum(s * d[k] for s, d in out) for k in range(7)]
    plain = [0] * 7
    for s in sorted(sizes, reverse=True):
        plain[plain.index(min(plain))] += s
    assert sorted(loads) == sorted(plain)


def test_odd_rows(spark, documents_of, odd_rows):
    docs = sharding.document_rows(documents_of(odd_rows))
    out = sharding.sharded(spark, docs, "size", "text_group", 4)
    assert [c for c in out.columns if c.lower() != "shard" and c != "slot"] == [c for c in docs.columns if c.lower() != "shard"]
    rows = out.collect()
    assert len(rows) == len(odd_rows)
    check(rows, 4)
    # Null and empty texts are equal; the largest groups lie alone.
    assert len({r.shard for r in rows if not r.text}) == 1
    assert sharding.sharded(spark, sharding.document_rows(documents_of([])), "size", "text_group").count() == 0


def test_size_classes(spark):
    sizes = [1, 65535, 65536, 65537, 10**6 + 1, 10**9 + 7, 2**40 + 12345]
    got = spark.createDataFrame([(s,) for s in sizes], "size long").select("size", sharding.size_class(F.col("size")).alias("c"))
    for r in got.collect():
        assert r.c <= r.size and (r.size < 65536 and r.c == r.size or (r.size - r.c) * 2**11 <= r.size)


def test_large_groups_are_scheduled_by_their_exact_sizes(spark):
    """Sizes that share a class, but are above a ten-thousandth of a share: as longest-first has them."""
    pick = random.Random(4)
    sizes = [1_000_000 + pick.randrange(400) for _ in range(60)] + [pick.randrange(1, 300) for _ in range(400)]
    assert len({s for s in sizes if s > 10**6}) > 40
    rows = spark.createDataFrame(list(enumerate(sizes)), "text_group long, size long")
    load = Counter()
    for r in sharding.sharded(spark, rows, "size", "text_group", 7).collect():
        load[r.shard] += r.size
    plain = [0] * 7
    for s in sorted(sizes, reverse=True):
        plain[plain.index(min(plain))] += s
    assert sorted(load.values()) == sorted(plain)


def test_query_equals_plain_schedule(spark):
    """The loads of the registered query are those of a heap over all groups of equal texts."""
    texts = Counter((r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    plain = [0] * 16
    for size in sorted(((len(t.encode()) + 1) * n for t, n in texts.items()), reverse=True):
        plain[plain.index(min(plain))] += size
    load = Counter()
    for r in queries.op4_sharding(spark, SF).collect():
        load[r.shard] += r.size
    assert sorted(load.values()) == sorted(plain)


def test_rows_without_a_group_are_one_group(spark):
    rows = spark.createDataFrame([(None, 5), (None, 7), ("a", 3), ("a", 3), ("b", 4)], "text_group string, size long")
    found = sharding.sharded(spark, rows, "size", "text_group", 3).collect()
    assert len(found) == 5
    shards = defaultdict(set)
    for r in found:
        shards[r.text_group].add(r.shard)
    assert all(len(x) == 1 for x in shards.values()) and len(set(map(tuple, shards.values()))) == 3
