"""Tables merged on read, and the commits that make their files count."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tidemark.sinks.commits import Commits, CommittedLog
from tidemark.sinks.merged import MergedTable

SCHEMA = "id string, v int, seq int"


def frame(spark, *items, schema=SCHEMA):
    return spark.createDataFrame(list(items), schema)


def size(path):
    """Bytes of the Parquet files below a folder."""
    return sum(os.path.getsize(f"{d}/{f}") for d, _, files in os.walk(path) for f in files if f.endswith(".parquet"))


def test_an_upsert_writes_its_delta_not_the_table(spark, path):
    table = MergedTable(spark, path, ["id"])
    table.upsert(spark.range(100_000).selectExpr("cast(id as string) AS id", "uuid() AS text", "0 AS v"))
    whole = size(f"{path}/base")
    delta = spark.range(100).selectExpr("cast(id * 977 as string) AS id", "'new' AS text", "1 AS v")
    assert table.upsert(delta) == 100
    state = table._state()
    assert len(state.deltas) == 1 and len(state.deltas[0].parts) == 16  # the keys fall into all parts
    assert size(f"{path}/base") == whole and size(f"{path}/delta") < whole / 100
    got = MergedTable(spark, path).read()
    assert got.count() == 100_000 and got.filter("v = 1 AND text = 'new'").count() == 100


def test_only_deltas_are_ranked(spark, path):
    table = MergedTable(spark, path, ["id"])
    table.upsert(spark.range(1000).selectExpr("cast(id as string) AS id", "1 AS v"))
    table.upsert(spark.range(5).selectExpr("cast(id as string) AS id", "2 AS v"))
    text = plan(table.read())
    assert text.count("Window") and "LeftAnti" in text
    base = text[text.index("base") :]
    assert "Window" not in base[: base.index("LeftAnti")] if "LeftAnti" in base else True


@pytest.mark.parametrize("newest", [False, True])
@pytest.mark.parametrize("seed", range(4))
def test_equal_to_a_dict(spark, path, newest, seed):
    """Random upserts, deletes and compactions against a dictionary, with late rows."""
    pick = random.Random(seed)
    table = MergedTable(spark, path, ["id"], 3, newest=newest)
    held: dict = {}
    for run in range(7):
        step = pick.choice(["upsert", "upsert", "upsert", "delete", "compact", "again"]) if run else "upsert"
        items = {str(pick.randrange(12)): (pick.randrange(100), pick.randrange(20) * 10 + run) for _ in range(pick.randint(1, 8))}
        if step in ("upsert", "again"):
            delta = [(k, v, s) for k, (v, s) in items.items()]
            for _ in range(2 if step == "again" else 1):
                table.upsert(frame(spark, *delta, (None, 1, 999)), ["seq"], txn=f"run-{run}")
            for k, v, s in delta:
                if not newest or k not in held or held[k][1] <= s:
                    held[k] = (v, s)
        elif step == "delete":
            gone = [(k, s) for k, (_, s) in items.items()]
            table.delete(frame(spark, *gone, schema="id string, seq int").select("id", "seq"), ["seq"])
            for k, s in gone:
                if not newest or k not in held or held[k][1] <= s:
                    held[k] = (None, s)
        else:
            table.compact(all_parts=pick.random() < 0.5)
        table = MergedTable(spark, path)  # as another process sees it
        want = sorted((k, v, s) for k, (v, s) in held.items() if v is not None)
        assert rows(table.read()) == want, (run, step)


def test_compaction_writes_grown_parts_only(spark, path):
    table = MergedTable(spark, path, ["id"], 8)
    table.upsert(spark.range(8000).selectExpr("cast(id as string) AS id", "0 AS v"))
    parts = {r["id"]: r["p"] for r in spark.range(8000).selectExpr("cast(id as string) AS id", "pmod(xxhash64(cast(id as string)), 8) AS p").collect()}
    hot = [k for k, p in parts.items() if p == 3][:400]
    cold = [k for k, p in parts.items() if p != 3][:30]
    table.upsert(frame(spark, *[(k, 1) for k in hot + cold], schema="id string, v int"))
    table.upsert(frame(spark, *[(k, 2) for k in cold[:10]], schema="id string, v int"))
    assert table.grown_parts() == [3]
    before = size(f"{path}/base")
    assert table.compact()
    assert size(f"{path}/base") - before < before / 4
    state = table._state()
    assert [e.kind for e in state.deltas] == ["fold"] and {p for p, e in state.base.items() if e.v > min(b.v for b in state.base.values())} == {3}
    got = {r["id"]: r["v"] for r in MergedTable(spark, path).read().collect()}
    assert len(got) == 8000
    assert all(got[k] == (2 if k in cold[:10] else 1) for k in hot + cold) and sum(v > 0 for v in got.values()) == 430


def test_many_deltas_are_tended(spark, path):
    table = MergedTable(spark, path, ["id"], 2)
    table.upsert(frame(spark, *[(str(i), 0, 0) for i in range(200)]))
    for run in range(12):
        table.upsert(frame(spark, (str(run), run + 1, 0)))
        assert len(table._state().deltas) <= 8
    assert sum(r["v"] > 0 for r in table.read().collect()) == 12 and table.read().count() == 200


def test_all_rows_of_a_part_gone(spark, path):
    table = MergedTable(spark, path, ["id"], 2)
    table.upsert(frame(spark, *[(str(i), 0, 0) for i in range(20)]))
    table.delete(frame(spark, *[(str(i),) for i in range(20)], schema="id string"))
    table.compact(all_parts=True)
    assert table.read().count() == 0 and table.at_least() == 0
    table.upsert(frame(spark, ("1", 5, 0)))
    assert rows(MergedTable(spark, path).read()) == [("1", 5, 0)]


def test_columns_and_types_may_grow(spark, path):
    table = MergedTable(spark, path, ["id"], 4)
    table.upsert(frame(spark, ("1", 1), ("2", 2), schema="id string, n int"))
    table.upsert(frame(spark, ("2", 3, "x"), schema="id string, n int, more string"))
    assert rows(table.read()) == [("1", 1, None), ("2", 3, "x")]
    table.upsert(frame(spark, ("3", "word"), schema="id string, n string"))
    assert rows(MergedTable(spark, path).read()) == [("1", "1", None), ("2", "3", "x"), ("3", "word", None)]
    table.upsert(frame(spark, (1, "w"), (4, None), schema="id bigint, n string"))
    assert rows(table.read().select("id", "n")) == [("1", "w"), ("2", "3"), ("3", "word"), ("4", None)]


def test_what_a_dead_run_wrote_does_not_count(spark, path):
    table = MergedTable(spark, path, ["id"], 4)
    table.upsert(frame(spark, ("1", 1, 0)))
    assert table.stage(frame(spark, ("1", 9, 0), ("2", 9, 0))) is not None  # dies before its commit
    again = MergedTable(spark, path)
    assert rows(again.read()) == [("1", 1, 0)]
    again.upsert(frame(spark, ("2", 2, 0)))
    again.compact(all_parts=True)
    assert rows(MergedTable(spark, path).read()) == [("1", 1, 0), ("2", 2, 0)]


def test_tables_change_together(spark, path):
    commits = Commits(spark, f"{path}/commits")
    table = MergedTable(spark, f"{path}/state", ["id"], 2, commits=commits, name="state")
    log = CommittedLog(spark, f"{path}/log", commits, "log", {"month": F.lit("2024-05")})
    entries = [table.stage(frame(spark, ("1", 1, 0))), log.stage(frame(spark, ("1", 1, 0)))]
    assert MergedTable(spark, f"{path}/state", commits=Commits(spark, f"{path}/commits"), name="state").read() is None and log.read() is None
    commits.commit("r0", entries)
    fresh = Commits(spark, f"{path}/commits")
    assert rows(MergedTable(spark, f"{path}/state", commits=fresh, name="state").read()) == [("1", 1, 0)]
    assert rows(CommittedLog(spark, f"{path}/log", fresh, "log", {"month": F.lit(None)}).read()) == [("1", 1, 0)]


def test_a_log_counts_each_append_once(spark, path):
    def log():
        return CommittedLog(spark, f"{path}/log", Commits(spark, f"{path}/commits"), "log")

    assert log().append(frame(spark, ("a", 1, 1)), "r0")
    log().stage(frame(spark, ("b", 1, 1)))  # dies before its commit
    assert log().append(frame(spark, ("b", 1, 1), ("c", 1, 1)), "r1")
    assert not log().append(frame(spark, ("b", 1, 1), ("c", 1, 1)), "r1")  # repeated
    assert not log().append(frame(spark), "r2")
    assert [r[0] for r in rows(log().read())] == ["a", "b", "c"]
    assert log().read().columns == ["id", "v", "seq"]


def test_beginning_anew_keeps_what_counts(spark, path):
    table = MergedTable(spark, path, ["id"], 2)
    for run in range(5):
        table.upsert(frame(spark, *[(str(i), run, 0) for i in range(run, 30)]))
    want = rows(table.read())
    table.commits.begin_anew(table.live())
    again = MergedTable(spark, path)
    assert rows(again.read()) == want and len(again.commits.all()) == 1
    again.upsert(frame(spark, ("0", 77, 0)))
    assert ("0", 77, 0) in rows(MergedTable(spark, path).read())
