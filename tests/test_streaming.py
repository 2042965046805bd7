from __future__ import annotations

import random
from datetime import datetime
from glob import glob

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tidemark.operators.upsert import upsert_newest
from tidemark.sinks.partitioned import PartitionedTable, key_bucket
from tidemark.sinks.snapshot import SnapshotTable
from tidemark.sinks.commits import Commits, CommittedLog
from tidemark.sinks.merged import MergedTable
from tidemark.session import shared_root
from tidemark.streaming.changes import STATE_STORE, compare_versions, stream_changes
from tidemark.streaming.dedupe import dedupe_stream, late_rows
from tidemark.streaming.upsert import stream_upsert
from tidemark.workloads.landings import stream_changes_query

SCHEMA = "id string, v int, seq int"
STATES = "id string, amount string, Revenue_date string, Block_id string, block_name string, __changed timestamp"


def run(spark, path, target, partition_by=None):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{path}/landing")
    query = stream_upsert(
        stream, target, ["id"], ["seq"], name="test_upsert",
        checkpoint=f"{path}/checkpoint", staging=f"{path}/staging",
        partition_by=partition_by,
    )
    query.awaitTermination()
    assert query.exception() is None


def land(spark, path, *records):
    spark.createDataFrame(list(records), SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/landing")


def test_files_are_applied_once_and_late_rows_lose(spark, path):
    target = SnapshotTable(spark, f"{path}/target")
    land(spark, path, ("a", 1, 5), ("b", 1, 1))
    land(spark, path, ("a", 0, 2), ("b", 2, 7))
    run(spark, path, target)
    assert rows(target.read()) == [("a", 1, 5), ("b", 2, 7)]
    version = target.current().version
    run(spark, path, target)
    assert target.current().version == version
    land(spark, path, ("c", 3, 1), ("b", 9, 6))
    run(spark, path, SnapshotTable(spark, f"{path}/target"))
    assert rows(SnapshotTable(spark, f"{path}/target").read()) == [("a", 1, 5), ("b", 2, 7), ("c", 3, 1)]


def test_partitioned_target(spark, path):
    target = PartitionedTable(spark, f"{path}/target")
    land(spark, path, *[(str(i), 1, 5) for i in range(20)])
    land(spark, path, ("3", 0, 2), ("4", 2, 7))
    run(spark, path, target, key_bucket(["id"], 8))
    got = {r["id"]: r["v"] for r in target.read().collect()}
    assert len(got) == 20 and (got["3"], got["4"]) == (1, 2)
    with pytest.raises(ValueError):
        run(spark, path, target)


def test_a_replayed_batch_changes_nothing(spark):
    target = spark.createDataFrame([("a", 1, 5), ("b", 1, 1)], SCHEMA)
    batch = spark.createDataFrame([("a", 2, 6), ("b", 0, 0)], SCHEMA)
    once = upsert_newest(target, batch, ["id"], ["seq"])
    assert rows(once) == [("a", 2, 6), ("b", 1, 1)]
    assert rows(upsert_newest(once, batch, ["id"], ["seq"])) == rows(once)


class TestDedupe:
    def run(self, spark, path):
        log, late = self.logs(spark, path)
        stream = spark.readStream.schema("id string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{path}/landing")
        dedupe_stream(stream, log, ["id"], "ts", "10 minutes", name="test_dedupe", checkpoint=f"{path}/check").awaitTermination()
        late_rows(
            stream, log, late, ["id"], "ts", "10 minutes", name="test_late", checkpoint=f"{path}/check-late", staging=f"{path}/staging"
        ).awaitTermination()

    def logs(self, spark, path):
        commits = Commits(spark, f"{path}/commits")
        return CommittedLog(spark, f"{path}/log", commits, "log"), CommittedLog(spark, f"{path}/late", commits, "late")

    def land(self, spark, path, *items):
        rows = [(i, datetime(2024, 1, 1, hour, minute)) for i, hour, minute in items]
        spark.createDataFrame(rows, "id string, ts timestamp").coalesce(1).write.mode("append").parquet(f"{path}/landing")

    def test_repeats_and_late_rows(self, spark, path):
        self.land(spark, path, ("a", 1, 0), ("a", 1, 1), ("b", 1, 2))
        self.land(spark, path, ("b", 1, 2), ("c", 3, 0))
        self.land(spark, path, ("f", 3, 0))  # a batch drops what was late when the batch before it began
        self.land(spark, path, ("late", 1, 30), ("late", 1, 31), ("a", 1, 0), ("d", 3, 1))
        self.run(spark, path)
        log, late = self.logs(spark, path)
        assert rows(log.read().select("id")) == [("a",), ("b",), ("c",), ("d",), ("f",)]
        assert rows(late.read().select("id")) == [("late",)]
        self.run(spark, path)  # nothing new
        self.land(spark, path, ("d", 3, 1), ("late", 1, 30), ("e", 5, 0))
        self.run(spark, path)
        log, late = self.logs(spark, path)
        assert rows(log.read().select("id")) == [("a",), ("b",), ("c",), ("d",), ("e",), ("f",)]
        assert rows(late.read().select("id")) == [("late",)]

    def test_a_replayed_batch_appends_nothing(self, spark, path):
        self.land(spark, path, ("a", 1, 0))
        self.run(spark, path)
        log, _ = self.logs(spark, path)
        assert not log.append(log.read(), "test_dedupe-0") and log.read().count() == 1


class TestChanges:
    def run(self, spark, path):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
        stream = spark.readStream.schema(STATES).option("maxFilesPerTrigger", 1).parquet(f"{path}/landing")
        log = CommittedLog(spark, f"{path}/log", Commits(spark, f"{path}/commits"), "changes")
        stream_changes(stream, log, datetime(2024, 6, 1), name="test_changes", checkpoint=f"{path}/check").awaitTermination()
        return CommittedLog(spark, f"{path}/log", Commits(spark, f"{path}/commits"), "changes").read()

    def land(self, spark, path, *items):
        rows = [(i, a, d, None, None, None if t is None else datetime(2024, 5, t)) for i, a, d, t in items]
        spark.createDataFrame(rows, STATES).coalesce(1).write.mode("append").parquet(f"{path}/landing")

    def test_state_survives_a_restart(self, spark, path):
        self.land(spark, path, ("1", "5", "d", 1), ("2", None, None, 1), ("3", "1", "d", None), (None, "9", "d", 1))
        assert rows(self.run(spark, path).select("revenue_id", "Type", "amount")) == sorted(
            [("1", "Create", "5"), ("2", "Create", None), ("3", "Create", "1")], key=repr
        )
        # Another session goes on from the checkpoint; of two versions the newest counts, an older one is left out.
        self.land(spark, path, ("1", "6", "d", 2), ("1", "7", "e", 3), ("2", "4", None, 2), ("3", "1", "d", 2))
        self.land(spark, path, ("1", "5", "d", 1), ("2", "4", "x", 3), ("4", "1", "d", 1))
        found = self.run(spark, path).filter("Type <> 'Create'").select("revenue_id", "Type", "amount")
        assert rows(found) == sorted(
            [("1", "Amount changed and Date changed", "7"), ("2", "Amount changed", "4"), ("2", "Date changed", "4")], key=repr
        )
        before = self.run(spark, path).count()
        assert before == 7 and self.run(spark, path).count() == before

    def stream(self, spark, path):
        log = CommittedLog(spark, f"{path}/log", Commits(spark, f"{path}/commits"), "changes")
        stream = spark.readStream.schema(STATES).option("maxFilesPerTrigger", 1).parquet(f"{path}/landing")
        query = stream_changes(stream, log, datetime(2024, 6, 1), name="test_changes", checkpoint=f"{path}/check")
        query.awaitTermination()
        return query

    def test_no_key_goes_through_python(self, spark, path):
        self.land(spark, path, ("1", "5", "d", 1))
        self.land(spark, path, ("1", "6", "d", 2))
        query = self.stream(spark, path)
        explained = query._jsq.explainInternal(False)
        assert "Scan" in explained and "Python" not in explained and "PySpark" not in explained
        assert query.lastProgress["stateOperators"] == []

    def test_a_small_batch_does_not_shuffle_the_last_versions(self, spark, path):
        columns = {c: F.col("id") for c in ("amount", "Revenue_date", "Block_id", "block_name")}
        all_keys = spark.range(100_000).select(F.col("id").cast("string")).withColumns({**columns, "changed_at": F.lit(1).cast("bigint")})
        all_keys.write.parquet(f"{path}/last")
        all_keys.filter("id < 5").write.parquet(f"{path}/batch")
        compared = compare_versions(spark.read.parquet(f"{path}/batch"), spark.read.parquet(f"{path}/last"))
        assert "BroadcastHashJoin LeftSemi" in plan(compared) and "Python" not in plan(compared)
        assert compared.count() == 5

    def test_versions_as_a_loop_over_them_has_it(self, spark, path):
        random.seed(7)
        pick = random.choice
        batches = [
            [(str(pick(range(25))), pick("12") if pick((0, 1)) else None, pick("de"), pick((None, 1, 2, 3, 4, 5))) for _ in range(40)] for _ in range(3)
        ]
        last, wanted = {}, []
        for batch in batches:
            self.land(spark, path, *batch)
            for key in {b[0] for b in batch}:
                stamp, _, amount, date = max((t or 0, (a is not None, a or ""), a, d) for k, a, d, t in batch if k == key)
                if key not in last:
                    kind = "Create"
                elif 0 < stamp < last[key][0]:
                    continue
                else:
                    kind = " and ".join(x for x, y in (("Amount changed", last[key][1] != amount), ("Date changed", last[key][2] != date)) if y)
                last[key] = (stamp, amount, date)
                wanted += [(key, kind, amount, date)] if kind else []
        found = self.run(spark, path).select("revenue_id", "Type", "amount", "Revenue_date")
        assert rows(found) == sorted(wanted, key=repr)

    @pytest.mark.parametrize("dies", ["log", "versions"])
    def test_a_run_that_dies_in_a_batch_logs_it_once(self, spark, path, monkeypatch, dies):
        self.land(spark, path, ("1", "5", "d", 1), ("2", "5", "d", 1))
        self.run(spark, path)
        self.land(spark, path, ("1", "6", "d", 2), ("2", "5", "d", 2), ("3", "5", "d", 2))
        kind, method = {"log": (CommittedLog, "append"), "versions": (MergedTable, "stage")}[dies]

        def fails(*args, **kwargs):
            raise OSError("lost")

        with monkeypatch.context() as broken:
            broken.setattr(kind, method, fails)
            with pytest.raises(Exception, match="lost"):
                self.run(spark, path)
        found = [("1", "Amount changed"), ("1", "Create"), ("2", "Create"), ("3", "Create")]
        assert rows(self.run(spark, path).select("revenue_id", "Type")) == found
        self.land(spark, path, ("2", "7", "d", 3), ("1", "9", "d", 1))
        assert rows(self.run(spark, path).select("revenue_id", "Type")) == sorted([*found, ("2", "Amount changed")])

    def test_the_last_versions_are_tended_and_lie_there_once(self, spark, path):
        for day in range(1, 5):
            self.land(spark, path, *[(str(i), str(day), "d", day) for i in range(20)])
        self.run(spark, path)
        last = MergedTable(spark, f"{path}/check/versions", ["id"], name="versions")
        assert rows(last.read().select("id", "amount")) == sorted(((str(i), "4") for i in range(20)), key=repr)
        assert len([e for e in last.live() if e.kind == "delta"]) == 1

    def test_the_query_lands_states_in_many_tasks_and_two_batches(self, spark, path):
        orders = [(k, k % 7, "O", float(k), datetime(1997, 1, 1), p) for k in range(1, 41) for p in ("2-HIGH", "2-HIGH", "1-URGENT" if k % 2 else "5-LOW")]
        schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
        spark.createDataFrame(orders, schema).repartition(4).write.parquet(f"{path}/orders.parquet")
        roots = f"{shared_root(spark)}/changes-*"
        before = set(glob(roots))
        found = stream_changes_query(spark, path)
        (root,) = set(glob(roots)) - before
        assert len(glob(f"{root}/landing/part-*")) > 2 and len(glob(f"{root}/check/offsets/[0-9]*")) == 2
        assert found.filter("Type = 'Create'").count() == 40
        kinds = {k: ["Amount changed"] * (k % 7 == 0 or k % 23 == 0) + ["Date changed"] * (k % 13 == 0) for k in range(1, 41)}
        changed = [(str(k), " and ".join(x)) for k, x in kinds.items() if x]
        assert rows(found.filter("Type <> 'Create'").select("revenue_id", "Type")) == sorted(changed, key=repr)


def test_a_merged_target_takes_each_batch_once(spark, path):
    land(spark, path, ("a", 1, 5), ("b", 1, 1))
    land(spark, path, ("a", 0, 2), ("b", 2, 7))

    def table():
        return MergedTable(spark, f"{path}/target", ["id"], 4, newest=True)

    run(spark, path, table())
    assert rows(table().read()) == [("a", 1, 5), ("b", 2, 7)]
    commits = len(table().commits.all())
    run(spark, path, table())
    land(spark, path, ("c", 3, 1), ("b", 9, 6))
    run(spark, path, table())
    assert rows(table().read()) == [("a", 1, 5), ("b", 2, 7), ("c", 3, 1)] and len(table().commits.all()) > commits
    with pytest.raises(ValueError):
        run(spark, path, MergedTable(spark, f"{path}/other", ["id"]))
