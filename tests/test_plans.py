from __future__ import annotations

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators.watermark import BEGINNING, OVERLAP
from tidemark.plans.config import DEFAULT_MODULES, MODULE_TABLES, refresh_table
from tidemark.plans.modules import Module, history_path, sync_modules
from tidemark.plans.objects import ObjectSource, sync_objects
from tidemark.plans.refresh import PagedModule, RefreshSource, refresh_objects, refresh_with_history
from tidemark.plans.store import Store
from tidemark.workloads.registry import utc

T0, T1 = utc("2024-06-01T12:00:00"), utc("2024-06-02T12:00:00")
RECORD = "id string, Amount string, Date string, Parent_Id struct<id: string, name: string>, Modified_Time string"


def records(spark, *items):
    """Records of (id, amount, modified)."""
    full = [(i, a, "2024-01-01", ("B1", "Block 1"), m) for i, a, m in items]
    return spark.createDataFrame(full, RECORD)


class Feed:
    """Hands out one batch per run and remembers what it was asked for."""

    def __init__(self, *batches):
        self.batches, self.asked = list(batches), []

    def __call__(self, since):
        self.asked.append(since)
        batch = self.batches.pop(0)
        if isinstance(batch, Exception):
            raise batch
        return batch


def mark(store, module):
    return store.marks("crm", [module], T1)[module][0]


class TestModules:
    def test_two_runs(self, spark, path):
        store = Store(spark, path)
        feed = Feed(
            records(spark, ("1", "5", "2024-05-01T00:00:00Z"), ("2", "6", "2024-05-02T00:00:00Z")),
            records(spark, ("2", "7", "2024-05-03T00:00:00Z"), ("3", "1", "bad")),
        )
        module = Module("Deals", "Deals", feed)
        for run, at in (("r0", T0), ("r1", T1)):
            result = sync_modules(store, "crm", [module], run, at)
            assert [(r.status, r.records, r.healthy) for r in result] == [("synced", 2, True)]
        assert rows(store.read("Deals").select("id", "Amount", "Parent_Id_id")) == [
            ("1", "5", "B1"), ("2", "7", "B1"), ("3", "1", "B1"),
        ]
        assert feed.asked == [BEGINNING, utc("2024-05-02T00:00:00") - OVERLAP]
        assert mark(store, "Deals") == utc("2024-05-03T00:00:00")
        log = store.run_log().orderBy("started_at").select("source", "status", "records_processed").collect()
        assert [tuple(r) for r in log] == [("crm", "SUCCESS", 2)] * 2

    @pytest.mark.parametrize("idle, wanted", [("hold", "2024-05-01T00:00:00"), ("now", "2024-06-02T12:00:00")])
    def test_idle_runs_never_move_a_mark_back(self, spark, path, idle, wanted):
        store = Store(spark, path)
        empty = records(spark)
        feed = Feed(records(spark, ("1", "5", "2024-05-01T00:00:00Z")), empty, empty)
        for run, at in (("r0", T0), ("r1", T1), ("r2", T1)):
            result = sync_modules(store, "crm", [Module("Deals", "Deals", feed)], run, at, idle=idle)
        assert result[0].status == "idle" and store.read("Deals").count() == 1
        assert mark(store, "Deals") == utc(wanted)

    def test_a_failing_feed_is_skipped(self, spark, path):
        store = Store(spark, path)
        bad = Module("Blocks", "Blocks", Feed(ConnectionError("gone")))
        late = records(spark, ("1", "5", "2024-05-01T00:00:00Z")).withColumn(
            "Amount", F.raise_error(F.lit("broken page"))
        )
        good = Module("Deals", "Deals", Feed(records(spark, ("1", "5", "2024-05-01T00:00:00Z"))))
        result = sync_modules(store, "crm", [bad, Module("Late", "Late", Feed(late)), good], "r0", T0)
        assert [r.status for r in result] == ["skipped", "skipped", "synced"]
        assert store.read("Blocks") is None and mark(store, "Blocks") is None

    def test_subform_stands_in(self, spark, path):
        store = Store(spark, path)
        blocks = spark.sql(
            """SELECT '1' AS id, 'Block' AS Name, '2024-05-01T00:00:00Z' AS Modified_Time,
                      array(named_struct('id', 's1', 'Site', 'x'), named_struct('id', 's2', 'Site', 'y')) AS splits"""
        )
        modules = [
            Module("Blocks", "Blocks", Feed(blocks)),
            Module("Site Splits", "Site_Splits", Feed(OSError("401")), subform_of="Blocks"),
        ]
        result = sync_modules(store, "crm", modules, "r0", T0)
        assert [r.records for r in result] == [1, 2]
        assert mark(store, "Site Splits") == mark(store, "Blocks") == utc("2024-05-01T00:00:00")
        assert rows(store.read("Site_Splits").select("id", "Parent_Id_id", "Parent_Id_name")) == [
            ("s1", "1", "Block"), ("s2", "1", "Block"),
        ]

    def test_an_idle_parent_does_not_stand_in(self, spark, path):
        modules = [
            Module("Blocks", "Blocks", Feed(records(spark))),
            Module("Site Splits", "Site_Splits", Feed(OSError("401")), subform_of="Blocks", keeps_history=True),
        ]
        result = sync_modules(Store(spark, path), "crm", modules, "r0", T0)
        assert [r.status for r in result] == ["idle", "skipped"]

    def test_a_failure_after_staging_is_logged_and_raised(self, spark, path):
        store = Store(spark, path)
        module = Module("Deals", "Deals", Feed(records(spark, ("1", "5", "x"))), key=("nokey",))
        with pytest.raises(Exception):
            sync_modules(store, "crm", [module], "r0", T0)
        row = store.run_log().first()
        assert row["status"] == "FAILED" and row["error_message"]

    def test_history_and_its_repetition(self, spark, path):
        first = records(spark, ("1", "5", "2024-05-01T00:00:00Z"), ("2", "6", "2024-05-01T00:00:00Z"))
        second = records(spark, ("1", "8", "2024-05-02T00:00:00Z"), ("2", "6", "2024-05-02T00:00:00Z"))
        runs = [(first, "r0", T0), (second, "r1", T1), (second, "r1", T1)]  # the last run repeated
        for batch, run, at in runs:
            module = Module("Revenue Recognition", "Revenue_Recognition", Feed(batch), keeps_history=True)
            sync_modules(Store(spark, path), "crm", [module], run, at)
        history = spark.read.parquet(history_path(Store(spark, path)))
        assert rows(history.select("revenue_id", "Type", "amount")) == [
            ("1", "Amount changed", "8"), ("1", "Create", "5"), ("2", "Create", "6"),
        ]

    def test_partitioned_target(self, spark, path):
        store = Store(spark, path)
        batches = [
            records(spark, ("1", "5", "2024-05-01T00:00:00Z"), ("2", "6", "2024-05-02T00:00:00Z")),
            records(spark, ("2", "7", "2024-05-03T00:00:00Z")),
        ]
        for run, batch in enumerate(batches):
            module = Module("Deals", "Deals", Feed(batch), partition_by=F.col("id"))
            sync_modules(store, "crm", [module], f"r{run}", T0)
        assert rows(store.read("Deals").select("id", "Amount")) == [("1", "5"), ("2", "7")]

    def test_reset_reads_everything_again(self, spark, path):
        store = Store(spark, path)
        batch = records(spark, ("1", "5", "2024-05-01T00:00:00Z"))
        feed = Feed(batch, batch)
        sync_modules(store, "crm", [Module("Deals", "Deals", feed)], "r0", T0)
        store.reset("Deals", "fix")
        sync_modules(store, "crm", [Module("Deals", "Deals", feed)], "r1", T1)
        assert feed.asked[1] == BEGINNING
        assert store.read("Deals").count() == 1


def deals(spark, *items):
    return spark.createDataFrame(
        list(items), "id string, associated_company_ids string, lastmodifieddate string"
    )


def test_objects(spark, path):
    store = Store(spark, path)
    companies = spark.createDataFrame([(k, k.upper()) for k in "abc"], "id string, name string")
    stages = spark.sql(
        "SELECT 'p' AS id, 'P' AS label, array(named_struct('id', 's', 'label', 'S', 'displayOrder', 0)) AS stages"
    )
    person = "id string, firstName string, lastName string"

    def source(first):
        return ObjectSource(
            pipelines=lambda: stages,
            owners=lambda archived: spark.createDataFrame([("2" if archived else "1", "A", None)], person),
            deals=lambda since: deals(spark, ("1", "a, b", "2024-05-01T00:00:00Z")) if first else deals(spark),
            companies=lambda since: companies.filter("id = 'b'").withColumn("name", F.lit("fresh")),
            all_companies=lambda: companies,
            line_items=lambda since: spark.createDataFrame([("l1", "2024-04-01T00:00:00Z")], "id string, lastmodifieddate string"),
        )

    for run, at in (("r0", T0), ("r1", T1)):
        result = sync_objects(store, "crm", source(run == "r0"), run, at)
    assert [(r.label, r.records) for r in result] == [
        ("pipelines", 1), ("owners", 2), ("deals", 0), ("companies", 1), ("line_items", 1),
    ]
    assert rows(store.read("Companies")) == [("a", "A"), ("b", "fresh")]
    assert rows(store.read("Owners").select("id", "fullName", "archived")) == [("1", "A", False), ("2", "A", True)]
    assert mark(store, "deals") == utc("2024-05-01T00:00:00")


def test_refresh_of_objects(spark, path):
    store = Store(spark, path)
    person = "id string, firstName string, lastName string"
    feeds = RefreshSource(
        pipelines=lambda: spark.sql(
            "SELECT 'p' AS id, 'P' AS label, array(named_struct('id', 's', 'label', 'S', 'displayOrder', 0)) AS stages"
        ),
        owners=lambda archived: spark.createDataFrame([("1", "A", None)], person),
        deals=lambda: deals(spark, ("1", "b", "None")),
        companies=lambda: spark.createDataFrame([(k, k.upper()) for k in "abc"], "id string, name string"),
        line_items=lambda: spark.createDataFrame([], "id string"),
    )
    result = refresh_objects(store, feeds, "r0", T0)
    assert [(r.label, r.records) for r in result] == [
        ("pipelines", 1), ("owners", 2), ("deals", 1), ("companies", 1), ("line_items", 0),
    ]
    assert store.read("Line_Items") is None
    assert rows(store.read("Companies")) == [("b", "B")]
    assert rows(store.read("Owners").select("fullName", "archived")) == sorted(
        [(None, "false"), (None, "true")], key=repr
    )
    log = spark.read.parquet(f"{path}/meta/etl_logs").first()
    assert (log["status"], log["total_records_processed"], log["timestamp"], log["error_message"]) == (
        "SUCCESS", "5", "2024-06-01 17:30:00", None,
    )


def test_refresh_goes_on_without_the_lesser_tables(spark, path):
    def broken():
        raise OSError("403")

    feeds = RefreshSource(
        pipelines=broken,
        owners=lambda archived: broken(),
        deals=lambda: deals(spark, ("1", "b", "x")),
        companies=lambda: spark.createDataFrame([("b", "B")], "id string, name string"),
        line_items=broken,
    )
    store = Store(spark, path)
    result = refresh_objects(store, feeds, "r0", T0)
    assert [r.status for r in result] == ["skipped", "skipped", "replaced", "replaced", "skipped"]
    no_deals = RefreshSource(broken, broken, lambda: deals(spark), broken, broken)
    result = refresh_objects(store, no_deals, "r1", T1)
    assert [r.label for r in result if r.status != "skipped"] == ["deals"]
    with pytest.raises(OSError):
        refresh_objects(store, RefreshSource(broken, broken, broken, broken, broken), "r2", T1)
    log = spark.read.parquet(f"{path}/meta/etl_logs")
    assert sorted(r["status"] for r in log.collect()) == ["FAILED", "SUCCESS", "SUCCESS"]
    assert store.read("Companies").count() == 1


def paged(spark, items, more=False):
    lines = [{"page": 1, "data": [{"id": i, "Amount": a, "Date": "d"} for i, a in items], "info": {"more_records": more}}]
    schema = "page bigint, data array<struct<id: string, Amount: double, Date: string>>, info struct<more_records: boolean>"
    return spark.read.schema(schema).json(spark.sparkContext.parallelize([json.dumps(x) for x in lines]))


def test_refresh_with_history(spark, path):
    store = Store(spark, path)
    snapshots = [
        (paged(spark, [("1", 5.0), ("2", 6.0)]), "replaced"),
        (paged(spark, [("1", 7.5)], more=True), "incomplete"),  # cut: 2 is not gone
        (paged(spark, [("1", 7.5), ("3", 1.0)]), "replaced"),
        (paged(spark, []), "idle"),
    ]
    for run, (pages, status) in enumerate(snapshots):
        module = PagedModule("Revenue Recognition", "Revenue", lambda pages=pages: pages, keeps_history=True)
        result = refresh_with_history(store, [module], f"r{run}", T0 + timedelta(days=run))
        assert [r.status for r in result] == [status]
        if status == "incomplete":
            assert store.read("Revenue").count() == 2
    assert rows(store.read("Revenue").select("id", "Amount")) == [("1", "7.5"), ("3", "1.0")]
    history = spark.read.parquet(history_path(store)).select("revenue_id", "Type", "amount")
    assert rows(history) == sorted(
        [
            ("1", "Create", "5"), ("2", "Create", "6"), ("1", "Amount changed", "7.5"),
            ("2", "Deleted (Replaced by 3)", "6"), ("3", "Replaced 2", "1"),
        ],
        key=repr,
    )


def test_names():
    assert refresh_table("SIte_Splits") == "raw_Site_Splits"
    assert MODULE_TABLES["Stage History"] == "DealHistory" and "Site_Splits" in DEFAULT_MODULES
