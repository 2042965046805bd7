from __future__ import annotations

import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tidemark.operators.upsert import upsert
from tidemark.operators.watermark import WATERMARK_SCHEMA
from tidemark.sinks import tables
from tidemark.sinks.partitioned import PartitionedTable, key_bucket
from tidemark.sinks.snapshot import SnapshotTable


def frame(spark, *records):
    return spark.createDataFrame(list(records), "id string, v int")


class TestSnapshot:
    def test_versions_follow_each_other(self, spark, path):
        table = SnapshotTable(spark, path)
        assert table.current() is None and table.read() is None
        for version in range(1, 6):
            assert table.publish(frame(spark, ("a", version)), f"run-{version}") == version
            assert rows(table.read()) == [("a", version)]
            assert SnapshotTable(spark, path).current() == table.current()

    def test_a_version_can_be_made_from_the_last_one(self, spark, path):
        table = SnapshotTable(spark, path, slots=2)
        table.publish(frame(spark, ("a", 1)), "run-0")
        for step in range(4):
            table.publish(upsert(table.read(), frame(spark, (f"k{step}", step))), f"run-{step}")
        assert table.read().count() == 5

    def test_the_reader_of_the_last_version_is_not_disturbed(self, spark, path):
        table = SnapshotTable(spark, path)
        table.publish(frame(spark, ("a", 1)), "run-0")
        held = table.read()
        table.publish(frame(spark, ("a", 2)), "run-1")
        assert rows(held) == [("a", 1)]

    def test_a_write_that_failed_leaves_the_current_version(self, spark, path):
        table = SnapshotTable(spark, path)
        table.publish(frame(spark, ("a", 1)), "run-0")
        broken = frame(spark, ("b", 0)).withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
        with pytest.raises(Exception):
            table.publish(broken, "run-1")
        assert rows(SnapshotTable(spark, path).read()) == [("a", 1)]
        assert table.publish(frame(spark, ("a", 2)), "run-2") == 2
        assert rows(table.read()) == [("a", 2)]

    def test_replace_skips_an_empty_input(self, spark, path):
        table = SnapshotTable(spark, path)
        assert table.replace(frame(spark), "run-0") == 0 and table.read() is None
        assert table.replace(frame(spark, ("a", 1), ("b", 2)), "run-1") == 2
        assert table.replace(frame(spark), "run-2") == 0
        assert table.read().count() == 2

    def test_one_slot_is_not_enough(self, spark, path):
        with pytest.raises(ValueError):
            SnapshotTable(spark, path, slots=1)


class TestPartitioned:
    def test_only_touched_partitions_are_rewritten(self, spark, path):
        table = PartitionedTable(spark, path)
        assert table.read() is None
        rows_in = spark.range(100).select(
            F.col("id").cast("string").alias("id"), F.lit(0).alias("v"), (F.col("id") % 10).alias("month")
        )
        assert table.upsert(rows_in, ["id"], F.col("month")) == 10
        files = {r["f"] for r in table.read().select(F.input_file_name().alias("f")).distinct().collect()}
        delta = rows_in.filter("id IN ('3', '13')").withColumn("v", F.lit(9))
        assert table.upsert(delta, ["id"], F.col("month")) == 1
        after = {r["f"] for r in table.read().select(F.input_file_name().alias("f")).distinct().collect()}
        assert len(files & after) == 9
        assert sorted(r["id"] for r in table.read().filter("v = 9").collect()) == ["13", "3"]
        assert table.read().count() == 100
        assert table.upsert(delta, ["id"], F.col("month")) == 1 and table.read().count() == 100

    def test_by_key_hash_with_a_new_column(self, spark, path):
        table = PartitionedTable(spark, path)
        by = key_bucket(["id"], 4)
        table.upsert(frame(spark, *[(str(i), i) for i in range(20)]), ["id"], by)
        assert table.upsert(frame(spark, ("5", 50)).withColumn("extra", F.lit("x")), ["id"], by) == 1
        got = {r["id"]: (r["v"], r["extra"]) for r in table.read().collect()}
        assert len(got) == 20 and got["5"] == (50, "x") and got["6"] == (6, None)
        # A delta without the newer column leaves it null on its rows, not on others.
        assert table.upsert(frame(spark, ("6", 60)), ["id"], by) == 1
        got = {r["id"]: (r["v"], r["extra"]) for r in table.read().collect()}
        assert len(got) == 20 and got["5"] == (50, "x") and got["6"] == (60, None)
        assert table.upsert(frame(spark), ["id"], by) == 0

    def test_partition_values_stay_texts(self, spark, path):
        table = PartitionedTable(spark, path)
        months = frame(spark, ("a", 1), ("b", 2), ("c", 3)).withColumn(
            "m", F.when(F.col("id") == "a", "01").when(F.col("id") == "b", "1")
        )
        for _ in range(2):
            assert table.upsert(months, ["id"], F.col("m")) == 3
        assert rows(table.read()) == sorted([("a", 1, "01"), ("b", 2, "1"), ("c", 3, None)], key=repr)

    def test_types_stay_where_they_can(self, spark, path):
        table = PartitionedTable(spark, path)
        table.upsert(spark.createDataFrame([(str(i), 0.5, i) for i in range(9)], "id string, x double, n long"), ["id"], 4)
        nulls = spark.createDataFrame([("1", 2, None)], "id string, x long, n string")
        assert table.upsert(nulls, ["id"], 4) == 1
        assert dict(table.read().dtypes) == {"id": "string", "x": "double", "n": "bigint"}
        assert table.upsert(spark.createDataFrame([("2", 1.5, 2.5)], "id string, x double, n double"), ["id"], 4) == 1
        assert dict(table.read().dtypes)["n"] == "double"
        table.upsert(spark.createDataFrame([("3", "word")], "id string, x string"), ["id"], 4)
        got = {r["id"]: (r["x"], r["n"]) for r in table.read().collect()}
        assert dict(table.read().dtypes)["x"] == "string" and len(got) == 9
        assert (got["0"], got["1"], got["2"], got["3"]) == (("0.5", 0.0), ("2.0", None), ("1.5", 2.5), ("word", None))

    def test_a_key_may_not_move(self, spark, path):
        table = PartitionedTable(spark, path)
        table.upsert(frame(spark, ("a", 1), ("b", 2)), ["id"], F.col("v"))
        table.upsert(frame(spark, ("a", 1), ("c", 2)), ["id"], F.col("v"))
        with pytest.raises(ValueError, match="move"):
            table.upsert(frame(spark, ("a", 2)), ["id"], F.col("v"))


def test_route(spark, path):
    for n in (1, 2):
        assert tables.route(frame(spark, ("a", n)), path, "Deals") == "overwrite"
        assert tables.route(frame(spark, ("a", n)), path, "etl_logs") == "append"
    assert tables.route(frame(spark), path, "Deals") is None
    assert rows(spark.read.parquet(f"{path}/Deals")) == [("a", 2)]
    assert spark.read.parquet(f"{path}/etl_logs").count() == 2


def test_append_missing_adds_once(spark, path):
    target = f"{path}/log"
    for _ in range(2):
        tables.append_missing(frame(spark, ("a", 1), ("b", 2)), target, "id")
    tables.append_missing(frame(spark, ("b", 2), ("c", 2)), target, "id", within=F.col("v") == 2)
    assert rows(spark.read.parquet(target)) == [("a", 1), ("b", 2), ("c", 2)]


def test_create_from_staging_refuses_a_second_load(spark, path):
    tables.create_from_staging(frame(spark, ("a", 1)), f"{path}/t")
    with pytest.raises(AnalysisException):
        tables.create_from_staging(frame(spark, ("a", 2)), f"{path}/t")


@pytest.fixture
def database(spark, path):
    name = f"db_{uuid.uuid4().hex}"
    tables.ensure_database(spark, name, f"{path}/db")
    tables.ensure_database(spark, name)
    return name


def test_ensure_and_drop_table(spark, database):
    name = f"{database}.watermarks"
    for _ in range(2):
        tables.ensure_table(spark, name, WATERMARK_SCHEMA, ["source", "module"])
    assert set(spark.table(name).columns) == set(WATERMARK_SCHEMA.names)
    for _ in range(2):
        tables.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_bucketed_target_is_joined_in_place(spark, database):
    """With a delta too large to broadcast, a bucketed target is still not shuffled."""
    name = f"{database}.deals"
    data = spark.range(1000).select(F.col("id").cast("string").alias("id"), F.col("id").cast("int").alias("v"))
    tables.write_bucketed(data, name, ["id"], 8)
    delta = data.filter("v < 300").withColumn("v", F.lit(-1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = upsert(spark.table(name), delta)
        text = plan(merged)
        anti = text[: text.index("LeftAnti")]
        assert "SortMergeJoin" in anti and "Exchange" not in anti.split("SortMergeJoin")[0]
        assert merged.count() == 1000 and merged.filter("v = -1").count() == 300
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_merge_needs_a_table_that_takes_it(spark, database):
    name = f"{database}.plain"
    frame(spark, ("a", 1)).write.saveAsTable(name)
    with pytest.raises(Exception, match="MERGE"):
        tables.merge_into(frame(spark, ("a", 2)), name, ["id"])
