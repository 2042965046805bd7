from __future__ import annotations

import json

import pytest
from pyspark.sql import types as T

from tests.conftest import rows
from tidemark import session
from tidemark.sources.ndjson import BadRecordBudgetExceeded, load_ndjson
from tidemark.sources.pages import (
    feed_complete,
    property_names,
    read_module_pages,
    read_object_pages,
    unwrap_line_items,
    unwrap_module_pages,
    unwrap_objects,
)
from tidemark.sources.tables import read_if_exists


def write_lines(spark, path, lines):
    texts = [line if isinstance(line, str) else json.dumps(line) for line in lines]
    spark.createDataFrame([(t,) for t in texts], "value string").write.text(path)
    return path


def linked(*ids):
    return {"results": [{"id": i} for i in ids]}


class TestObjectPages:
    def pages(self, spark, path):
        deal = {
            "id": "1", "createdAt": "c", "updatedAt": "u", "archived": True,
            "properties": {"amount": "5", "Stage": None},
            "associations": {"companies": linked("9", "10", "9"), "deals": linked("7", "8")},
        }
        bare = {"id": "2", "properties": {"amount": "6", "id": "shadowed"}}
        pages = [{"results": [deal, bare], "paging": {"next": {"after": "x"}}}, {"results": []}, {"other": 1}]
        return read_object_pages(spark, write_lines(spark, f"{path}/pages", pages))

    def test_objects(self, spark, path):
        pages = self.pages(spark, path)
        assert property_names(pages) == ["Stage", "amount", "id"]
        objects = unwrap_objects(pages, property_names(pages), companies=True)
        assert rows(objects.select("id", "amount", "Stage", "createdAt", "archived", "associated_company_ids")) == [
            ("1", "5", None, "c", True, "10,9"), ("2", "6", None, None, False, None),
        ]
        assert "associated_company_ids" not in unwrap_objects(pages, ["amount"]).columns

    def test_line_items(self, spark, path):
        items = unwrap_line_items(self.pages(spark, path), ["amount"])
        assert rows(items) == [("5", "1", "7"), ("6", "2", None)]


class TestModulePages:
    RECORD = T.StructType([T.StructField("id", T.StringType()), T.StructField("x", T.LongType())])

    def pages(self, spark, path, *numbered):
        lines = [
            {"page": n, "data": [{"id": f"{n}", "x": n, "unknown": 1}], "info": {"more_records": more}}
            for n, more in numbered
        ]
        return read_module_pages(spark, write_lines(spark, f"{path}/p", lines), self.RECORD)

    def test_records(self, spark, path):
        assert rows(unwrap_module_pages(self.pages(spark, path, (1, True), (2, False)))) == [("1", 1), ("2", 2)]

    @pytest.mark.parametrize(
        "numbered, complete",
        [
            ([(1, True), (2, False)], True),
            ([(1, True), (2, True)], False),
            ([(2, False)], False),
            ([(1, True), (3, False)], False),
            ([(1, None)], False),
            ([(1, True), (2, None)], False),
            ([(1, True), (None, False), (2, False)], False),
            ([(None, True), (None, False)], True),
        ],
    )
    def test_completeness(self, spark, path, numbered, complete):
        assert feed_complete(self.pages(spark, path, *numbered)).first()["complete"] is complete

    def test_no_pages_is_not_complete(self, spark, path):
        pages = self.pages(spark, path, (1, False)).filter("page > 1")
        assert feed_complete(pages).first()["complete"] is False


class TestNdjson:
    def test_unknown_fields_and_a_few_bad_lines(self, spark, path):
        lines = [{"a": 1, "new": "x"}, {"a": 2}, "{broken", '{"a": "word"}']
        source = write_lines(spark, f"{path}/in", lines)
        schema = T.StructType([T.StructField("a", T.LongType())])
        assert rows(load_ndjson(spark, source, f"{path}/staged", schema)) == [(1,), (2,)]

    def test_schema_is_inferred(self, spark, path):
        source = write_lines(spark, f"{path}/in", [{"a": 1}, {"b": "x"}, "{broken"])
        assert rows(load_ndjson(spark, source, f"{path}/staged")) == sorted([(1, None), (None, "x")], key=repr)

    def test_budget(self, spark, path):
        source = write_lines(spark, f"{path}/in", ["{"] * 11 + [{"a": 1}])
        schema = T.StructType([T.StructField("a", T.LongType())])
        with pytest.raises(BadRecordBudgetExceeded):
            load_ndjson(spark, source, f"{path}/staged", schema)
        assert load_ndjson(spark, source, f"{path}/again", schema, max_bad=11).count() == 1


def test_read_if_exists(spark, path):
    assert read_if_exists(spark, f"{path}/none") is None
    spark.range(3).write.parquet(f"{path}/some")
    assert read_if_exists(spark, f"{path}/some").count() == 3
    (open(f"{path}/notparquet", "w")).write("text")
    with pytest.raises(Exception):
        read_if_exists(spark, f"{path}/notparquet").count()


class FakeSession:
    """A session that only has settings."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = {k.replace("_", "."): v for k, v in settings.items()}

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_shared_root_comes_from_the_session():
    cluster = FakeSession(spark_master="yarn", spark_checkpoint_dir="hdfs:///shared/")
    assert session.shared_root(cluster) == "hdfs:///shared"
    assert session.scratch(cluster, "x").startswith("hdfs:///shared/x-")


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        session.shared_root(FakeSession(spark_master="yarn"))


def test_a_local_session_gets_a_folder_of_its_own():
    local = FakeSession(spark_master="local[2]")
    assert session.shared_root(local) == session.shared_root(local)
