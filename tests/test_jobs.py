"""The four jobs over landed JSON pages whose records follow no schema."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark import jobs
from tidemark.operators.explode import subform_elements
from tidemark.operators.infer import typed_records
from tidemark.plans.modules import history_path
from tidemark.plans.store import Store
from tidemark.sources.pages import feed_complete, read_variant_pages, variant_records


def land(path, feed, *pages):
    folder = path / "landing" / feed
    folder.mkdir(parents=True, exist_ok=True)
    name = f"part-{len(list(folder.iterdir()))}.json"
    (folder / name).write_text("\n".join(json.dumps(p) for p in pages))


def page(*records, number=1, more=False):
    return {"page": number, "data": list(records), "info": {"more_records": more}}


def run(path, job, run_id, at):
    argv = [job, "--landing", str(path / "landing"), "--store", str(path / "store")]
    return jobs.main([*argv, "--run-id", run_id, "--at", at])


class TestTypedRecords:
    def typed(self, spark, *records):
        df = spark.createDataFrame([(json.dumps(r),) for r in records], "j string")
        return typed_records(df.select(F.try_parse_json("j").alias("r")), "r")

    def test_columns_are_the_union_of_the_fields(self, spark):
        df = self.typed(
            spark,
            {"id": 1, "Owner": {"id": 5, "deep": {"x": 1}}, "tags": ["a"], "$ok": True, "amount": 2.0, "notes": None},
            {"id": 2, "Owner": None, "amount": 2.5, "mixed": 1},
            {"id": 3, "Owner": "plain", "mixed": "w", "it's": 1, 'a "b"': 2},
        )
        kinds = {f.name: f.dataType.simpleString() for f in df.schema}
        assert kinds == {
            "id": "bigint", "Owner": "string", "Owner_id": "bigint", "Owner_deep": "string", "tags": "string",
            "ok": "boolean", "amount": "double", "notes": "string", "mixed": "string", "it's": "bigint",
            'a_"b"': "bigint",
        }
        got = rows(df.select("id", "Owner", "Owner_id", "Owner_deep", "tags", "ok", "amount", "mixed"))
        assert got == [
            (1, None, 5, '{"x":1}', '["a"]', True, 2.0, None),
            (2, None, None, None, None, None, 2.5, "1"),
            (3, "plain", None, None, None, None, None, "w"),
        ]

    def test_fields_whose_names_become_equal(self, spark):
        df = self.typed(spark, {"a.b": 1, "a b": 2}, {"a-b": 3}, {"a b": 4})
        assert rows(df) == [(1,), (3,), (4,)]

    def test_names_that_differ_by_case(self, spark):
        assert rows(self.typed(spark, {"Id": 1}, {"id": "x"})) == [("1",), ("x",)]

    def test_unreadable_name(self, spark):
        with pytest.raises(ValueError):
            self.typed(spark, {"both ' and \"": 1})


def test_variant_pages(spark, tmp_path):
    land(tmp_path, "m", page({"a": 1}, {"b": "x"}, more=True), page(number=2))
    pages = read_variant_pages(spark, str(tmp_path / "landing" / "m"))
    assert feed_complete(pages).first()["complete"] is True
    assert rows(typed_records(variant_records(pages), "record")) == sorted([(1, None), (None, "x")], key=repr)


@pytest.mark.parametrize("more, complete", [(True, False), (False, True)])
def test_pages_without_numbers(spark, tmp_path, more, complete):
    land(tmp_path, "m", {"data": [], "info": {"more_records": True}}, {"data": [], "info": {"more_records": more}})
    pages = read_variant_pages(spark, str(tmp_path / "landing" / "m"))
    assert feed_complete(pages).first()["complete"] is complete


def test_subform_in_text(spark):
    parents = spark.createDataFrame(
        [
            ("1", "[1, 2]", '[{"Site": null, "n": 1}, {"n": 2}]', None),
            ("2", '[{"x": 1}]', None, '[{"Site_Percentage": 5}]'),
            ("3", "[", "[]", None),
        ],
        "id string, a string, b string, c string",
    )
    got = typed_records(subform_elements(parents), "element", ["Parent_Id_id"])
    assert rows(got.select("n", "Site_Percentage", "Parent_Id_id")) == sorted(
        [(1, None, "1"), (2, None, "1"), (None, 5, "2")], key=repr
    )


def test_modules_job(spark, tmp_path):
    at = "2024-05-01T00:00:00Z"
    land(tmp_path, "Deals", page({"id": "1", "Amount": 5, "Owner": {"id": 9}, "Modified_Time": at}))
    land(
        tmp_path, "Blocks",
        page({"id": "b", "Name": "B", "Modified_Time": at, "Splits": [{"id": "s", "Site": "x"}]}),
    )
    land(
        tmp_path, "Revenue_Recognition",
        page({"id": "r", "Amount": 5.0, "Date": "d", "Parent_Id": {"id": "b", "name": "B"}, "Modified_Time": at}),
    )
    first = {r.label: (r.status, r.records) for r in run(tmp_path, "modules", "r0", "2024-05-02T00:00:00")}
    assert first == {
        "Accounts": ("skipped", 0), "Deals": ("synced", 1), "Blocks": ("synced", 1), "Site Splits": ("synced", 1),
        "Revenue Recognition": ("synced", 1), "Stage History": ("skipped", 0),
    }
    later = "2024-05-03T00:00:00Z"
    land(tmp_path, "Accounts", page())
    land(tmp_path, "Deals", page({"id": "1", "Amount": "six", "new field": 1, "Modified_Time": later}))
    land(tmp_path, "Revenue_Recognition", page({"id": "r", "Amount": 7, "Date": "d", "Modified_Time": later}))
    second = {r.label: r.records for r in run(tmp_path, "modules", "r1", "2024-05-04T00:00:00")}
    assert second["Revenue Recognition"] == 1  # the overlap reads the first version again, the newest counts
    assert second["Accounts"] == 0
    store = Store(spark, str(tmp_path / "store"))
    assert store.run_log().count() == 2
    assert rows(store.read("Deals").select("id", "Amount", "new_field")) == [("1", "six", 1)]
    assert rows(store.read("Site_Splits").select("id", "Site", "Parent_Id_name")) == [("s", "x", "B")]
    history = spark.read.parquet(history_path(store))
    assert rows(history.select("revenue_id", "Type", "amount")) == [
        ("r", "Amount changed", "7"), ("r", "Create", "5"),
    ]


def obj(key, links=(), **properties):
    return {
        "id": key, "createdAt": "c", "updatedAt": "u", "properties": properties,
        "associations": {"companies": {"results": [{"id": i} for i in links]}, "deals": {"results": [{"id": i} for i in links]}},
    }


def test_object_jobs(spark, tmp_path):
    at = "2024-05-01T00:00:00Z"
    stages = [{"id": "s", "label": "S", "displayOrder": 0}]
    land(tmp_path, "pipelines", {"results": [{"id": "p", "label": "P", "stages": stages}]})
    land(tmp_path, "owners", {"results": [{"id": "1", "firstName": "A", "lastName": "B"}]})
    land(tmp_path, "owners_archived", {"results": [{"id": "2", "firstName": "C"}]})
    land(tmp_path, "deals", {"results": [obj("d1", ["c1", "c2"], dealname="D", lastmodifieddate=at)]})
    land(tmp_path, "companies", {"results": [obj("c1", name="One", hs_lastmodifieddate=at)]})
    land(tmp_path, "all_companies", {"results": [obj(f"c{i}", name=f"n{i}", hs_lastmodifieddate=at) for i in (1, 2, 3)]})
    land(tmp_path, "line_items", {"results": [obj("l1", ["d1"], amount="1", lastmodifieddate=at)]})
    run(tmp_path, "objects", "r0", "2024-05-02T00:00:00")
    store = Store(spark, str(tmp_path / "store"))
    assert rows(store.read("Companies").select("id", "name")) == [("c1", "One"), ("c2", "n2")]
    assert rows(store.read("Owners").select("id", "fullName", "archived")) == [("1", "A B", False), ("2", "C", True)]
    assert rows(store.read("Line_Items").select("id", "associated_deal_id")) == [("l1", "d1")]
    result = run(tmp_path, "refresh-objects", "r1", "2024-05-03T00:00:00")
    assert [(r.label, r.records) for r in result] == [
        ("pipelines", 1), ("owners", 2), ("deals", 1), ("companies", 2), ("line_items", 1),
    ]


def test_refresh_modules_job(spark, tmp_path):
    land(tmp_path, "Deals", page({"id": "1", "Amount": 5}))
    land(tmp_path, "Blocks", page({"id": "b"}))
    land(tmp_path, "Site_Splits", page({"id": "s", "Parent_Id": {"id": "b"}}))
    land(tmp_path, "Revenue_Recognition", page({"id": "r", "Amount": {"currency": "USD", "value": 5.0}, "Date": "d"}))
    result = run(tmp_path, "refresh-modules", "r0", "2024-05-02T00:00:00")
    assert [(r.label, r.status, r.records) for r in result] == [
        ("Deals", "replaced", 1), ("Blocks", "replaced", 1), ("Site_Splits", "replaced", 1),
        ("Revenue_Recognition", "replaced", 1),
    ]
    store = Store(spark, str(tmp_path / "store"))
    assert rows(store.read("raw_Site_Splits")) == [("b", "s")]
    history = spark.read.parquet(history_path(store))
    assert rows(history.select("revenue_id", "Type", "amount")) == [("r", "Create", "5")]


def test_rows_that_cannot_be_loaded_are_kept_aside(spark, tmp_path):
    at = "2024-05-01T00:00:00Z"
    good = page({"id": "1", "Modified_Time": at}, {"id": None, "Amount": 3, "Modified_Time": at}, {"id": "2", "Modified_Time": "?"})
    land(tmp_path, "Deals", good)
    (tmp_path / "landing" / "Deals" / "part-9.json").write_text("{broken\n")
    land(tmp_path, "modules", {"modules": [{"api_name": "Konten", "plural_label": "Accounts"}]})
    land(tmp_path, "Konten", page({"id": "k", "Modified_Time": at}))
    result = {r.label: r for r in run(tmp_path, "modules", "r0", "2024-05-02T00:00:00")}
    assert (result["Deals"].records, result["Deals"].quarantined) == (3, 1)
    assert result["Accounts"].status == "synced"
    store = Store(spark, str(tmp_path / "store"))
    assert rows(store.read("Deals").select("id")) == [("1",), ("2",)]
    kept = {(r["table_name"], r["reason"], r["run_id"]) for r in store.quarantined().collect()}
    assert kept == {("Deals", "no key", "r0"), ("Deals", "unreadable", "r0")}


def test_a_cut_feed_with_a_broken_line_deletes_nothing(spark, tmp_path):
    records = [{"id": k, "Amount": 5, "Date": "d", "Parent_Id": {"id": "b", "name": "B"}} for k in "abc"]
    for name in ("Deals", "Blocks", "Site_Splits"):
        land(tmp_path, name, page({"id": "1"}))
    land(tmp_path, "Revenue_Recognition", {"data": records, "info": {"more_records": False, "page": 1}})
    run(tmp_path, "refresh-modules", "r0", "2024-05-02T00:00:00")
    folder = tmp_path / "landing" / "Revenue_Recognition"
    (folder / "part-0.json").write_text(json.dumps({"data": records[:1], "info": {"more_records": True}}) + "\n{broken\n")
    result = {r.label: r.status for r in run(tmp_path, "refresh-modules", "r1", "2024-05-03T00:00:00")}
    assert result["Revenue_Recognition"] == "incomplete"
    store = Store(spark, str(tmp_path / "store"))
    assert store.read("raw_Revenue_Recognition").count() == 3
    assert rows(spark.read.parquet(history_path(store)).select("Type").distinct()) == [("Create",)]
