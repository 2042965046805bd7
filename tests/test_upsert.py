from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tidemark.operators.union import (
    align_types,
    common_type,
    missing_labels,
    tagged_passes,
    union_evolving,
)
from tidemark.operators.upsert import dedupe_keep_last, keep_last, upsert
from tidemark.session import materialize

SCHEMA = "id string, v int, seq int"
ORDER = ["seq"]


def frame(spark, *records, schema=SCHEMA):
    return spark.createDataFrame(list(records), schema)


def test_new_replaced_and_untouched_rows(spark):
    target = frame(spark, ("a", 1, 1), ("b", 2, 1))
    delta = frame(spark, ("b", 9, 2), ("c", 3, 1))
    assert rows(upsert(target, delta)) == [("a", 1, 1), ("b", 9, 2), ("c", 3, 1)]


def test_rows_are_replaced_whole(spark):
    target = frame(spark, ("a", 1, 1))
    delta = frame(spark, ("a", None, 2))
    assert rows(upsert(target, delta)) == [("a", None, 2)]


def test_new_column_is_null_on_old_rows(spark):
    target = frame(spark, ("a", 1, 1), ("b", 1, 1))
    delta = spark.createDataFrame([("b", "x")], "id string, extra string")
    assert rows(upsert(target, delta)) == [("a", 1, 1, None), ("b", None, None, "x")]


def test_conflicting_types_become_text(spark):
    target = spark.createDataFrame([(1, 5), (2, 6)], "id bigint, v bigint")
    delta = spark.createDataFrame([("2", "six")], "id string, v string")
    assert rows(upsert(target, delta)) == [("1", "5"), ("2", "six")]


def test_null_keys_are_left_out(spark):
    target = frame(spark, ("a", 1, 1))
    delta = frame(spark, (None, 5, 1), ("b", 2, 1))
    assert rows(upsert(target, delta)) == [("a", 1, 1), ("b", 2, 1)]


def test_last_delta_row_of_a_key_wins(spark):
    delta = frame(spark, ("a", 1, 1), ("a", 2, 3), ("a", 3, 2))
    assert rows(upsert(frame(spark), delta, order=ORDER)) == [("a", 2, 3)]
    assert rows(upsert(None, delta, order=ORDER)) == [("a", 2, 3)]


def test_delta_without_order_still_gives_one_row_per_key(spark):
    delta = frame(spark, ("a", 1, 1), ("a", 2, 1), ("a", 2, 1))
    assert upsert(frame(spark), delta).count() == upsert(None, delta).count() == 1


def test_empty_delta_changes_nothing(spark):
    target = frame(spark, ("a", 1, 1))
    assert rows(upsert(target, frame(spark))) == [("a", 1, 1)]


def test_composite_key(spark):
    target = frame(spark, ("a", 1, 1), ("a", 2, 1))
    assert rows(upsert(target, frame(spark, ("a", 2, 9)), ["id", "v"])) == [("a", 1, 1), ("a", 2, 9)]


def test_foreign_target_is_deduped_on_request(spark):
    target = frame(spark, ("a", 1, 1), ("a", 1, 1), ("b", 1, 1))
    assert upsert(target, frame(spark, ("c", 1, 1)), dedupe_target=True).count() == 3


def test_dedupe_prefers_the_newer_table(spark):
    older, newer = frame(spark, ("a", 1, 9), ("b", 1, 1)), frame(spark, ("a", 2, 1), ("a", 3, 2))
    assert rows(dedupe_keep_last(older, newer, ["id"], ORDER)) == [("a", 3, 2), ("b", 1, 1)]


def test_target_is_neither_shuffled_nor_sorted(spark, path):
    """A small staged delta is broadcast; Spark decides by its size, no hint forces it."""
    target = spark.range(100000).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("v"))
    delta = materialize(frame(spark, ("a", 1, 1)), path + "/delta")
    text = plan(upsert(target, delta))
    assert "BroadcastHashJoin LeftAnti" in text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin LeftAnti" in plan(upsert(target, delta))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


records = st.lists(
    st.tuples(st.sampled_from("abcdef"), st.integers(0, 5), st.integers(0, 50)), max_size=8, unique_by=lambda r: (r[0], r[2])
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(first=records, second=records)
def test_upsert_properties(spark, first, second):
    target = upsert(None, frame(spark, *first), order=ORDER)
    delta = frame(spark, *second)
    once = upsert(target, delta, order=ORDER)
    got = rows(once)
    newest = {}
    for r in sorted(first, key=lambda r: r[2]):
        newest[r[0]] = r
    for r in sorted(second, key=lambda r: r[2]):
        newest[r[0]] = r
    assert got == sorted(newest.values(), key=repr)
    assert rows(upsert(once, delta, order=ORDER)) == got
    assert rows(upsert(target.repartition(3), delta.repartition(5), order=ORDER)) == got


def test_keep_last_puts_null_order_values_first(spark):
    assert rows(keep_last(frame(spark, ("a", 1, None), ("a", 2, 0)), ["id"], ORDER)) == [("a", 2, 0)]


def test_union_evolving(spark):
    left = spark.sql("SELECT 1 AS a, 2.5D AS b, named_struct('x', 1) AS c")
    right = spark.sql("SELECT 5000000000 AS a, 'two' AS b, 'text' AS c, true AS d")
    assert rows(union_evolving(left, right)) == [
        (1, "2.5", '{"x":1}', None), (5000000000, "two", "text", True),
    ]


def test_common_types(spark):
    fields = {f.name: f.dataType for f in spark.sql(
        "SELECT 1 AS i, 1L AS l, 1.0F AS f, 1.0D AS d, 'x' AS s, true AS b, null AS n"
    ).schema}
    pairs = {"il": "bigint", "fd": "double", "id": "double", "bi": "string", "ns": "string", "ln": "bigint", "ld": "double", "if": "double"}
    for pair, wanted in pairs.items():
        assert common_type(fields[pair[0]], fields[pair[1]]).simpleString() == wanted


def test_align_leaves_equal_types_alone(spark):
    left, right = frame(spark, ("a", 1, 1)), frame(spark, ("b", 1, 1))
    assert [d.schema for d in align_types(left, right)] == [left.schema, right.schema]


def test_tagged_passes_and_missing_labels(spark):
    active = spark.createDataFrame([(1, "x")], "id int, more string")
    archived = spark.createDataFrame([(2,)], "id int")
    assert rows(tagged_passes(active, archived)) == [(1, "x", False), (2, None, True)]
    wanted = spark.createDataFrame([("a",), ("a",), ("b",)], "label string")
    assert rows(missing_labels(wanted, wanted.filter("label = 'b'"))) == [("a",)]


@pytest.mark.parametrize("hot", [0.0, 0.5])
def test_hot_key_in_the_delta(spark, hot):
    delta = spark.range(20000).select(
        F.when(F.rand(1) < hot, "hot").otherwise((F.col("id") % 500).cast("string")).alias("id"),
        F.lit(1).alias("v"),
        F.col("id").cast("int").alias("seq"),
    )
    merged = upsert(frame(spark, ("hot", 0, 0), ("x", 0, 0)), delta, order=ORDER)
    assert merged.groupBy("id").count().filter("count > 1").count() == 0
