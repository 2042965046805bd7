from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import quality as Q
from tidemark.operators import watermark as M
from tidemark.plans.modules import next_mark
from tidemark.plans.store import from_micros
from tidemark.workloads.registry import utc

RUN = utc("2024-06-02T00:00:00")
STORED = utc("2024-06-01T12:00:00")


@pytest.fixture
def marks(spark):
    return spark.createDataFrame(
        [("crm", "Deals", STORED, STORED), ("crm", "Blocks", STORED, STORED), ("other", "Deals", STORED, STORED)],
        M.WATERMARK_SCHEMA,
    )


def since(marks, *key):
    row = M.get_watermark(marks, *key, RUN).select(F.unix_micros("stored"), F.unix_micros("since")).first()
    return from_micros(row[0]), from_micros(row[1])


def stored(marks):
    micros = F.unix_micros("last_synced_at").alias("m")
    return {(r["source"], r["module"]): from_micros(r["m"]) for r in marks.select("source", "module", micros).collect()}


def test_stored_mark_is_read_with_its_overlap(marks):
    assert since(marks, "crm", "Deals") == (STORED, STORED - timedelta(minutes=15))


def test_first_run_reaches_back(marks):
    assert since(marks, "crm", "Accounts") == (None, RUN - timedelta(days=3650))


def test_point_lookup(marks):
    assert M.point_lookup(marks, "crm", "Deals").count() == 1
    assert M.point_lookup(marks, "crm", "x").count() == 0


def test_marks_advance_but_never_go_back(marks):
    later, earlier = STORED + timedelta(hours=1), STORED - timedelta(hours=1)
    assert stored(M.set_watermark(marks, "crm", "Deals", later, RUN))[("crm", "Deals")] == later
    after = stored(M.set_watermark(marks, "crm", "Deals", earlier, RUN))
    assert after == stored(marks)
    assert stored(M.set_watermark(marks, "crm", "new", earlier, RUN))[("crm", "new")] == earlier


def test_reset_removes_one_module(marks):
    assert set(stored(M.reset_watermark(marks, "Deals"))) == {("crm", "Blocks")}
    assert set(stored(M.reset_watermark(marks, "Deals", "other"))) == {("crm", "Deals"), ("crm", "Blocks")}


def test_new_watermark_ignores_bad_text_and_keeps_the_start(spark):
    df = spark.createDataFrame(
        [("2024-06-03T00:00:00Z", None), ("", "2024-06-04T00:00:00+01:00"), ("bad", "2030-01-01T00:00:00Z")],
        "lastmodifieddate string, hs_lastmodifieddate string",
    )

    def newest(start):
        found = M.new_watermark(df, start, "lastmodifieddate", "hs_lastmodifieddate")
        return from_micros(found.select(F.unix_micros("new_watermark")).first()[0])

    assert newest(STORED) == utc("2024-06-03T23:00:00")
    assert newest(utc("2025-01-01T00:00:00")) == utc("2025-01-01T00:00:00")


@pytest.mark.parametrize(
    "stored_at, observed, count, held, moved",
    [
        (1, 5, 3, 5, 5),  # something newer
        (5, 1, 3, 5, 9),  # nothing newer
        (5, None, 0, 5, 9),  # idle
        (5, 7, 0, 5, 9),  # no rows: what was observed does not count
        (None, 5, 3, 5, 5),  # first run
        (12, 3, 1, 12, 12),  # a mark ahead of the clock stays
    ],
)
def test_policies(spark, stored_at, observed, count, held, moved):
    def hour(h):
        return None if h is None else utc("2024-06-01T00:00:00") + timedelta(hours=h)

    def literal(h):
        return F.lit(None if h is None else f"2024-06-01 {h:02}:00:00Z").cast("timestamp")

    for policy, wanted in (("hold", held), ("now", moved)):
        column = M.advance(literal(stored_at), literal(observed), F.lit(count), literal(9), policy)
        assert from_micros(spark.range(1).select(F.unix_micros(column)).first()[0]) == hour(wanted)
        if stored_at is not None:
            got = next_mark(hour(stored_at), hour(0), hour(observed), count, hour(9), policy)
            assert got == hour(wanted)


def test_checks(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, name string")
    assert Q.row_count(df).first()[0] == 2
    assert tuple(Q.check_min_rows(df, "t", 3).first()) == ("t", 2, 3, False)
    assert rows(Q.check_columns(df, ["name", "bidding"])) == [("bidding", False, 0, 2), ("name", True, 1, 2)]
    assert tuple(Q.check_loaded(df.limit(1), df).first()) == (2, 1, False)


def test_run_totals(spark):
    counts = spark.createDataFrame([("a", 2), ("b", 3), ("a", 1)], "module string, records int")
    assert rows(Q.run_totals(counts)) == sorted([("a", 3), ("b", 3), (None, 6)], key=repr)


def test_run_log_rows(spark):
    end = RUN + timedelta(seconds=2.5)
    row = Q.run_log_row(spark, "crm", "FAILED", 7, RUN, end, error="boom")
    assert row.schema == Q.RUN_LOG_SCHEMA or row.schema.names == Q.RUN_LOG_SCHEMA.names
    assert [f.dataType for f in row.schema] == [f.dataType for f in Q.RUN_LOG_SCHEMA]
    assert row.first()[:6] == ("crm", "FAILED", 7, 0, 2.5, "boom")
    refresh = Q.full_refresh_log_row(spark, "SUCCESS", 7, RUN, end).first()
    assert tuple(refresh) == ("2024-06-02 05:30:00", 2.5, "SUCCESS", 0, 7, "")


def test_from_micros():
    assert from_micros(None) is None
    assert from_micros(-1) == datetime(1969, 12, 31, 23, 59, 59, 999999, tzinfo=timezone.utc)
