from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F, types as T

from tidemark.functions import text, times
from tidemark.functions.arrays import association_ids, first_association, split_ids


def values(spark, column, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


def test_float_text_is_the_shortest_form(spark):
    rnd = random.Random(1)
    numbers = [rnd.uniform(-1, 1) * 10 ** rnd.randint(-6, 15) for _ in range(2000)]
    numbers += [0.0, -0.0, 1e7, 9999999.0, 1e15, 1e16, 1e-3, 1e-4, 1e-5, 1.5e-10, 1e100, 1e-300]
    numbers += [float("inf"), float("-inf"), float("nan")]
    assert values(spark, text.float_text, numbers, "double") == [repr(n) for n in numbers]


def test_canonical_amount(spark):
    given = ["5000.0", " 5000 ", "", "  ", None, "10000000.0", "5000.50", ".0", "5.00"]
    assert values(spark, text.canonical_amount, given) == [
        "5000", "5000", None, None, None, "10000000", "5000.50", None, "5.00",
    ]


def test_strip_takes_all_white_space(spark):
    assert values(spark, text.strip, ["  a b\x1f\n", "　"]) == ["a b", ""]


@pytest.mark.parametrize(
    "first, last, joined, strict",
    [
        ("Ann", "Lee", "Ann Lee", "Ann Lee"), ("Ann", None, "Ann", None), (None, "Lee", "Lee", None),
        ("", "", None, None), (None, None, None, None), ("Ann", "", "Ann", None),
    ],
)
def test_full_name(spark, first, last, joined, strict):
    df = spark.createDataFrame([(first, last)], "f string, l string")
    row = df.select(
        text.full_name(F.col("f"), F.col("l")), text.full_name(F.col("f"), F.col("l"), strict=True)
    ).first()
    assert tuple(row) == (joined, strict)


def test_null_tokens_and_first_nonempty(spark):
    assert values(spark, text.null_if_token, ["nan", "None", "<NA>", "", "x", None]) == [None] * 4 + ["x", None]
    assert values(spark, lambda c: text.first_nonempty(c, F.lit("y")), ["", None, "x"]) == ["y", "y", "x"]


def test_norm_label(spark):
    assert values(spark, text.norm_label, ["Site_ Splits", None]) == ["sitesplits", ""]


def test_association_lists(spark):
    df = spark.sql(
        """SELECT array(named_struct('id', '9'), named_struct('id', '10'), named_struct('id', '9'),
                        named_struct('id', ''), named_struct('id', cast(null as string))) AS a,
                  cast(array() AS array<struct<id: string>>) AS e,
                  cast(null AS array<struct<id: string>>) AS n"""
    )
    got = df.select(*[f(F.col(c)) for c in "aen" for f in (association_ids, first_association)]).first()
    assert tuple(got) == ("10,9", "9", None, None, None, None)


def test_split_ids(spark):
    assert values(spark, split_ids, ["a, b,,c", "", None, " , "]) == [["a", "b", "c"], [], None, []]


def utc(*parts):
    return datetime(*parts, tzinfo=timezone.utc)


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("2024-06-01T12:00:00Z", utc(2024, 6, 1, 12)),
        ("2024-06-01T12:00:00.123+05:30", utc(2024, 6, 1, 6, 30, 0, 123000)),
        ("2024-06-01T12:00:00+0530", utc(2024, 6, 1, 6, 30)),
        ("2024-06-01 12:00", utc(2024, 6, 1, 12)),
        ("2024-06-01T12:00+05", utc(2024, 6, 1, 7)),
        ("2024-06-01T12:00-05:30", utc(2024, 6, 1, 17, 30)),
        ("2024-06-01", utc(2024, 6, 1)),
        ("2024", None), ("12:00", None), ("today", None), ("2024-13-01T00:00:00Z", None), ("", None),
        (None, None),
    ],
)
def test_parse_iso_ts(spark, given, wanted):
    micros = values(spark, lambda c: F.unix_micros(times.parse_iso_ts(c)), [given])[0]
    assert micros == (None if wanted is None else round(wanted.timestamp() * 1e6))


def test_time_texts(spark):
    ts = F.lit("2024-06-01 20:00:00.5Z").cast("timestamp")
    row = spark.range(1).select(
        times.rfc1123(ts), times.offset_time(ts), times.epoch_millis(ts),
        times.elapsed_seconds(ts, ts + F.make_dt_interval(secs=F.lit(1.25))),
    ).first()
    assert tuple(row) == ("Sat, 01 Jun 2024 20:00:00 +0000", "2024-06-02 01:30:00", 1717272000500, 1.25)


def test_time_literal_takes_any_zone(spark):
    local = datetime(2024, 6, 1, 17, 30, tzinfo=timezone(timedelta(hours=5, minutes=30)))
    for kind in (T.TimestampType(), T.TimestampNTZType()):
        literal = times.time_literal(local, kind)
        assert spark.range(1).select(literal.cast("string")).first()[0] == "2024-06-01 12:00:00"
    with pytest.raises(TypeError):
        times.time_literal(local, T.LongType())
