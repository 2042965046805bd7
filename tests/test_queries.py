"""Every registered query against its SQL in DuckDB, and the driver's entry points."""

from __future__ import annotations

import math
from datetime import datetime

import duckdb
import pytest

import __spark_entry__
from tidemark.workloads import all_workloads

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def text(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value.isoformat() if isinstance(value, datetime) else repr(value)


@pytest.mark.parametrize("name", list(all_workloads()))
def test_query(spark, oracle, name):
    df = __spark_entry__.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(tuple(text(row[c]) for c in columns) for row in df.collect())
    result = oracle.execute(__spark_entry__.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    wanted = sorted(tuple(text(row[i]) for i in order) for row in result.fetchall())
    assert got == wanted and got


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "channel"]
    assert df.count() == 1500


def test_every_query_has_its_sql():
    assert all(w.sql for w in all_workloads().values())
    assert set(all_workloads()) <= set(__spark_entry__.queries()) & set(__spark_entry__.oracle_sql())
