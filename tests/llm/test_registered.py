"""Registered queries against their SQL in DuckDB, and the pipeline against its operators' brute-force versions."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from tidemark.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(repr(r[c]) for c in columns) for r in df.collect())
    result = con.execute(queries.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert got == sorted(tuple(repr(r[names.index(c)]) for c in columns) for r in result.fetchall())


def test_all_are_registered():
    names = set(__spark_entry__.queries())
    assert {f"op{n}_" for n in range(1, 14)} <= {x.split("_")[0] + "_" for x in names if x.startswith("op")}
    assert "pipeline" in names and set(queries.ORACLES) <= set(__spark_entry__.oracle_sql())
