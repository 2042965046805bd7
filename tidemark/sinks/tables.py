"""Write modes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.sources.tables import read_if_exists

# Tables that grow with each load; every other table is replaced.
APPENDED_TABLES = frozenset({"etl_logs", "revenue_history"})


def overwrite(df: DataFrame, path: str) -> None:
    """Truncate and load. ``df`` must not read the same path."""
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append_missing(df: DataFrame, path: str, key: str, within: Column | None = None) -> None:
    """Append the rows whose key the table does not have yet, so that a repeated run
    adds nothing. ``within`` narrows the part of the table that can hold them, such as
    the rows of this run's time stamp, and is filtered inside the scan."""
    there = read_if_exists(df.sparkSession, path)
    if there is not None:
        there = there if within is None else there.filter(within)
        df = df.join(there.select(key), key, "left_anti").select(df.columns)
    append(df, path)


def route(df: DataFrame, root: str, table: str, appended=APPENDED_TABLES) -> str | None:
    """Append to a log table, replace any other; an empty input changes nothing."""
    if df.isEmpty():
        return None
    mode = "append" if table in appended else "overwrite"
    df.write.mode(mode).parquet(f"{root}/{table}")
    return mode


def create_from_staging(staging: DataFrame, path: str) -> None:
    """First load of a target; fails where the target is already there."""
    staging.write.mode("errorifexists").parquet(path)


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def ensure_table(
    spark: SparkSession, table: str, schema: T.StructType, partition_by: Sequence[str] = ()
) -> None:
    """Create a typed catalog table when it is absent."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
        for f in schema.fields
    )
    split = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{split}")


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int) -> None:
    """A catalog table hashed and sorted by key: joins on the key read it in place."""
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(table)
    )


def merge_into(delta: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Upsert in place, for a table format that takes MERGE. The delta holds each key once."""
    match = None
    for k in keys:
        same = F.col(f"{table}.{k}") == delta[k]
        match = same if match is None else match & same
    delta.mergeInto(table, match).whenMatched().updateAll().whenNotMatched().insertAll().merge()
