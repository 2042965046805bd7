"""Newline-delimited JSON with a budget of unreadable lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.session import materialize

# Fixed value: unreadable lines tolerated in one load.
MAX_BAD_RECORDS = 10
BAD = "_corrupt_record"


class BadRecordBudgetExceeded(ValueError):
    """More unreadable lines than a load tolerates."""


def stage_ndjson(
    spark: SparkSession, path: str, staging: str, schema: T.StructType | None = None
) -> DataFrame:
    """Read once, keep unreadable lines aside in a text column, write to staging.

    Without a schema Spark infers one, which reads the files one more time. Fields the
    schema does not name are ignored.
    """
    reader = spark.read.option("columnNameOfCorruptRecord", BAD).option("mode", "PERMISSIVE")
    if schema is None:
        schema = reader.json(path).schema
    if BAD not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    return materialize(reader.schema(schema).json(path), staging)


def load_ndjson(
    spark: SparkSession,
    path: str,
    staging: str,
    schema: T.StructType | None = None,
    *,
    max_bad: int = MAX_BAD_RECORDS,
) -> DataFrame:
    """The readable records; fails when more lines are unreadable than tolerated.

    The bad lines are counted in the written staging table, where the filter and the
    single column reach the scan, so the JSON text is parsed once.
    """
    staged = stage_ndjson(spark, path, staging, schema)
    bad = staged.filter(F.col(BAD).isNotNull()).agg(F.count(F.lit(1)).alias("n")).first()["n"]
    if bad > max_bad:
        raise BadRecordBudgetExceeded(f"{bad} unreadable lines, {max_bad} tolerated: {path}")
    return staged.filter(F.col(BAD).isNull()).drop(BAD)
