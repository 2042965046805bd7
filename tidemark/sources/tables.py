"""Tables that are already columnar."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T

# Error conditions of a path that holds no table: nothing there, or a folder without
# data files, as a first write that died leaves it.
ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def scan_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_if_exists(
    spark: SparkSession, path: str, schema: T.StructType | None = None, *, format: str = "parquet", **options: str
) -> DataFrame | None:
    """The table at a path, or None when there is none; any other failure is raised."""
    reader = spark.read.format(format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as e:
        if e.getCondition() in ABSENT:
            return None
        raise
