"""Where a job may write its intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOT: str | None = None


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting (a test) gets a temporary folder of
    its own; on a cluster a machine-local folder would be lost with its executor.
    """
    global _LOCAL_ROOT
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _LOCAL_ROOT is None:
        _LOCAL_ROOT = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL_ROOT


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused, so never overwritten."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once and continue from the written table.

    Cuts the lineage and lets several consumers read the same rows, also when an
    executor is lost in between.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_in(spark: SparkSession, name: str):
    """A ``DataFrame -> DataFrame`` that materializes below a fresh scratch path."""
    return lambda df: materialize(df, scratch(spark, name))
