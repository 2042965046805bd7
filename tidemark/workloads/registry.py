"""Named queries over the test tables, each with the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Workload:
    run: Run
    sql: str | None


WORKLOADS: dict[str, Workload] = {}


def workload(name: str, sql: str | None) -> Callable[[Run], Run]:
    """Register a query with its SQL."""

    def register(run: Run) -> Run:
        if name in WORKLOADS:
            raise ValueError(f"registered twice: {name}")

        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return run(spark, sf_dir)

        WORKLOADS[name] = Workload(in_utc, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utc(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)
