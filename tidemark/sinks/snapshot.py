"""A table replaced as a whole, readable at any time."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.times import as_utc
from tidemark.sources.tables import read_if_exists

_POINTERS = "version long, slot long, run_id string, published_at string"


@dataclass(frozen=True)
class Published:
    version: int
    slot: int
    run_id: str


class SnapshotTable:
    """Versions of one table in a few directories, used in turn.

    Parquet cannot be overwritten while it is read, and a new version is made from the
    last one. So each version goes to the next directory, and a one-row append to
    ``published`` makes it current. A run that dies before that leaves the current
    version as it was; the next run overwrites what it left. A reader has until
    ``slots - 1`` further versions before its files are replaced. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, slots: int = 3):
        if slots < 2:
            raise ValueError("a version is written beside the one it is made from")
        self.spark, self.path, self.slots = spark, path.rstrip("/"), slots
        self._published: Published | None = None

    def _pointers(self) -> DataFrame | None:
        return read_if_exists(
            self.spark, f"{self.path}/published", _POINTERS, format="json"
        )

    def current(self) -> Published | None:
        """The version to read: the one this object published, else the newest pointer."""
        if self._published is not None:
            return self._published
        pointers = self._pointers()
        if pointers is None:
            return None
        newest = pointers.agg(F.max(F.struct("version", "slot", "run_id")).alias("p")).first()["p"]
        return None if newest is None else Published(newest.version, newest.slot, newest.run_id)

    def read(self) -> DataFrame | None:
        """The current version, or None before the first."""
        now = self.current()
        return None if now is None else self.spark.read.parquet(self._slot(now.slot))

    def publish(self, df: DataFrame, run_id: str, at: datetime | None = None) -> int:
        """Write the next version and make it current; returns its number.

        A run repeated after a crash publishes again; an upsert of rows already applied
        gives the same table.
        """
        version, slot = self._next()
        df.write.mode("overwrite").parquet(self._slot(slot))
        self._make_current(version, slot, run_id, at)
        return version

    def replace(self, df: DataFrame, run_id: str, at: datetime | None = None) -> int:
        """Publish a new content of the table unless it is empty; returns its rows.

        They are counted in the written files, which costs no second run of ``df``.
        """
        version, slot = self._next()
        df.write.mode("overwrite").parquet(self._slot(slot))
        records = self.spark.read.schema(df.schema).parquet(self._slot(slot)).count()
        if records:
            self._make_current(version, slot, run_id, at)
        return records

    def _next(self) -> tuple[int, int]:
        now = self.current()
        version = 1 if now is None else now.version + 1
        return version, version % self.slots

    def _make_current(self, version: int, slot: int, run_id: str, at: datetime | None) -> None:
        stamp = as_utc(at or datetime.now(timezone.utc)).isoformat()
        row = self.spark.range(1).select(
            F.lit(version).cast("bigint").alias("version"),
            F.lit(slot).cast("bigint").alias("slot"),
            F.lit(run_id).alias("run_id"),
            F.lit(stamp).alias("published_at"),
        )
        row.coalesce(1).write.mode("append").json(f"{self.path}/published")
        self._published = Published(version, slot, run_id)

    def _slot(self, slot: int) -> str:
        return f"{self.path}/slot={slot}"
