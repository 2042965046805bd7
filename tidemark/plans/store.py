"""Where a sync keeps its tables."""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.times import as_utc
from tidemark.operators.upsert import upsert
from tidemark.operators.watermark import WATERMARK_SCHEMA, get_watermark
from tidemark.session import materialize
from tidemark.sinks.commits import Commits, Entry
from tidemark.sinks.merged import MergedTable
from tidemark.sinks.partitioned import BUCKETS, PartitionedTable, conformed
from tidemark.sinks.snapshot import SnapshotTable
from tidemark.sinks.tables import append
from tidemark.sources.tables import read_if_exists

logger = logging.getLogger(__name__)

MARK_LOG = "source string, module string, last_synced_at long, updated_at long, run_id string, seq long"

Mark = tuple[datetime | None, datetime]


@dataclass(frozen=True)
class Store:
    """Targets, staging tables, watermarks and run log below one shared path.

    One store writes at a time; it remembers which version of a table it made current, and
    its threads may load different tables at once.
    """

    spark: SparkSession
    root: str
    _tables: dict[str, SnapshotTable] = field(default_factory=dict, repr=False)
    _commits: list[Commits] = field(default_factory=list, repr=False)
    _lock: threading.RLock = field(default_factory=threading.RLock, repr=False, compare=False)

    @property
    def commits(self) -> Commits:
        """The commits of all tables of the store that are merged on read."""
        with self._lock:
            if not self._commits:
                self._commits.append(Commits(self.spark, f"{self.root}/meta/commits"))
            return self._commits[0]

    def target(self, name: str) -> SnapshotTable:
        return self._snapshot(f"target/{name}")

    def _snapshot(self, path: str) -> SnapshotTable:
        if path not in self._tables:
            self._tables[path] = SnapshotTable(self.spark, f"{self.root}/{path}")
        return self._tables[path]

    def read(self, name: str) -> DataFrame | None:
        """A target in whichever layout it has, None before its first load."""
        for read in (self.target(name).read, self.merged(name).read, self.partitioned(name).read):
            if (found := read()) is not None:
                return found
        return None

    def partitioned(self, name: str) -> PartitionedTable:
        return PartitionedTable(self.spark, f"{self.root}/partitioned/{name}")

    def merged(self, name: str, keys: Sequence[str] = (), buckets: int = BUCKETS) -> MergedTable:
        """A target merged on read: of each key the newest row counts, in whatever order rows come."""
        return MergedTable(
            self.spark, f"{self.root}/merged/{name}", keys, buckets, newest=True, commits=self.commits, name=f"target/{name}"
        )

    def has_rows(self, name: str, least: int) -> bool:
        """Do the commits alone tell that a target has so many rows?"""
        return self.merged(name).at_least() >= least

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """A run's rows of one table, written once and then read by every step. The next
        run replaces them."""
        return materialize(df, f"{self.root}/staging/{name}")

    def stage_upsert(
        self,
        name: str,
        staged: DataFrame,
        keys: list[str],
        order: list[Column],
        run_id: str,
        partition_by: Column | int | None = None,
    ) -> list[Entry]:
        """Write staged rows to a target. With a number of buckets they go to a delta that
        counts once the returned entries are committed. With an expression only the
        partitions they fall into are rewritten, else a new version of the whole is written;
        these count at once. A table stays in the layout it was begun in."""
        merged, target = self.merged(name, keys, partition_by if isinstance(partition_by, int) else BUCKETS), self.target(name)
        if not merged.exists():
            stored = target.read()
            begun = partition_by is not None and stored is None
            if begun and (isinstance(partition_by, Column) or self.partitioned(name).read() is not None):
                self.partitioned(name).upsert(staged, keys, partition_by, order)
                return []
            if not begun:
                staged = staged if stored is None else conformed(staged, stored.schema)
                target.publish(upsert(stored, staged, keys, order), run_id)
                return []
        entry = merged.stage(staged, order or [F.lit(None).cast("timestamp")])
        return [] if entry is None else [entry]

    def upsert(
        self,
        name: str,
        staged: DataFrame,
        keys: list[str],
        order: list[Column],
        run_id: str,
        partition_by: Column | int | None = None,
    ) -> None:
        """:meth:`stage_upsert` in a commit of its own."""
        self.commits.commit(f"{run_id}/{name}", self.stage_upsert(name, staged, keys, order, run_id, partition_by))
        self.merged(name).tend()

    # Rows that cannot be loaded

    def quarantine(self, rows: DataFrame, name: str, reason: str, run_id: str) -> int:
        """Keep rows aside as JSON text with their table, reason and run; returns how many.

        A repeated run writes its own rows again, in place of the first ones.
        """
        kept = rows.select(
            F.lit(name).alias("table_name"), F.lit(reason).alias("reason"), F.lit(run_id).alias("run_id"),
            F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row"),
        )
        path = f"{self.root}/quarantine/{name}/{reason.replace(' ', '-')}/{run_id}"
        return materialize(kept, path).count()

    def quarantined(self) -> DataFrame | None:
        schema = "table_name string, reason string, run_id string, row string"
        there = read_if_exists(self.spark, f"{self.root}/quarantine/*/*/*", schema)
        return there

    # Watermarks

    def watermarks(self) -> DataFrame:
        """The stored marks: of each module the highest one appended since its last reset."""
        log = read_if_exists(self.spark, self._mark_log, MARK_LOG, format="json")
        if log is None:
            return self.spark.createDataFrame([], WATERMARK_SCHEMA)
        resets = log.filter("source is null").groupBy("module").agg(F.max("seq").alias("reset"))
        since = log.filter("source is not null").join(resets, "module", "left").filter("reset is null or seq > reset")
        newest = since.groupBy("source", "module").agg(
            F.max("last_synced_at").alias("last_synced_at"), F.max("updated_at").alias("updated_at")
        )
        return newest.select("source", "module", *[F.timestamp_micros(c).alias(c) for c in ("last_synced_at", "updated_at")])

    def marks(
        self, source: str, modules: Sequence[str], run_ts: datetime, lookback: timedelta | None = None
    ) -> dict[str, Mark]:
        """Each module's stored mark, if any, and the time to read its delta from; one
        small job for all of them. Without a ``lookback`` a first run reads everything."""
        logger.info("first runs read %s", "everything" if lookback is None else f"the last {lookback}")
        marks = self.watermarks()
        found = reduce(
            DataFrame.unionByName,
            [
                get_watermark(marks, source, module, run_ts, lookback=lookback).select(
                    F.lit(module).alias("module"),
                    F.unix_micros("stored").alias("stored"),
                    F.unix_micros("since").alias("since"),
                )
                for module in modules
            ],
        )
        return {
            row["module"]: (from_micros(row["stored"]), from_micros(row["since"]))
            for row in found.collect()
        }

    def advance(self, source: str, module: str, value: datetime, run_ts: datetime, run_id: str) -> None:
        """Append a mark; as the highest counts, none moves back."""
        self._append_mark(source, module, value, run_ts, run_id)

    def reset(self, module: str, run_id: str) -> None:
        """Forget a module's marks: its next run starts anew."""
        self._append_mark(None, module, None, datetime.now(timezone.utc), run_id)

    def _append_mark(
        self, source: str | None, module: str, value: datetime | None, run_ts: datetime, run_id: str
    ) -> None:
        row = self.spark.range(1).select(
            F.lit(source).cast("string").alias("source"),
            F.lit(module).alias("module"),
            F.lit(to_micros(value)).cast("bigint").alias("last_synced_at"),
            F.lit(to_micros(run_ts)).cast("bigint").alias("updated_at"),
            F.lit(run_id).alias("run_id"),
            F.lit(time.time_ns()).cast("bigint").alias("seq"),
        )
        with self._lock:  # two writers into one folder would clear each other's attempts away
            row.coalesce(1).write.mode("append").json(self._mark_log)

    @property
    def _mark_log(self) -> str:
        return f"{self.root}/meta/marks"

    # Run log

    def log(self, row: DataFrame) -> None:
        append(row.coalesce(1), f"{self.root}/meta/load_log")

    def run_log(self) -> DataFrame | None:
        return read_if_exists(self.spark, f"{self.root}/meta/load_log")


def to_micros(value: datetime | None) -> int | None:
    if value is None:
        return None
    return (as_utc(value) - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


def from_micros(micros: int | None) -> datetime | None:
    """Aware UTC datetime, whatever the time zone of the driver."""
    if micros is None:
        return None
    seconds, rest = divmod(micros, 1_000_000)
    return as_utc(datetime.fromtimestamp(seconds, timezone.utc).replace(microsecond=rest))
