"""Commits: files of one or more tables become visible by the one row that names them."""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.sources.tables import read_if_exists

ENTRY = "struct<table: string, kind: string, v: string, parts: array<struct<part: int, rows: bigint>>, facts: string>"
COMMIT = f"version long, txn string, entries array<{ENTRY}>"

#: Partition column of a written folder; its text sorts as the versions do.
V = "__v"


@dataclass(frozen=True)
class Entry:
    """What a commit adds to a table: a folder written under ``v``, its rows by part."""

    table: str
    kind: str
    v: str
    parts: tuple[tuple[int, int], ...] = ()
    facts: str = ""

    @property
    def rows(self) -> int:
        return sum(n for _, n in self.parts)


@dataclass
class Commits:
    """The commits of a group of tables, a JSON line each.

    Data are written first, to folders of names never used again, and count from the
    moment the commit that names them is there. What a dead run has written is named by
    none. So a run that writes several tables changes all of them or none, and nothing
    has to be searched to find out whether a row is there already. One writer at a time,
    whose threads may commit different tables: it remembers the commits it has read and
    made. The driver holds a line for each commit since the last :meth:`begin_anew`.
    """

    spark: SparkSession
    path: str
    _known: list[tuple[int, str, tuple[Entry, ...]]] | None = field(default=None, repr=False)
    _lock: threading.RLock = field(default_factory=threading.RLock, repr=False, compare=False)

    def all(self) -> list[tuple[int, str, tuple[Entry, ...]]]:
        with self._lock:
            if self._known is None:
                log = read_if_exists(self.spark, self.path, COMMIT, format="json")
                rows = [] if log is None else log.collect()
                read = [(r["version"], r["txn"], tuple(map(_entry, r["entries"]))) for r in rows]
                read.sort(key=lambda c: c[0])
                # A line that holds everything before it replaces it.
                whole = max((i for i, c in enumerate(read) if c[1] == WHOLE), default=0)
                self._known = read[whole:]
            return list(self._known)

    def entries(self, table: str) -> list[Entry]:
        """A table's entries in the order of their commits."""
        return [e for _, _, entries in self.all() for e in entries if e.table == table]

    def made(self, txn: str) -> bool:
        return any(t == txn for _, t, _ in self.all())

    def next_v(self, rank: str = "a") -> str:
        """The name of the folders of the next commit; a repetition after a crash gets another.

        Of two folders of one commit that of the later ``rank`` counts as the newer.
        """
        return f"{self._next():012d}{rank}-{uuid.uuid4().hex[:8]}"

    def _next(self) -> int:
        return 1 + max((version for version, _, _ in self.all()), default=0)

    def commit(self, txn: str, entries: Iterable[Entry | None]) -> int | None:
        """Make the entries visible at once; without any, nothing happens."""
        entries = tuple(e for e in entries if e is not None)
        if not entries:
            return None
        return self._append(txn, entries)

    def _append(self, txn: str, entries: tuple[Entry, ...]) -> int:
        with self._lock:
            version = self._next()
            rows = [(version, txn, [(e.table, e.kind, e.v, list(e.parts), e.facts) for e in entries])]
            self.spark.createDataFrame(rows, COMMIT).coalesce(1).write.mode("append").json(self.path)
            self._known = [*self.all(), (version, txn, entries)]
            return version

    def begin_anew(self, live: Iterable[Entry]) -> None:
        """Note all that counts in one line, so that the lines before it need not be read again."""
        with self._lock:
            self._append(WHOLE, tuple(live))
            self._known = self.all()[-1:]


#: The transaction of a line that holds everything before it.
WHOLE = "(all before)"


def _entry(row: T.Row) -> Entry:
    return Entry(row["table"], row["kind"], row["v"], tuple((p["part"], p["rows"]) for p in row["parts"]), row["facts"] or "")


class CommittedLog:
    """A table that grows by appended rows, each append counted exactly once.

    A run that is repeated, after a crash or not, finds its transaction made and adds
    nothing; one that died before its commit left files that no reader sees. No stored row
    is read to append. ``by`` names derived partition columns, such as the month.
    """

    def __init__(self, spark: SparkSession, path: str, commits: Commits, name: str, by: dict[str, Column] | None = None):
        self.spark, self.path, self.commits, self.name = spark, path.rstrip("/"), commits, name
        self.by = by or {}

    def stage(self, df: DataFrame, *, rows: int | None = None) -> Entry | None:
        """Write rows that count once the entry is committed; None if there are none.

        They are counted in the written files unless the caller knows how many they are.
        """
        v = self.commits.next_v()
        dealt = df.withColumns({**self.by, V: F.lit(v)})
        dealt.write.mode("append").partitionBy(*self.by, V).parquet(self.path)
        if rows is None:
            rows = self.written(v, df.schema).count()
        return Entry(self.name, "log", v, ((0, rows),), df.schema.json()) if rows else None

    def written(self, v: str, schema: T.StructType) -> DataFrame:
        """The rows written under ``v``, committed or not."""
        folder = self.path + "/*" * len(self.by) + f"/{V}={v}"
        found = read_if_exists(self.spark, folder, schema)
        return self.spark.createDataFrame([], schema) if found is None else found

    def append(self, df: DataFrame, txn: str) -> bool:
        """Append in a commit of its own; False if the transaction was made before."""
        if self.commits.made(txn):
            return False
        return self.commits.commit(txn, [self.stage(df)]) is not None

    def read(self) -> DataFrame | None:
        """The committed rows, without the partition columns; None before the first."""
        live = self.commits.entries(self.name)
        if not live:
            return None
        schema = T.StructType.fromJson(json.loads(live[-1].facts))
        typed = T.StructType([*schema.fields, *[T.StructField(c, T.StringType()) for c in (*self.by, V)]])
        stored = read_if_exists(self.spark, self.path, typed)
        # Only a partition column is compared: folders of dead runs are not opened.
        return stored.filter(F.col(V).isin([e.v for e in live])).select(*[f"`{f.name}`" for f in schema.fields])


def live_of(commits: Commits, tables: Sequence) -> list[Entry]:
    """The entries of the given tables that still count."""
    return [e for table in tables for e in (table.live() if hasattr(table, "live") else commits.entries(table.name))]
