"""Which files of a landing were loaded, and which pages they held."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sinks.commits import CommittedLog, Commits, Entry
from tidemark.sources.tables import read_if_exists

FILE = "path string, length long, modified timestamp, run_id string, closes boolean, observed long, at long, forgotten boolean"
PAGE = "page long, more boolean, records long, unreadable long, at long"


@dataclass(frozen=True)
class Arrived:
    """What a run took from a feed: entries for its commit, whether the feed has reached
    its end, and the newest time seen since it last did, in microseconds."""

    entries: tuple[Entry, ...]
    complete: bool
    observed: int | None


class Arrivals:
    """The ledger of one feed: a row for each file and each page that a run has loaded.

    A file is known by its path, length and time of change, so a run reads new files only
    and a file that was written anew is read again. Rows count with the commit that loads
    the files' records, so each file is loaded exactly once, in whatever order pages come.
    A fetch may stretch over several runs: its pages are looked at together until its last
    page has come and none before it is missing. The driver sees the names of new files.
    """

    def __init__(self, spark: SparkSession, folder: str, path: str, commits: Commits, feed: str):
        self.spark, self.folder, self.commits, self.feed = spark, folder, commits, feed
        self.files = CommittedLog(spark, f"{path}/files", commits, f"arrivals/{feed}")
        self.pages = CommittedLog(spark, f"{path}/pages", commits, f"pages/{feed}")

    def listed(self) -> DataFrame | None:
        """(path, length, modified) of the files that are there; None if there is no folder. No file is opened."""
        found = read_if_exists(self.spark, self.folder, format="binaryFile", recursiveFileLookup="true")
        return None if found is None else found.select("path", "length", F.col("modificationTime").alias("modified"))

    def known(self) -> DataFrame | None:
        """The files loaded since the feed was last forgotten."""
        files = self.files.read()
        if files is None:
            return None
        since = files.agg(F.coalesce(F.max(F.when(F.col("forgotten"), F.col("at"))), F.lit(-1)).alias("since"))
        return files.filter((F.col("at") > since.scalar()) & F.col("path").isNotNull())

    def new_files(self) -> list[tuple] | None:
        """(path, length, modified) of files no run has loaded; None if the feed has no folder."""
        listed, known = self.listed(), self.known()
        if listed is None:
            return None
        if known is not None:
            same = ["path", "length", "modified"]
            listed = listed.join(known.select(*same).distinct(), same, "left_anti")
        return sorted(tuple(r) for r in listed.collect())

    def _open(self, pages: DataFrame | None) -> tuple[DataFrame | None, int | None]:
        """The pages since the last complete fetch, and the newest time noted with their files."""
        files = self.files.read()
        if files is None:
            return pages, None
        closed = F.max(F.when(F.col("closes") | F.col("forgotten"), F.col("at")))
        last = files.agg(closed.alias("at")).first()["at"]
        last = -1 if last is None else last
        observed = files.filter(F.col("at") > last).agg(F.max("observed").alias("o")).first()["o"]
        stored = self.pages.read()
        if stored is None:
            return pages, observed
        stored = stored.filter(F.col("at") > last)
        return (stored if pages is None else stored.unionByName(pages)), observed

    def take(self, files: list[tuple], pages: DataFrame, run_id: str, observed: int | None) -> Arrived:
        """Note files and their pages (page, more, records, unreadable); they count with the entries' commit."""
        at = int(self.commits.next_v()[:12])
        noted = pages.select("page", "more", "records", "unreadable", F.lit(at).cast("long").alias("at"))
        entry = self.pages.stage(noted)
        mine = None if entry is None else self.pages.written(entry.v, noted.schema)
        since, before = self._open(mine)
        complete = True if since is None else bool(reached_end(since).first()["complete"])
        newest = max((x for x in (observed, before) if x is not None), default=None)
        rows = [(path, length, modified, run_id, complete, observed, at, False) for path, length, modified in files]
        note = self.files.stage(self.spark.createDataFrame(rows, FILE).coalesce(1), rows=len(rows))
        return Arrived(tuple(e for e in (entry, note) if e is not None), complete, newest)

    def is_open(self) -> bool:
        """Is a fetch begun of which pages are still missing?"""
        since, _ = self._open(None)
        return False if since is None else not reached_end(since).first()["complete"]

    def forget(self, run_id: str) -> Entry:
        """Take all files for new: the next run loads them again."""
        at = int(self.commits.next_v()[:12])
        row = [(None, None, None, run_id, False, None, at, True)]
        return self.files.stage(self.spark.createDataFrame(row, FILE), rows=1)

    def missing_pages(self) -> DataFrame:
        """(page): numbers below the highest one seen that have not come since the last complete fetch."""
        since, _ = self._open(None)
        if since is None:
            return self.spark.createDataFrame([], "page long")
        seen = since.filter(F.col("page").isNotNull()).select("page").distinct()
        upto = seen.agg(F.max("page").alias("last")).select(F.explode(F.sequence(F.lit(1).cast("long"), F.col("last"))).alias("page"))
        return upto.join(seen, "page", "left_anti")


def reached_end(pages: DataFrame) -> DataFrame:
    """One row: did a fetch come to a page after which there is no more, and is none before it missing?

    A page that came again counts as it came last. A page that does not say whether more
    follow is taken for the last. Without numbers any page that announces no more ends the
    feed. No page at all is a feed without news, and complete.
    """
    newest = pages.groupBy("page").agg(F.max_by("more", "at").alias("more"), F.bool_or(~F.coalesce("more", F.lit(False))).alias("ends"))
    facts = newest.agg(
        F.max("page").alias("last"),
        F.count("page").alias("numbers"),
        F.max_by("more", "page").alias("more"),
        F.bool_or("ends").alias("ends"),
        F.count(F.lit(1)).alias("n"),
    )
    whole = ~F.coalesce("more", F.lit(False)) & (F.col("numbers") == F.col("last"))
    complete = F.when(F.col("n") == 0, True).when(F.col("last").isNull(), F.col("ends")).otherwise(whole)
    return facts.select(F.coalesce(complete, F.lit(False)).alias("complete"))
