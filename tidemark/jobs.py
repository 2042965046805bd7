"""Run a sync over landed pages: ``spark-submit tidemark/jobs.py modules --landing … --store …``.

The landing folder has one folder per feed, each holding pages as JSON lines. Modules are
named by their label with underscores for spaces. Objects come as ``deals``,
``companies``, ``all_companies`` (optional, all of them), ``line_items``, ``pipelines``,
``owners`` and ``owners_archived``. Optional feeds are ``modules``, the source's own list
of modules, by which labels are resolved, and ``deals_properties`` and
``companies_properties``, by which hidden properties are left out.
"""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import TimestampType

from tidemark.functions.times import as_utc, time_literal
from tidemark.operators.explode import PARENT_COLUMNS, subform_elements
from tidemark.operators.filters import changed_since
from tidemark.operators.infer import typed_records
from tidemark.operators.labels import discovered_names, resolve_labels, resolve_labels_exact
from tidemark.operators.normalize import for_loading
from tidemark.operators.select import project_visible
from tidemark.operators.watermark import modified_time
from tidemark.plans.config import DEFAULT_MODULES, MODULE_TABLES, REFRESH_LABELS, refresh_table
from tidemark.plans.modules import Batch, Feed, Module, Synced, sync_modules
from tidemark.plans.objects import OBJECT_MODIFIED, ObjectSource, sync_objects
from tidemark.plans.refresh import (
    PagedModule,
    RefreshSource,
    refresh_objects,
    refresh_with_history,
)
from tidemark.plans.store import Store
from tidemark.sinks.merged import MergedTable
from tidemark.sinks.partitioned import BUCKETS
from tidemark.sources.arrivals import Arrivals
from tidemark.sources.ndjson import MAX_BAD_RECORDS, BadRecordBudgetExceeded
from tidemark.sources.pages import (
    OBJECT_COLUMNS,
    OBJECT_PAGE,
    cursor_complete,
    landed_pages,
    page_facts,
    property_names,
    read_object_pages,
    read_result_pages,
    read_variant_pages,
    readable,
    unwrap_line_items,
    unwrap_objects,
)
from tidemark.sources.tables import read_if_exists

HISTORY_MODULES = ("Revenue Recognition", "Revenue_Recognition")
PIPELINES = (
    "results array<struct<id: string, label: string,"
    " stages: array<struct<id: string, label: string, displayOrder: int>>>>"
)
OWNERS = "results array<struct<id: string, email: string, firstName: string, lastName: string, userId: string>>"
PAGING = "paging struct<next: struct<after: string>>, unreadable string"


class Landing:
    """Feeds over a landing folder.

    The incremental jobs read only files that no run has loaded: a ledger beside the store
    knows them and their pages. The full refresh reads feeds whole. Pages are staged before
    their records are typed; lines that cannot be read are quarantined, and more than the
    budget of them among the lines of one run fail the feed.
    """

    def __init__(
        self,
        store: Store,
        path: str,
        run_id: str,
        at: datetime,
        lookback: timedelta | None = None,
        obsolete: Sequence[str] = (),
        buckets: int = BUCKETS,
    ):
        self.store, self.spark = store, store.spark
        self.lookback, self.obsolete, self.buckets = lookback, obsolete, buckets
        self.path, self.run_id, self.at = path.rstrip("/"), run_id, at
        self._companies: DataFrame | None = None

    def folder(self, name: str) -> str:
        return f"{self.path}/{name.replace(' ', '_')}"

    def landed(self, name: str, schema: str) -> DataFrame | None:
        """An optional feed as JSON lines, None if it has no folder."""
        return read_if_exists(self.spark, self.folder(name), schema, format="json", recursiveFileLookup="true")

    def arrivals(self, name: str) -> Arrivals:
        feed = name.replace(" ", "_")
        return Arrivals(self.spark, self.folder(name), f"{self.store.root}/arrivals/{feed}", self.store.commits, feed)

    def stage(self, pages: DataFrame, name: str) -> DataFrame:
        """Pages written once, their unreadable lines set aside."""
        landed = self.store.stage(pages, f"{name.replace(' ', '_')}_landed")
        unreadable = landed.filter(F.col("unreadable").isNotNull()).select("unreadable")
        bad = unreadable.count()
        if bad:
            self.store.quarantine(unreadable, name.replace(" ", "_"), "unreadable", self.run_id)
        if bad > MAX_BAD_RECORDS:
            raise BadRecordBudgetExceeded(f"{bad} unreadable lines, {MAX_BAD_RECORDS} tolerated: {name}")
        return landed

    def news(self, name: str, read: Callable[..., DataFrame], unwrap: Callable[[DataFrame], DataFrame], records: Column) -> Batch:
        """The records of files that no run has loaded. ``read`` reads pages by path,
        ``unwrap`` makes records of staged ones, ``records`` counts those of a staged row."""
        arrivals = self.arrivals(name)
        files = arrivals.new_files()
        if files is None:
            raise FileNotFoundError(f"nothing landed: {self.folder(name)}")
        if not files:
            return Batch(None, is_open=arrivals.is_open)
        landed = self.stage(read(self.spark, *[path for path, _, _ in files]), name)
        facts = page_facts(landed, records)
        return Batch(unwrap(readable(landed)), lambda observed: arrivals.take(files, facts, self.run_id, observed))

    def in_reach(self, records: DataFrame, since: datetime, columns: Sequence[str], name: str) -> DataFrame:
        """On the first run of a feed with a lookback, the records it reaches and those without a readable time."""
        if self.lookback is None or self.arrivals(name).known() is not None:
            return records
        return changed_since(records, columns, since)

    # Modules

    def typed(self, landed: DataFrame) -> DataFrame:
        records = typed_records(landed.filter(F.col("record").isNotNull()), "record", empty=("id", "Modified_Time"))
        return records if records.columns else self.spark.createDataFrame([], "id string")

    def module(self, api_name: str) -> Feed:
        def feed(since: datetime) -> Batch:
            def unwrap(landed: DataFrame) -> DataFrame:
                return self.in_reach(self.typed(landed), since, ["Modified_Time"], api_name)

            def read(spark: SparkSession, *paths: str) -> DataFrame:
                return landed_pages(read_variant_pages(spark, *paths))

            return self.news(api_name, read, unwrap, F.col("record").isNotNull().cast("int"))

        return feed

    def catalog(self) -> DataFrame | None:
        """The landed list of modules in its order, if there is one."""
        entry = "api_name: string, plural_label: string, singular_label: string"
        pages = self.landed("modules", f"modules array<struct<{entry}>>")
        if pages is None:
            return None
        return pages.select(F.posexplode("modules").alias("sequence", "m")).select("sequence", "m.*")

    def names(self, labels: Sequence[str]) -> dict[str, str]:
        """The api name of each label by the landed list of modules, else the label."""
        catalog = self.catalog()
        if catalog is None:
            return {label: label for label in labels}
        return {row["label"]: row["api_name"] for row in resolve_labels(catalog, labels).collect()}

    def subform(self, parents: DataFrame) -> DataFrame:
        elements = self.store.stage(subform_elements(parents), "subform_landed")
        return typed_records(elements, "element", PARENT_COLUMNS)

    # Objects

    def visible(self, pages: DataFrame, name: str, companies: bool) -> DataFrame:
        """The objects of staged pages with their visible properties."""
        objects = unwrap_objects(pages, property_names(pages), companies=companies)
        entry = "struct<name: string, hidden: boolean>"
        catalog = self.landed(f"{name}_properties", f"results array<{entry}>")
        if catalog is None:
            return objects
        shown = catalog.selectExpr("inline(results)").unionByName(
            self.spark.createDataFrame([(c, False) for c in OBJECT_COLUMNS], "name string, hidden boolean")
        )
        return project_visible(objects, shown)

    def objects(self, name: str, unwrap: Callable[[DataFrame], DataFrame]) -> Feed:
        def feed(since: datetime) -> Batch:
            def read(spark: SparkSession, *paths: str) -> DataFrame:
                return numbered_none(read_object_pages(spark, *paths))

            def records(pages: DataFrame) -> DataFrame:
                return self.in_reach(unwrap(pages), since, OBJECT_MODIFIED, name)

            return self.news(name, read, records, F.coalesce(F.size("results"), F.lit(0)))

        return feed

    def deals(self, since: datetime) -> Batch:
        return self.objects("deals", lambda pages: self.visible(pages, "deals", True))(since)

    def companies(self, since: datetime) -> Batch:
        batch = self.objects("companies", lambda pages: self.visible(pages, "companies", False))(since)
        self._companies = batch.records
        return batch

    def line_items(self, since: datetime) -> Batch:
        return self.objects("line_items", unwrap_line_items)(since)

    def all_companies(self) -> DataFrame:
        """All companies ever landed, from a mirror to which only new files are added; without
        such a feed, those of this run: what came before is in the target already."""
        mirror = MergedTable(
            self.spark, f"{self.store.root}/mirror/all_companies", ["id"], self.buckets,
            newest=True, commits=self.store.commits, name="mirror/all_companies",
        )
        try:
            batch = self.objects("all_companies", lambda pages: self.visible(pages, "all_companies", False))(self.at)
        except FileNotFoundError:
            empty = self.spark.createDataFrame([], "id string")
            return empty if self._companies is None else self._companies
        if batch.records is not None:
            staged = self.store.stage(for_loading(batch.records), "all_companies")
            known = [c for c in OBJECT_MODIFIED if c in staged.columns]
            now = time_literal(self.at, TimestampType())
            order = F.coalesce(modified_time(staged, *known), now) if known else now
            self.store.commits.commit(f"{self.run_id}/all_companies", [mirror.stage(staged, [order]), *batch.take(None).entries])
            mirror.tend()
        stored = mirror.read()
        return self.spark.createDataFrame([], "id string") if stored is None else stored

    # Feeds read whole

    def whole_pages(self, name: str, schema: str = OBJECT_PAGE) -> DataFrame:
        return readable(self.stage(read_result_pages(self.spark, schema, self.folder(name)), f"whole_{name}"))

    def whole(self, name: str, *, companies: bool = False) -> DataFrame:
        return self.visible(self.whole_pages(name), name, companies)

    def all_line_items(self) -> DataFrame:
        return unwrap_line_items(self.whole_pages("line_items"))

    def refreshed_companies(self) -> DataFrame:
        return self.whole("companies" if self.landed("all_companies", "value string") is None else "all_companies")

    def whole_module(self, pages: DataFrame, table: str) -> DataFrame:
        return self.typed(readable(self.stage(landed_pages(pages), table)))

    def complete(self, name: str) -> bool:
        """Did the cursor feed reach its end?"""
        names = [name, "owners_archived"] if name == "owners" else [name]
        if name == "companies" and self.landed("all_companies", "value string") is not None:
            names = ["all_companies"]
        return all(cursor_complete(read_object_pages(self.spark, self.folder(n))).first()["complete"] for n in names)

    def pipelines(self) -> DataFrame:
        return self.whole_pages("pipelines", f"{PIPELINES}, {PAGING}").selectExpr("inline(results)")

    def owners(self, archived: bool) -> DataFrame:
        name = "owners_archived" if archived else "owners"
        return self.whole_pages(name, f"{OWNERS}, {PAGING}").selectExpr("inline(results)")


def numbered_none(pages: DataFrame) -> DataFrame:
    """Cursor pages as pages without numbers, of which the last has no next cursor."""
    return pages.withColumns({"page": F.lit(None).cast("long"), "more": F.col("paging.next.after").isNotNull()})


def modules(landing: Landing, source: str, at: datetime, idle: str) -> list[Synced]:
    names = landing.names(list(MODULE_TABLES))
    specs = [
        Module(
            label,
            table,
            landing.module(names[label]),
            keeps_history=label in HISTORY_MODULES,
            subform_of="Blocks" if label == "Site Splits" else None,
            subform=landing.subform,
            partition_by=landing.buckets,
        )
        for label, table in MODULE_TABLES.items()
    ]
    return sync_modules(landing.store, source, specs, landing.run_id, at, idle=idle, lookback=landing.lookback)


def objects(landing: Landing, source: str, at: datetime, idle: str) -> list[Synced]:
    feeds = ObjectSource(
        pipelines=landing.pipelines,
        owners=landing.owners,
        deals=landing.deals,
        companies=landing.companies,
        all_companies=landing.all_companies,
        line_items=landing.line_items,
    )
    return sync_objects(landing.store, source, feeds, landing.run_id, at, idle=idle, lookback=landing.lookback, partition_by=landing.buckets)


def refresh_all_objects(landing: Landing, source: str, at: datetime, idle: str) -> list[Synced]:
    feeds = RefreshSource(
        pipelines=landing.pipelines,
        owners=landing.owners,
        deals=lambda: landing.whole("deals", companies=True),
        companies=landing.refreshed_companies,
        line_items=landing.all_line_items,
        complete=landing.complete,
    )
    return refresh_objects(landing.store, feeds, landing.run_id, at)


def refresh_all_modules(landing: Landing, source: str, at: datetime, idle: str) -> list[Synced]:
    def spec(name: str) -> PagedModule:
        return PagedModule(
            name,
            refresh_table(name),
            lambda: read_variant_pages(landing.spark, landing.folder(name)),
            keeps_history=name in HISTORY_MODULES,
            unwrap=lambda pages: landing.whole_module(pages, refresh_table(name)),
        )

    catalog = landing.catalog()
    names = list(DEFAULT_MODULES)
    if catalog is not None:
        names = discovered_names(resolve_labels_exact(catalog, REFRESH_LABELS), DEFAULT_MODULES)
    return refresh_with_history(
        landing.store, [spec(name) for name in names], landing.run_id, at, obsolete=landing.obsolete
    )


def reset(landing: Landing, labels: Sequence[str]) -> None:
    """Forget the marks and the loaded files of modules or object feeds: the next run loads them anew."""
    names = landing.names([label for label in labels if label in MODULE_TABLES])
    for label in labels:
        landing.store.reset(label, landing.run_id)
        landing.store.commits.commit(f"{landing.run_id}/reset", [landing.arrivals(names.get(label, label)).forget(landing.run_id)])


JOBS: dict[str, Callable[[Landing, str, datetime, str], list[Synced]]] = {
    "modules": modules,
    "objects": objects,
    "refresh-objects": refresh_all_objects,
    "refresh-modules": refresh_all_modules,
}


def main(argv: Sequence[str] | None = None) -> list[Synced]:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=[*JOBS, "reset"])
    parser.add_argument("--module", action="append", default=[], help="with reset: label of a module or name of a feed to load anew")
    parser.add_argument("--landing", required=True, help="folder of the landed pages")
    parser.add_argument("--store", required=True, help="folder of the targets, shared by all executors")
    parser.add_argument("--source", default="crm")
    parser.add_argument("--run-id", default=None)
    parser.add_argument("--at", default=None, help="run time, ISO-8601")
    parser.add_argument("--lookback-days", type=int, default=None, help="reach of a first run; without it all is read")
    parser.add_argument("--buckets", type=int, default=BUCKETS, help="key-hash parts of a target, fixed with its first load")
    parser.add_argument("--obsolete", action="append", default=[], help="a catalog table to drop after a refresh")
    parser.add_argument("--idle", choices=("hold", "now"), default="hold")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"tidemark-{args.job}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    at = as_utc(datetime.fromisoformat(args.at)) if args.at else datetime.now(timezone.utc)
    run_id = args.run_id or f"{at:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    lookback = None if args.lookback_days is None else timedelta(days=args.lookback_days)
    store = Store(spark, args.store.rstrip("/"))
    landing = Landing(store, args.landing, run_id, at, lookback, args.obsolete, args.buckets)
    if args.job == "reset":
        reset(landing, args.module)
        return []
    results = JOBS[args.job](landing, args.source, at, args.idle)
    for result in results:
        print(result)
    return results


if __name__ == "__main__":
    main()
