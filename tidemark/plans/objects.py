"""Incremental sync of a cursor-paged object source."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import full_name
from tidemark.operators.associations import association_catchup
from tidemark.operators.explode import explode_stages
from tidemark.operators.normalize import for_loading
from tidemark.operators.select import REQUIRED_PROPERTIES
from tidemark.operators.union import tagged_passes
from tidemark.plans.modules import Batch, Feed, Module, Synced, advance_mark, as_batch, load_batch, log_run
from tidemark.plans.store import Store
from tidemark.sinks.partitioned import BUCKETS

logger = logging.getLogger(__name__)

# Where an object's time of change is found.
OBJECT_MODIFIED = ("lastmodifieddate", "hs_lastmodifieddate")


@dataclass(frozen=True)
class ObjectSource:
    """Feeds of one source. Pipelines and owners have no delta and are read whole."""

    pipelines: Callable[[], DataFrame]
    owners: Callable[[bool], DataFrame]
    deals: Feed
    companies: Feed
    all_companies: Callable[[], DataFrame]
    line_items: Feed


def owners_with_names(active: DataFrame, archived: DataFrame, *, strict: bool = False) -> DataFrame:
    both = tagged_passes(active, archived)
    return both.withColumn("fullName", full_name(F.col("firstName"), F.col("lastName"), strict=strict))


def sync_objects(
    store: Store,
    source: str,
    feeds: ObjectSource,
    run_id: str,
    run_ts: datetime,
    *,
    idle: str = "hold",
    lookback: timedelta | None = None,
    partition_by: Column | int | None = BUCKETS,
) -> list[Synced]:
    """Metadata whole, then deals, companies with the ones the deals name, line items.

    Any failing feed ends the run: companies depend on the deals before them.
    """
    results: list[Synced] = []

    def whole(label: str, table: str, df: DataFrame, key: str) -> None:
        staged = store.stage(for_loading(df), table)
        records = staged.count()
        if records:
            store.upsert(table, staged, [key], [], run_id)
        results.append(Synced(label, "synced" if records else "idle", records))

    def delta(label: str, table: str, fetch: Feed) -> DataFrame | None:
        module = Module(label, table, fetch, OBJECT_MODIFIED, partition_by=partition_by)
        mark = marks[label]
        batch = as_batch(fetch(mark[1]))
        if batch.records is None:
            complete = not batch.is_open()
            kept = advance_mark(store, source, label, mark, None, 0, complete, run_id, run_ts, idle)
            results.append(Synced(label, "idle", 0, kept, complete=complete))
            return None
        staged = store.stage(for_loading(batch.records), table)
        results.append(load_batch(store, source, module, staged, mark, run_id, run_ts, idle, take=batch.take))
        return staged

    def companies(since: datetime) -> DataFrame | Batch:
        """The delta, with the companies that new deals name."""
        batch = as_batch(feeds.companies(since))
        if deals is None:
            return batch
        everything = feeds.all_companies()
        children = batch.records if batch.records is not None else everything.limit(0)
        caught_up = association_catchup(children, deals, everything, "associated_company_ids")
        return Batch(caught_up, batch.take, batch.is_open)

    try:
        marks = store.marks(source, ["deals", "companies", "line_items"], run_ts, lookback)
        whole("pipelines", "Pipelines", explode_stages(feeds.pipelines()), "stage_id")
        whole("owners", "Owners", owners_with_names(feeds.owners(False), feeds.owners(True)), "id")
        deals = delta("deals", "Deals", feeds.deals)
        for name in REQUIRED_PROPERTIES["deals"]:
            if deals is not None and name not in deals.columns:
                logger.warning("deals have no property %s", name)
        delta("companies", "Companies", companies)
        delta("line_items", "Line_Items", feeds.line_items)
    except Exception as failure:
        log_run(store, source, "FAILED", results, run_ts, str(failure))
        raise
    log_run(store, source, "SUCCESS", results, run_ts)
    return results
