"""Full refresh: every table replaced, all columns text, history by comparison."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame

from tidemark.functions.times import as_utc
from tidemark.operators.associations import referenced_only
from tidemark.operators.explode import explode_stages
from tidemark.operators.history import history_state, snapshot_diff_full
from tidemark.operators.normalize import for_full_refresh
from tidemark.operators.quality import full_refresh_log_row
from tidemark.plans.history import History
from tidemark.plans.modules import Synced
from tidemark.plans.objects import owners_with_names
from tidemark.plans.store import Store
from tidemark.sinks.tables import append, drop_table
from tidemark.sources.pages import feed_complete, unwrap_module_pages

logger = logging.getLogger(__name__)


def replace_table(store: Store, table: str, df: DataFrame, run_id: str) -> int:
    """Replace a table by a non-empty input; an empty one changes nothing."""
    return store.target(table).replace(for_full_refresh(df), run_id)


def log_refresh(
    store: Store, status: str, results: Sequence[Synced], started: datetime, error: str = ""
) -> None:
    finished = max(datetime.now(timezone.utc), as_utc(started))
    total = sum(r.records for r in results)
    row = full_refresh_log_row(store.spark, status, total, started, finished, error=error)
    append(for_full_refresh(row).coalesce(1), f"{store.root}/meta/etl_logs")


@dataclass(frozen=True)
class RefreshSource:
    pipelines: Callable[[], DataFrame]
    owners: Callable[[bool], DataFrame]
    deals: Callable[[], DataFrame]
    companies: Callable[[], DataFrame]
    line_items: Callable[[], DataFrame]
    complete: Callable[[str], bool] = lambda name: True
    """Did a feed, pipelines and owners among them, reach its end?"""


def refresh_objects(
    store: Store, feeds: RefreshSource, run_id: str, run_ts: datetime
) -> list[Synced]:
    """Every object table anew; of the companies only those some deal names.

    Without deals or companies the run fails. The other tables stay as they were when
    their feed fails, and every table whose feed was cut does.
    """
    results: list[Synced] = []

    def replace(label: str, table: str, df: DataFrame) -> int:
        records = replace_table(store, table, df, run_id)
        results.append(Synced(label, "replaced" if records else "idle", records))
        return records

    def cut(label: str) -> bool:
        if feeds.complete(label):
            return False
        logger.warning("the feed of %s was cut, its table stays", label)
        results.append(Synced(label, "incomplete", healthy=False))
        return True

    def try_replace(label: str, table: str, feed: Callable[[], DataFrame]) -> None:
        try:
            if not cut(label):
                replace(label, table, feed())
        except Exception as failure:  # a source may fail in any way
            logger.warning("skipping %s: %s", label, failure)
            results.append(Synced(label, "skipped", error=str(failure)))

    def owners() -> DataFrame:
        return owners_with_names(feeds.owners(False), feeds.owners(True), strict=True)

    try:
        try_replace("pipelines", "Pipelines", lambda: explode_stages(feeds.pipelines()))
        try_replace("owners", "Owners", owners)
        if not cut("deals") and replace("deals", "Deals", feeds.deals()) and not cut("companies"):
            deals = store.read("Deals")
            named = referenced_only(feeds.companies(), deals, "associated_company_ids")
            replace("companies", "Companies", named)
        try_replace("line_items", "Line_Items", feeds.line_items)
    except Exception as failure:
        log_refresh(store, "FAILED", results, run_ts, str(failure))
        raise
    log_refresh(store, "SUCCESS", results, run_ts)
    return results


@dataclass(frozen=True)
class PagedModule:
    """One module's landed pages, the whole of it in each run, and how to unwrap them."""

    label: str
    table: str
    pages: Callable[[], DataFrame]
    keeps_history: bool = False
    unwrap: Callable[[DataFrame], DataFrame] = unwrap_module_pages


def log_snapshot_changes(
    store: Store, records: DataFrame, run_id: str, run_ts: datetime, *, deletes: bool
) -> None:
    """Log what changed between the last state of each key and a snapshot, in one commit."""
    current = history_state(records)
    entries = History(store).record(
        lambda previous: snapshot_diff_full(current, previous, run_id, run_ts, deletes=deletes, stage=_stages(store))
    )
    store.commits.commit(f"{run_id}/history", entries)


def _stages(store: Store) -> Callable[[DataFrame], DataFrame]:
    """Writes each intermediate result of one run to a staging table of its own."""
    used: list[str] = []

    def stage(df: DataFrame) -> DataFrame:
        used.append(f"revenue_step_{len(used)}")
        return store.stage(df, used[-1])

    return stage


def refresh_with_history(
    store: Store,
    modules: Sequence[PagedModule],
    run_id: str,
    run_ts: datetime,
    *,
    obsolete: Sequence[str] = (),
) -> list[Synced]:
    """Every module's table anew, the changes of one of them logged before.

    A module whose feed was cut keeps its table and logs no deletions. ``obsolete``
    names catalog tables to drop at the end.
    """
    results: list[Synced] = []
    try:
        for module in modules:
            pages = module.pages()
            complete = feed_complete(pages).first()["complete"]
            records = module.unwrap(pages)
            if module.keeps_history:
                records = store.stage(records, f"{module.table}_raw")
                if not records.isEmpty():
                    log_snapshot_changes(store, records, run_id, run_ts, deletes=complete)
            if complete:
                count = replace_table(store, module.table, records, run_id)
                results.append(Synced(module.label, "replaced" if count else "idle", count))
            else:
                results.append(Synced(module.label, "incomplete", healthy=False))
        for table in obsolete:
            drop_table(store.spark, table)
    except Exception as failure:
        log_refresh(store, "FAILED", results, run_ts, str(failure))
        raise
    log_refresh(store, "SUCCESS", results, run_ts)
    return results
