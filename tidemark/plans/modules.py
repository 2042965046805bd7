"""Incremental sync of a page-numbered source, module by module."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.times import as_utc, time_literal
from tidemark.operators.explode import explode_subform
from tidemark.operators.filters import null_key
from tidemark.operators.history import history_state, snapshot_diff
from tidemark.operators.normalize import for_loading, loader_name
from tidemark.operators.quality import check_min_rows, run_log_row
from tidemark.operators.upsert import keep_last
from tidemark.operators.watermark import modified_time, observed_watermark
from tidemark.plans.history import History, history_path
from tidemark.plans.store import Mark, Store, from_micros, to_micros
from tidemark.sinks.commits import Entry
from tidemark.sinks.partitioned import BUCKETS
from tidemark.sources.arrivals import Arrived

logger = logging.getLogger(__name__)

__all__ = ["Batch", "Feed", "Module", "Synced", "history_path", "load_batch", "log_run", "sync_modules"]

#: Notes what a batch was read from, given the newest time in it (microseconds).
Take = Callable[[int | None], Arrived]


@dataclass(frozen=True)
class Batch:
    """What a feed has that is new; ``records`` is None if nothing is."""

    records: DataFrame | None
    take: Take | None = None
    is_open: Callable[[], bool] = lambda: False
    """Are pages of an earlier run still missing? Asked when nothing is new."""


Feed = Callable[[datetime], DataFrame | Batch]


def as_batch(given: DataFrame | Batch) -> Batch:
    return given if isinstance(given, Batch) else Batch(given)


@dataclass(frozen=True)
class Module:
    """One module: its feed gives the records modified since a time."""

    label: str
    table: str
    feed: Feed
    modified: tuple[str, ...] = ("Modified_Time",)
    key: tuple[str, ...] = ("id",)
    partition_by: Column | int | None = BUCKETS
    """A number of key-hash buckets for a target that is merged on read; or an expression
    over the staged columns that never changes for a key, such as the month of creation, of
    which only the partitions of a delta are rewritten. None writes the whole table anew in
    each run."""
    keeps_history: bool = False
    subform_of: str | None = None
    """Label of a module whose delta holds these records as a subform, for when the
    feed itself fails."""
    subform: Callable[[DataFrame], DataFrame] = explode_subform


@dataclass(frozen=True)
class Synced:
    label: str
    status: str
    records: int = 0
    watermark: datetime | None = None
    healthy: bool = True
    error: str = ""
    quarantined: int = 0
    complete: bool = True
    """False while pages that the feed announced are missing."""


def batch_facts(
    staged: DataFrame, modified: Sequence[str], keys: Sequence[str]
) -> tuple[int, datetime | None, int]:
    """Row count, newest time and rows without a key of a staged batch, in one pass.

    They are read from the written rows, which a lost executor cannot count twice.
    """
    names = [n for n in map(loader_name, modified) if n in staged.columns]
    newest = observed_watermark(staged, *names) if names else F.lit(None).cast("timestamp")
    keyed = all(k in staged.columns for k in keys)
    lost = F.count_if(null_key(list(keys))) if keyed else F.lit(0)
    row = staged.agg(F.count(F.lit(1)).alias("n"), F.unix_micros(newest).alias("m"), lost.alias("lost")).first()
    return row["n"], from_micros(row["m"]), row["lost"]


def next_mark(
    stored: datetime | None,
    since: datetime,
    observed: datetime | None,
    records: int,
    run_ts: datetime,
    policy: str,
) -> datetime:
    """The mark to store after a batch; see :func:`tidemark.operators.watermark.advance`."""
    floor = stored or as_utc(since)
    if records and observed is not None and observed > floor:
        return observed
    return max(floor, as_utc(run_ts)) if policy == "now" else floor


def newest_versions(raw: DataFrame, module: Module) -> DataFrame:
    """Each key's newest version once, and all rows without a key. Target and history are
    both made from it, so that they hold the same version."""
    keys = list(module.key)
    if any(k not in raw.columns for k in keys):
        return raw
    known = [m for m in module.modified if m in raw.columns]
    newest = [modified_time(raw, *known)] if known else []
    ties = F.xxhash64(F.to_json(F.struct("*")))
    unkeyed = raw.filter(null_key(keys))
    return keep_last(raw.filter(~null_key(keys)), keys, [*newest, ties]).unionByName(unkeyed)


def log_changes(
    store: Store, records: DataFrame, run_id: str, run_ts: datetime, modified: Sequence[str] = (), name: str = "revenue"
) -> list[Entry]:
    """Entries for the creations and changes of a delta, against the last state of its keys."""
    current = history_state(records, modified=modified)
    return History(store).record(lambda previous: snapshot_diff(current, previous, run_id, run_ts), name)


def load_batch(
    store: Store,
    source: str,
    module: Module,
    staged: DataFrame,
    mark: Mark,
    run_id: str,
    run_ts: datetime,
    idle: str,
    reached: datetime | None = None,
    take: Take | None = None,
    also: Sequence[Entry] = (),
) -> Synced:
    """Upsert a staged batch, check the target and advance the mark.

    The rows, ``also`` (history entries), and the files that ``take`` notes count from one
    commit on. ``reached`` is how far a batch goes whose rows carry no time of their own.
    While pages of the feed are missing the mark stays: what they hold may be older.
    """
    records, observed, lost = batch_facts(staged, module.modified, module.key)
    if lost:
        unkeyed = staged.filter(null_key(list(module.key)))
        store.quarantine(unkeyed, module.table, "no key", run_id)
        logger.warning("%s rows of %s have no key and are quarantined", lost, module.table)
    entries = list(also)
    taken = None if take is None else take(to_micros(observed))
    if taken is not None:
        entries += taken.entries
        observed = from_micros(taken.observed)
    if records:
        names = [n for n in map(loader_name, module.modified) if n in staged.columns]
        now = time_literal(run_ts, T.TimestampType())
        # A row that states no time counts as changed when it came.
        order = [F.coalesce(modified_time(staged, *names), now) if names else now]
        entries += store.stage_upsert(module.table, staged, list(module.key), order, run_id, module.partition_by)
    store.commits.commit(f"{run_id}/{module.label}", entries)
    store.merged(module.table).tend()
    healthy = True
    if records and not store.has_rows(module.table, 1):
        check = check_min_rows(store.read(module.table), module.table, 1).first()
        healthy = check["healthy"]
        if not healthy:
            logger.warning("%s has %s rows", module.table, check["actual"])
    complete = taken is None or taken.complete
    status = "synced" if records else "idle"
    new_mark = advance_mark(store, source, module.label, mark, observed or reached, records, complete, run_id, run_ts, idle)
    return Synced(module.label, status, records, new_mark, healthy, quarantined=lost, complete=complete)


def advance_mark(
    store: Store,
    source: str,
    label: str,
    mark: Mark,
    observed: datetime | None,
    records: int,
    complete: bool,
    run_id: str,
    run_ts: datetime,
    idle: str,
) -> datetime | None:
    """Store the mark after a batch and return it; that of a feed that was cut stays."""
    stored, since = mark
    if not complete:
        logger.warning("pages of %s are still missing, its mark stays", label)
        return stored
    new_mark = next_mark(stored, since, observed, records or int(observed is not None), run_ts, idle)
    if new_mark != stored and (records or observed is not None or stored is not None or idle == "now"):
        store.advance(source, label, new_mark, run_ts, run_id)
    return new_mark


def sync_modules(
    store: Store,
    source: str,
    modules: Sequence[Module],
    run_id: str,
    run_ts: datetime,
    *,
    idle: str = "hold",
    lookback: timedelta | None = None,
    at_once: int = 4,
) -> list[Synced]:
    """Per module: read the mark, stage the delta, log changes, upsert, check, advance.

    ``at_once`` modules run at the same time, subforms after their parents. A module whose
    feed fails is skipped, or takes its records from the subform of its parent's delta and
    its mark from the parent; the others go on. A failure after staging fails the run once
    the modules under way are done, and is logged; what they committed stays. Rows without
    a key are quarantined and counted.
    """
    parents = {m.subform_of for m in modules if m.subform_of}
    done: dict[str, Synced] = {}
    deltas: dict[str, tuple[DataFrame, Synced]] = {}

    def one(module: Module) -> None:
        mark = marks[module.label]
        reached = take = None
        try:
            batch = as_batch(module.feed(mark[1]))
            if batch.records is None:
                complete = not batch.is_open()
                kept = advance_mark(store, source, module.label, mark, None, 0, complete, run_id, run_ts, idle)
                done[module.label] = Synced(module.label, "idle", 0, kept, complete=complete)
                return
            raw, take = batch.records, batch.take
            if module.keeps_history:
                raw = newest_versions(raw, module)
            if module.keeps_history or module.label in parents:
                raw = store.stage(raw, f"{module.table}_raw")
            staged = store.stage(for_loading(raw), module.table)
        except Exception as failure:  # a source may fail in any way
            if module.subform_of not in deltas:
                logger.warning("skipping %s: %s", module.label, failure)
                done[module.label] = Synced(module.label, "skipped", error=str(failure))
                return
            logger.warning("%s taken from its parent's subform: %s", module.label, failure)
            parent, parent_result = deltas[module.subform_of]
            raw, take = module.subform(parent), None
            staged = store.stage(for_loading(raw), module.table)
            reached = parent_result.watermark
        also = log_changes(store, raw, run_id, run_ts, module.modified, module.table) if module.keeps_history else ()
        result = load_batch(store, source, module, staged, mark, run_id, run_ts, idle, reached, take, also)
        done[module.label] = result
        if module.label in parents and result.records:
            deltas[module.label] = raw, result

    def results() -> list[Synced]:
        return [done[m.label] for m in modules if m.label in done]

    try:
        marks = store.marks(source, [m.label for m in modules], run_ts, lookback)
        for wave in ([m for m in modules if not m.subform_of], [m for m in modules if m.subform_of]):
            with ThreadPoolExecutor(max(1, at_once)) as pool:
                under_way = [pool.submit(one, module) for module in wave]
            for each in under_way:
                each.result()
    except Exception as failure:
        log_run(store, source, "FAILED", results(), run_ts, str(failure))
        raise
    log_run(store, source, "SUCCESS", results(), run_ts)
    return results()


def log_run(
    store: Store, source: str, status: str, results: Sequence[Synced], started: datetime, error: str = ""
) -> None:
    total = sum(r.records for r in results)
    finished = max(datetime.now(timezone.utc), as_utc(started))
    store.log(run_log_row(store.spark, source, status, total, started, finished, error=error))
