"""Change history: compare a snapshot with the last logged state of each key."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import action_id, canonical_amount, change_reasons
from tidemark.functions.times import LOCAL_OFFSET_MINUTES, as_utc, offset_time
from tidemark.operators.filters import active_history
from tidemark.operators.normalize import quoted
from tidemark.operators.ranking import latest_per_key, spread_row_number
from tidemark.operators.select import fuzzy_amount, lookup_struct
from tidemark.operators.watermark import modified_time

# Columns of the history table, and of a compared state.
HISTORY_COLUMNS = (
    "action_id",
    "action_timestamp",
    "Block_id",
    "revenue_id",
    "block_name",
    "Revenue_date",
    "amount",
    "Type",
)
HISTORY_SCHEMA = ", ".join(f"{c} string" for c in HISTORY_COLUMNS)
CHANGED = "__changed"
STATE = ("amount", "Revenue_date", "Block_id", "block_name")


def history_state(
    records: DataFrame, *, key: str = "id", date: str = "Date", modified: Sequence[str] = ()
) -> DataFrame:
    """(id, amount, Revenue_date, Block_id, block_name) of raw records; a date that no
    record has is null. ``modified`` names the columns that say when a record changed:
    their time goes along, and of several versions of a record the newest counts."""
    known = [m for m in modified if m in records.columns]
    stamp = [modified_time(records, *known).alias(CHANGED)] if known else []
    block_id, block_name = lookup_struct(records, "Parent_Id")
    dated = quoted(date) if date in records.columns else F.lit(None)
    return records.select(
        quoted(key).cast("string").alias("id"),
        fuzzy_amount(records).alias("amount"),
        dated.cast("string").alias("Revenue_date"),
        block_id.alias("Block_id"),
        block_name.alias("block_name"),
        *stamp,
    )


def latest_history(history: DataFrame, *, only: DataFrame | None = None) -> DataFrame:
    """Last logged state of each key, amounts in canonical text.

    ``only`` (a column ``id``) restricts the history to the keys of a delta before the
    ranking, so that an incremental run does not rank the whole log. The stamp has
    whole seconds; the action id settles a tie.
    """
    log = history.filter(F.col("revenue_id").isNotNull())
    if only is not None:
        wanted = only.select(F.col("id").alias("revenue_id")).distinct()
        log = log.join(wanted, "revenue_id", "left_semi")
    newest = latest_per_key(
        log, ["revenue_id"], [F.col("action_timestamp").desc(), F.col("action_id").desc()]
    )
    return newest.select(
        F.col("revenue_id").alias("id"),
        canonical_amount(F.col("amount")).alias("amount"),
        "Revenue_date",
        "Block_id",
        "block_name",
        "Type",
    )


def _reasons() -> Column:
    def differs(name: str) -> Column:
        return ~F.col(f"now.{name}").eqNullSafe(F.col(f"was.{name}"))

    return change_reasons(
        [("Amount changed", differs("amount")), ("Date changed", differs("Revenue_date"))]
    )


def _state(df: DataFrame, name: str, *extra: str) -> DataFrame:
    return df.select("id", F.struct(*STATE, *extra).alias(name))


def _one_per_key(current: DataFrame) -> DataFrame:
    """Rows with a key, each key once: its newest version, and among equally new ones
    that with the least hash. Copies of a record, however many, are reduced in the map
    tasks. The joins that follow use the same partitioning and order."""
    given = current.filter(F.col("id").isNotNull())
    newest = [F.col(CHANGED).desc_nulls_last()] if CHANGED in current.columns else []
    return latest_per_key(given, ["id"], [*newest, F.xxhash64(*STATE)])


def entries(rows: DataFrame, run_id: str, run_ts: datetime) -> DataFrame:
    """History rows of (id, state struct ``row``, Type)."""
    stamp = offset_time(
        F.lit(as_utc(run_ts).strftime("%Y-%m-%d %H:%M:%S")), LOCAL_OFFSET_MINUTES
    )
    return rows.select(
        action_id(run_id, F.col("id"), F.col("Type")).alias("action_id"),
        stamp.alias("action_timestamp"),
        F.col("row.Block_id"),
        F.col("id").alias("revenue_id"),
        F.col("row.block_name"),
        F.col("row.Revenue_date"),
        F.col("row.amount"),
        "Type",
    )


def snapshot_diff(
    current: DataFrame, previous: DataFrame, run_id: str, run_ts: datetime
) -> DataFrame:
    """History rows for the created and changed keys of a delta; no deletes. A key last
    logged as deleted is created anew.

    ``previous`` is first cut to the delta's keys, which for a small delta is a
    broadcast filter over the large side instead of a shuffle of it.
    """
    now = _state(_one_per_key(current), "now")
    touched = current.select("id").distinct()
    active = previous.filter(active_history(F.col("Type")))
    was = _state(active.join(touched, "id", "left_semi"), "was")
    compared = now.join(was, "id", "left").select(
        "id",
        F.col("now").alias("row"),
        F.when(F.col("was").isNull(), "Create").otherwise(_reasons()).alias("Type"),
    )
    return entries(compared.filter(F.col("Type") != ""), run_id, run_ts)


def detect_deletes(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Last states of active keys that the current snapshot no longer has."""
    active = previous.filter(active_history(F.col("Type")))
    return active.join(current.select("id").distinct(), "id", "left_anti")


def replacement_match(
    appeared: DataFrame, vanished: DataFrame, stage: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """(new_id, old_id): the i-th new row and the i-th vanished row of each
    (Block_id, Revenue_date) group, nulls equal. Every row is in at most one pair.

    Rows are numbered in the order of their ids, range by range, so a group of any size
    is spread over tasks, and the pairing joins on the number: one row meets one row.
    ``stage`` writes an intermediate table once.
    """
    group = F.struct("Block_id", "Revenue_date").alias("__group")
    new = spread_row_number(appeared.select(F.col("id").alias("new_id"), group), "__group", "new_id", "__rn", stage)
    old = spread_row_number(vanished.select(F.col("id").alias("old_id"), group), "__group", "old_id", "__rn", stage)
    return new.join(old, ["__group", "__rn"]).select("new_id", "old_id")


def snapshot_diff_full(
    current: DataFrame,
    previous: DataFrame,
    run_id: str,
    run_ts: datetime,
    *,
    deletes: bool = True,
    reseen: str = "create",
    stage: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """History rows of a whole snapshot: created, changed, replaced and deleted keys.

    ``previous`` holds one row per key. ``deletes=False`` is for a snapshot that may be
    incomplete: no key is then taken as vanished. A key logged as deleted and seen
    again is created anew (``reseen="create"``) or compared with its last state
    (``"compare"``). ``stage`` writes the differing rows once, as three results are
    drawn from them and the join of the two snapshots should run only once.
    """
    if reseen not in ("create", "compare"):
        raise ValueError(f"unknown reseen: {reseen}")
    now = _state(_one_per_key(current), "now")
    if reseen == "create":
        previous = previous.filter(active_history(F.col("Type")))
    was = _state(previous, "was", "Type")

    gone = active_history(F.col("was.Type")) & F.lit(deletes)
    kind = (
        F.when(F.col("was").isNull(), "appeared")
        .when(F.col("now").isNull(), F.when(gone, "vanished").otherwise(""))
        .otherwise(_reasons())
    )
    moved = stage(
        now.join(was, "id", "full_outer")
        .select("id", F.coalesce("now", F.struct(*[f"was.{c}" for c in STATE])).alias("row"), kind.alias("Type"))
        .filter(F.col("Type") != "")
    )

    changed = moved.filter(~F.col("Type").isin("appeared", "vanished"))
    appeared = moved.filter(F.col("Type") == "appeared").drop("Type")
    vanished = moved.filter(F.col("Type") == "vanished").drop("Type")
    pairs = stage(
        replacement_match(appeared.select("id", "row.*"), vanished.select("id", "row.*"), stage)
    )

    def with_partner(rows: DataFrame, own: str, other: str, paired: Column, alone: str) -> DataFrame:
        partners = pairs.select(F.col(own).alias("id"), F.col(other).alias("partner"))
        kind = F.when(F.col("partner").isNull(), alone).otherwise(paired)
        return rows.join(partners, "id", "left").select("id", "row", kind.alias("Type"))

    replacing = F.concat(F.lit("Replaced "), F.col("partner"))
    replaced = F.concat(F.lit("Deleted (Replaced by "), F.col("partner"), F.lit(")"))
    rows = changed.unionByName(
        with_partner(appeared, "new_id", "old_id", replacing, "Create")
    ).unionByName(with_partner(vanished, "old_id", "new_id", replaced, "Delete"))
    return entries(rows, run_id, run_ts)
