"""The change log of a module, and beside it the last state of each key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.text import canonical_amount
from tidemark.operators.history import HISTORY_COLUMNS, HISTORY_SCHEMA, latest_history
from tidemark.operators.ranking import latest_per_key
from tidemark.plans.store import Store
from tidemark.sinks.commits import CommittedLog, Entry
from tidemark.sinks.merged import MergedTable
from tidemark.sources.tables import read_if_exists

STATE_COLUMNS = ("amount", "Revenue_date", "Block_id", "block_name", "Type")


def history_path(store: Store) -> str:
    return f"{store.root}/history/log"


class History:
    """A log in one folder a month, and a table merged on read with each key's last entry.

    Both change in one commit, so a run compares its records with the state and never
    scans the log, however long it is; and since a repeated run finds its own changes in
    the state, it logs none of them twice. A log that an earlier layout wrote is read as
    well, and its last entries begin the state.
    """

    def __init__(self, store: Store):
        self.store, self.spark = store, store.spark
        month = F.substring("action_timestamp", 1, 7)
        self.log = CommittedLog(store.spark, history_path(store), store.commits, "history/log", {"month": month})
        self.state = MergedTable(
            store.spark, f"{store.root}/history/state", ["revenue_id"], commits=store.commits, name="history/state"
        )

    def _earlier(self) -> DataFrame | None:
        """The log of the earlier layout."""
        found = read_if_exists(self.spark, f"{self.store.root}/history/revenue_history")
        return None if found is None else found.select(*HISTORY_COLUMNS)

    def read(self) -> DataFrame:
        """All entries ever logged."""
        parts = [df for df in (self.log.read(), self._earlier()) if df is not None]
        if not parts:
            return self.spark.createDataFrame([], HISTORY_SCHEMA)
        return parts[0] if len(parts) == 1 else parts[0].select(*HISTORY_COLUMNS).unionByName(parts[1])

    def previous(self) -> DataFrame:
        """The last logged state of each key, as :func:`latest_history` has it."""
        if not self.state.exists():
            earlier = self._earlier()
            return latest_history(self.spark.createDataFrame([], HISTORY_SCHEMA) if earlier is None else earlier)
        held = self.state.read().withColumn("amount", canonical_amount(F.col("amount")))
        return held.select(F.col("revenue_id").alias("id"), *STATE_COLUMNS)

    def entries(self, changes: DataFrame) -> list[Entry]:
        """Write changes (a staged table) to log and state; they count once committed."""
        logged = self.log.stage(changes.select(*HISTORY_COLUMNS))
        if logged is None:
            return []
        earlier = None if self.state.exists() else self._earlier()
        if earlier is not None:
            keyed = earlier.filter(F.col("revenue_id").isNotNull())
            newest = latest_per_key(keyed, ["revenue_id"], [F.col("action_timestamp").desc(), F.col("action_id").desc()])
            changes = newest.join(changes.select("revenue_id").distinct(), "revenue_id", "left_anti").unionByName(
                changes, allowMissingColumns=True
            )
        state = self.state.stage(changes.select(*HISTORY_COLUMNS))
        return [e for e in (logged, state) if e is not None]

    def record(self, compare: Callable[[DataFrame], DataFrame], name: str = "revenue") -> list[Entry]:
        """Entries for what ``compare`` finds against the previous state."""
        return self.entries(self.store.stage(compare(self.previous()), f"{name}_history"))
