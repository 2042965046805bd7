"""Change capture in a stream: each key's last version lies in a table beside the checkpoint."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.text import change_reasons
from tidemark.operators.history import CHANGED, STATE, entries
from tidemark.operators.ranking import latest_per_key
from tidemark.session import materialize
from tidemark.sinks.commits import CommittedLog
from tidemark.sinks.merged import MergedTable

#: When a version was changed, in microseconds; the least number if it does not say.
_STAMP, _NEVER = "changed_at", -(1 << 62)
_VERSION = (*STATE, _STAMP)

#: A state store for streams with keyed state of several kinds; the capture of changes needs none.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def compare_versions(batch: DataFrame, last: DataFrame | None) -> DataFrame:
    """(id, version, Type) of the keys of a batch whose newest version is to be kept.

    ``Type`` is empty where nothing that is logged has changed. A version older than the
    last one seen is left out; one that does not say when it was changed never is.
    """
    # Of equally new versions any will do, but the same for every attempt.
    order = [F.col(_STAMP).desc(), *[F.col(c).desc_nulls_last() for c in STATE]]
    newest = latest_per_key(batch.select("id", *_VERSION), ["id"], order)
    if last is None:
        return newest.withColumn("Type", F.lit("Create"))
    # A small batch is broadcast here, so that the last versions are neither shuffled nor sorted.
    touched = last.join(batch.select("id").distinct(), "id", "left_semi")
    now = newest.select("id", F.struct(*_VERSION).alias("now"))
    was = touched.select("id", F.struct(*_VERSION).alias("was"))
    reasons = [("Amount changed", "amount"), ("Date changed", "Revenue_date")]
    changed = change_reasons([(text, ~F.col(f"now.{c}").eqNullSafe(F.col(f"was.{c}"))) for text, c in reasons])
    late = (F.col(f"now.{_STAMP}") > _NEVER) & (F.col(f"now.{_STAMP}") < F.col(f"was.{_STAMP}"))
    kept = now.join(was, "id", "left").filter(F.col("was").isNull() | ~late)
    return kept.select("id", "now.*", F.when(F.col("was").isNull(), "Create").otherwise(changed).alias("Type"))


def stream_changes(
    states: DataFrame, log: CommittedLog, run_ts: datetime, *, name: str, checkpoint: str
) -> StreamingQuery:
    """Log the creations and changes in a stream of states, then stop when no input is left.

    ``states`` has the columns of :func:`history_state` with its time of change. State lies
    in the checkpoint, one version a key, as a table merged on read: a batch is compared
    with it in one join and adds its own versions, a restart goes on where the last run
    ended and no log is read. Of several versions of a key in a micro-batch the newest
    counts; one older than the last seen is left out. Rows without a key are, too. The
    state changes after the log, so a batch that is replayed finds the state it had before,
    or its transactions made.
    """
    last = MergedTable(log.spark, f"{checkpoint}/versions", ["id"], name="versions")
    at = F.unix_micros(F.col(CHANGED).cast("timestamp")) if CHANGED in states.columns else F.lit(None)
    stamp = F.coalesce(at.cast("bigint"), F.lit(_NEVER)).alias(_STAMP)
    keyed = states.filter(F.col("id").isNotNull()).select("id", *[F.col(c).cast("string").alias(c) for c in STATE], stamp)

    def apply(batch: DataFrame, number: int) -> None:
        run_id = f"{name}-{number}"
        if last.commits.made(run_id):
            return
        last.tend()  # before it is read, as nobody else gains from that
        # Joined once, as both the log and the state are drawn from it.
        compared = materialize(compare_versions(batch, last.read()), f"{checkpoint}/compared")
        rows = compared.filter(F.col("Type") != "").select("id", F.struct(*STATE).alias("row"), "Type")
        log.append(entries(rows, run_id, run_ts), run_id)
        last.commits.commit(run_id, [last.stage(compared.drop("Type"), one_per_key=True)])

    return (
        keyed.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .queryName(name)
        .start()
    )
