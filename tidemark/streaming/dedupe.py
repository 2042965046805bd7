"""Event-time deduplication of a stream, with late rows kept aside."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import materialize
from tidemark.sinks.commits import CommittedLog


def _appending(stream: DataFrame, apply: Callable[[DataFrame, str], None], name: str, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(lambda batch, number: apply(batch, f"{name}-{number}"))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .queryName(name)
        .start()
    )


def dedupe_stream(
    stream: DataFrame, log: CommittedLog, keys: Sequence[str], time: str, delay: str, *, name: str, checkpoint: str
) -> StreamingQuery:
    """Append the first row of each key to a log, once; then stop when no input is left.

    Keys are remembered in the state store until the watermark, ``delay`` behind the newest
    event, has passed them by as much again, so the state stays as large as that stretch of
    time. Rows older than the watermark that the batch before had are left out here; see
    :func:`late_rows`. A batch that is replayed after a failure finds its transaction made.
    """
    first = stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))
    return _appending(first, lambda batch, txn: log.append(batch, txn), name, checkpoint)


def late_rows(
    stream: DataFrame,
    log: CommittedLog,
    late: CommittedLog,
    keys: Sequence[str],
    time: str,
    delay: str,
    *,
    name: str,
    checkpoint: str,
    staging: str,
) -> StreamingQuery:
    """Append rows whose key :func:`dedupe_stream` never let through to a side log, each key once.

    It runs over the same input with a checkpoint of its own, after the other has stopped,
    so it reads new files only. Of the two logs only rows within ``delay`` of the batch's
    times are looked at, which a log partitioned by day reads from a few folders.
    """

    def apply(batch: DataFrame, txn: str) -> None:
        if late.commits.made(txn):
            return
        rows = materialize(batch, staging)
        reach = rows.agg(F.min(time).alias("a"), F.max(time).alias("b"))
        window = F.expr(f"INTERVAL {delay}")
        for seen in (log.read(), late.read()):
            if seen is not None:
                near = seen.filter(
                    (F.col(time) >= reach.select(F.col("a") - window).scalar()) & (F.col(time) <= reach.select(F.col("b") + window).scalar())
                )
                rows = rows.join(near.select(*keys).distinct(), list(keys), "left_anti").select(batch.columns)
        late.append(rows.dropDuplicates(list(keys)), txn)

    return _appending(stream, apply, name, checkpoint)
