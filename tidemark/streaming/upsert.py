"""Continuous form of the incremental load: files arrive, rows are upserted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.upsert import upsert_newest
from tidemark.session import materialize
from tidemark.sinks.merged import MergedTable
from tidemark.sinks.partitioned import PartitionedTable
from tidemark.sinks.snapshot import SnapshotTable


def stream_upsert(
    stream: DataFrame,
    target: SnapshotTable | PartitionedTable | MergedTable,
    keys: Sequence[str],
    order: Sequence[Column | str],
    *,
    name: str,
    checkpoint: str,
    staging: str,
    partition_by: Column | int | None = None,
) -> StreamingQuery:
    """Upsert every micro-batch of a stream into a target, then stop when none is left.

    The checkpoint remembers which files were read, in place of a watermark. A batch
    replayed after a failure holds the rows it had, and upserting them again changes
    nothing. A row that comes late does not replace a newer one. A large target is merged
    on read, so that a batch writes its own rows only; or it is a partitioned table, of
    which each batch rewrites the partitions it falls into.
    """
    if isinstance(target, MergedTable) and not target.newest:
        raise ValueError("rows of a stream may come late: the newest row of a key has to count in the target")
    if isinstance(target, PartitionedTable) != (partition_by is not None):
        raise ValueError("a partitioned target, and only that, needs partition_by")

    def apply(batch: DataFrame, batch_id: int) -> None:
        staged = materialize(batch, staging)
        if isinstance(target, MergedTable):
            if not target.commits.made(f"{name}-{batch_id}"):
                target.upsert(staged, order, f"{name}-{batch_id}")
        elif isinstance(target, PartitionedTable):
            target.upsert(staged, keys, partition_by, order, apply=upsert_newest)
        else:
            target.publish(
                upsert_newest(target.read(), staged, keys, order), f"{name}-{batch_id}"
            )

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .queryName(name)
        .start()
    )
