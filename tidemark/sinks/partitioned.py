"""A keyed table of which an upsert rewrites only some directories."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.union import common_type
from tidemark.operators.upsert import upsert
from tidemark.sources.tables import read_if_exists

PART = "__part"
NO_VALUE = "__none"
SCHEMA_LOG = "columns long, schema string, version long, buckets long"
#: Buckets of a table partitioned by its key's hash, unless a job asks for more.
BUCKETS = 16
#: Partitions one delta may touch; their list goes through the driver.
MOST_PARTITIONS = 10_000


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """Partitioning by key hash, for keys without a lasting attribute."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


class PartitionedTable:
    """Parquet in one directory per partition value, with its schema kept beside it.

    The value is a hash of the key, or an expression that must be the same for a key for
    good (the month a record was created); an upsert that would move a key is refused. An
    upsert replaces the directories its delta falls into, each as a whole when the job
    commits; a repeated run gives the same rows. The files of untouched partitions may
    lack newer columns; the kept schema says which there are, so that no reader has to
    open every file to find out. Only a column that has to change its type makes the
    whole table be written anew, beside the old one, and the schema log then names it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.schemas = f"{self.path}/schemas"

    def _kept(self) -> tuple[T.StructType, int, int | None] | None:
        """The newest schema, the number of the folder its data are in, and the table's buckets."""
        log = read_if_exists(self.spark, self.schemas, SCHEMA_LOG, format="json")
        if log is None:
            return None
        newest = F.max(F.struct(F.coalesce("version", F.lit(0)).alias("version"), "columns", "schema", "buckets")).alias("s")
        row = log.agg(newest).first()["s"]
        return None if row is None else (T.StructType.fromJson(json.loads(row["schema"])), row["version"], row["buckets"])

    def _keep_schema(self, schema: T.StructType, version: int, buckets: int | None) -> None:
        row = self.spark.range(1).select(
            F.lit(len(schema)).cast("bigint").alias("columns"),
            F.lit(schema.json()).alias("schema"),
            F.lit(version).cast("bigint").alias("version"),
            F.lit(buckets).cast("bigint").alias("buckets"),
        )
        row.coalesce(1).write.mode("append").json(self.schemas)

    def _data(self, version: int) -> str:
        return f"{self.path}/data" if version == 0 else f"{self.path}/data-{version}"

    def _stored(self, schema: T.StructType, version: int) -> DataFrame | None:
        """The table with its partition values as the texts they were written as."""
        typed = T.StructType([*schema.fields, T.StructField(PART, T.StringType())])
        return read_if_exists(self.spark, self._data(version), typed)

    def read(self) -> DataFrame | None:
        kept = self._kept()
        stored = None if kept is None else self._stored(*kept[:2])
        return None if stored is None else stored.drop(PART)

    def upsert(
        self,
        delta: DataFrame,
        keys: Sequence[str],
        by: Column | int = BUCKETS,
        order: Sequence[Column | str] = (),
        *,
        apply: Callable[..., DataFrame] = upsert,
    ) -> int:
        """Apply a delta; returns how many partitions were rewritten.

        ``by`` is a number of key-hash buckets, fixed by the first load, or an expression.
        The driver sees the
        delta's partition values, of which there may be at most ``MOST_PARTITIONS``, never
        its rows. The delta should be a written table, as it is read twice. ``apply`` may
        be ``upsert_newest``. The columns of the delta take the stored types where no
        value is lost; else the column becomes the type both have in common.
        """
        kept, version, buckets = self._kept() or (T.StructType(), 0, None)
        if isinstance(by, int):
            by = buckets = buckets or by
        delta = conformed(delta, kept)
        schema = grown(kept, delta.schema)
        value = key_bucket(keys, by) if isinstance(by, int) else by
        delta = delta.withColumn(PART, F.coalesce(value.cast("string"), F.lit(NO_VALUE)))
        found = delta.select(PART).distinct().limit(MOST_PARTITIONS + 1).collect()
        touched = [row[PART] for row in found]
        if not touched:
            return 0
        if len(touched) > MOST_PARTITIONS:
            raise ValueError(f"a delta of more than {MOST_PARTITIONS} partitions: partition by something coarser")
        stored = self._stored(kept, version) if len(kept) else None
        if stored is not None and not isinstance(by, int):
            self._refuse_moves(stored, delta, keys)
        changed = schema.fields[: len(kept)] != kept.fields
        if stored is not None and changed:
            version += 1
        elif stored is not None:
            stored = self._stored(schema, version).filter(F.col(PART).isin(touched))
        if not changed and len(schema) > len(kept):
            self._keep_schema(schema, version, buckets)
        (
            apply(stored, delta, keys, order)
            .select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in schema.fields], PART)
            .hint("rebalance", PART)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static" if changed else "dynamic")
            .partitionBy(PART)
            .parquet(self._data(version))
        )
        if changed:
            self._keep_schema(schema, version, buckets)
        return len(touched)

    def _refuse_moves(self, stored: DataFrame, delta: DataFrame, keys: Sequence[str]) -> None:
        was = stored.select(*keys, F.col(PART).alias("__was"))
        moved = was.join(delta.select(*keys, PART).distinct(), list(keys)).where(F.col("__was") != F.col(PART))
        if not moved.isEmpty():
            raise ValueError("a stored key would move to another partition; partition by what never changes, or by buckets")


def conformed(delta: DataFrame, kept: T.StructType) -> DataFrame:
    """A delta with the stored types where no value is lost: integers where the table has
    floats, and columns of nulls only."""
    stored = {f.name.lower(): f.dataType for f in kept.fields}
    other = [f for f in delta.schema.fields if stored.get(f.name.lower(), f.dataType) != f.dataType]
    wider = {f.name for f in other if common_type(f.dataType, stored[f.name.lower()]) == stored[f.name.lower()]}
    unsure = [f.name for f in other if isinstance(f.dataType, T.StringType)]
    if unsure:
        filled = delta.agg(*[F.max(F.col(f"`{n}`").isNotNull()).alias(n) for n in unsure]).first()
        wider |= {n for n in unsure if not filled[n]}
    wider = {n for n in wider if not isinstance(stored[n.lower()], T.StringType)}
    return delta.withColumns({n: F.col(f"`{n}`").cast(stored[n.lower()]) for n in sorted(wider)}) if wider else delta


def grown(kept: T.StructType, more: T.StructType) -> T.StructType:
    """The kept schema with the columns it lacks; where types differ, their common one."""
    kinds = {f.name.lower(): f.dataType for f in more.fields}
    old = [T.StructField(f.name, common_type(f.dataType, kinds.get(f.name.lower(), f.dataType))) for f in kept.fields]
    known = {f.name.lower() for f in kept.fields}
    return T.StructType([*old, *[T.StructField(f.name, f.dataType) for f in more.fields if f.name.lower() not in known]])
