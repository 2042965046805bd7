"""A keyed table merged when it is read: an upsert writes its own rows and nothing else."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.filters import keyed
from tidemark.operators.normalize import quoted
from tidemark.operators.ranking import latest_per_key
from tidemark.operators.upsert import keep_last
from tidemark.sinks.commits import Commits, Entry, V
from tidemark.sinks.partitioned import BUCKETS, conformed, grown, key_bucket
from tidemark.sources.tables import read_if_exists

PART, ORDER, GONE = "__part", "__order", "__gone"
#: Deltas after which a table is tended, and the share of a part's base rows that makes it grown.
MOST_DELTAS, GROWN_SHARE = 8, 0.25


@dataclass(frozen=True)
class _State:
    """What counts now: the base folder and rows of each part, and the deltas on top, oldest first."""

    base: dict[int, Entry]
    base_rows: dict[int, int]
    deltas: tuple[Entry, ...]
    facts: dict

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(self.facts["schema"])

    def delta_rows(self, part: int) -> int:
        return sum(n for e in self.deltas for p, n in e.parts if p == part and e.v > self.base_v(part))

    def base_v(self, part: int) -> str:
        return self.base[part].v if part in self.base else ""


class MergedTable:
    """Base files in parts by key hash, small delta files with rows and tombstones on top.

    ``upsert`` and ``delete`` write a delta, whose size follows the change however many
    parts its keys fall into. A read takes the base rows whose keys no delta has, and of
    each key in the deltas the newest row: only the deltas are ranked. ``compact`` writes
    those parts anew whose deltas have grown beyond a share of their base, and folds the
    deltas of the others into one. Each step is one commit.

    With ``newest`` the row that is last by the order given with each delta counts,
    wherever it is stored, so rows may come late; else the delta committed last. Columns
    that the table lacks are added; only a column that has to change its type makes the
    whole table be written anew. Tables may share ``commits``, and then change together.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str] = (),
        buckets: int = BUCKETS,
        *,
        newest: bool = False,
        commits: Commits | None = None,
        name: str = "table",
    ):
        self.spark, self.path, self.name = spark, path.rstrip("/"), name
        self.commits = commits or Commits(spark, f"{self.path}/commits")
        self._given = {"keys": list(keys), "buckets": buckets, "newest": newest}

    # What counts

    def _state(self) -> _State | None:
        base: dict[int, Entry] = {}
        rows: dict[int, int] = {}
        deltas: list[Entry] = []
        facts = None
        for e in self.commits.entries(self.name):
            facts = e.facts or facts
            if e.kind in ("base", "whole"):
                if e.kind == "whole":
                    base, rows, deltas = {}, {}, []
                base |= {p: e for p, _ in e.parts}
                rows |= dict(e.parts)
            else:
                # A fold holds what still counted of the deltas before it.
                deltas = [e] if e.kind == "fold" else [*deltas, e]
        if facts is None:
            return None
        now = _State(base, rows, (), json.loads(facts))
        # A delta of which each part has a newer base is never read again.
        return _State(base, rows, tuple(e for e in deltas if any(e.v > now.base_v(p) for p, _ in e.parts)), now.facts)

    def live(self) -> list[Entry]:
        """The entries that a reader needs, the base of each part by itself."""
        state = self._state()
        if state is None:
            return []
        facts = json.dumps(state.facts)
        bases = [Entry(self.name, "base", e.v, ((p, state.base_rows[p]),), facts) for p, e in sorted(state.base.items())]
        return [*bases, *state.deltas]

    def exists(self) -> bool:
        return bool(self.commits.entries(self.name))

    @property
    def newest(self) -> bool:
        """Does the newest row count, not the one that came last?"""
        state = self._state()
        return self._given["newest"] if state is None else state.facts["newest"]

    def at_least(self) -> int:
        """A number of rows that the table surely has, from the commits alone. Exact without deltas."""
        state = self._state()
        if state is None:
            return 0
        base = sum(state.base_rows.values())
        gone = sum(e.rows for e in state.deltas if e.kind in ("gone", "fold"))
        return max(0, base - gone, max((e.rows for e in state.deltas if e.kind == "delta"), default=0) - gone)

    # Reading

    def _fields(self, schema: T.StructType, facts: dict) -> list[T.StructField]:
        order = [T.StructField(ORDER, T.StructType.fromJson(facts["order"]))] if facts["newest"] else []
        return [*schema.fields, *order]

    def _base(self, state: _State, parts: set[int] | None) -> DataFrame | None:
        folders = [f"{self.path}/base/{PART}={p}/{V}={e.v}" for p, e in sorted(state.base.items()) if state.base_rows[p] and (parts is None or p in parts)]
        if not folders:
            return None
        typed = T.StructType([*self._fields(state.schema, state.facts), T.StructField(PART, T.IntegerType()), T.StructField(V, T.StringType())])
        return self.spark.read.schema(typed).option("basePath", f"{self.path}/base").parquet(*folders)

    def _deltas(self, state: _State, parts: set[int] | None) -> DataFrame | None:
        """The newest row or tombstone of each key among the deltas that count."""
        if not state.deltas:
            return None
        marks = [T.StructField(PART, T.IntegerType()), T.StructField(GONE, T.BooleanType()), T.StructField(V, T.StringType())]
        typed = T.StructType([*self._fields(state.schema, state.facts), *marks])
        folders = [f"{self.path}/delta/{V}={e.v}" for e in state.deltas]
        rows = self.spark.read.schema(typed).option("basePath", f"{self.path}/delta").parquet(*folders)
        if parts is not None:
            rows = rows.filter(F.col(PART).isin(sorted(parts)))
        newer = {p: e.v for p, e in state.base.items() if e.v > state.deltas[0].v}
        if newer:
            since = F.create_map(*[x for p, v in newer.items() for x in (F.lit(p), F.lit(v))])
            rows = rows.filter(F.col(V) > F.coalesce(since[F.col(PART)], F.lit("")))
        return rows

    def _newest(self, rows: DataFrame, facts: dict) -> DataFrame:
        by = [F.col(ORDER).desc(), F.col(V).desc()] if facts["newest"] else [F.col(V).desc()]
        return latest_per_key(rows, facts["keys"], by)

    def _tops(self, state: _State, parts: set[int] | None) -> DataFrame | None:
        """The row or tombstone that counts, of each key that the deltas have."""
        deltas = self._deltas(state, parts)
        if deltas is None:
            return None
        base = self._base(state, parts) if state.facts["newest"] else None
        if base is not None:
            keys = state.facts["keys"]
            rivals = base.join(deltas.select(*keys).distinct(), keys, "left_semi").withColumn(GONE, F.lit(False))
            deltas = deltas.unionByName(rivals.select(deltas.columns))
        return self._newest(deltas, state.facts)

    def _merged(self, state: _State, parts: set[int] | None = None) -> DataFrame | None:
        base, tops = self._base(state, parts), self._tops(state, parts)
        if tops is None:
            return base
        top = tops.filter(~F.col(GONE)).drop(GONE)
        if base is None:
            return top
        keys = state.facts["keys"]
        changed = self._deltas(state, parts).select(*keys).distinct()
        return base.join(changed, keys, "left_anti").select(top.columns).unionByName(top)

    def read(self) -> DataFrame | None:
        """The table now, None before its first load."""
        state = self._state()
        if state is None:
            return None
        merged = self._merged(state)
        if merged is None:
            return self.spark.createDataFrame([], state.schema)
        return merged.select(*[quoted(f.name) for f in state.schema.fields])

    # Writing

    def stage(
        self, delta: DataFrame, order: Sequence[Column | str] = (), *, gone: bool = False, one_per_key: bool = False
    ) -> Entry | None:
        """Write a delta that counts once the entry is committed; None if it has no keyed row.

        ``order`` says which of several rows of a key is last; a delta surely without them
        (``one_per_key``) is not ranked. The first load, and one that changes a column's
        type, write base files.
        """
        state = self._state()
        facts = dict(self._given if state is None else state.facts)
        keys = facts["keys"]
        if not keys:
            raise ValueError(f"{self.name}: the first load has to name the keys")
        kept = T.StructType() if state is None else state.schema
        delta = keyed(conformed(delta, kept), keys)
        schema = grown(kept, delta.schema)
        changed = schema.fields[: len(kept)] != kept.fields
        by = [F.col(c) if isinstance(c, str) else c for c in order]
        if facts["newest"]:
            if not by:
                raise ValueError(f"{self.name}: the newest row counts, so each delta needs an order")
            delta = delta.withColumn(ORDER, F.struct(*[c.alias(f"o{i}") for i, c in enumerate(by)]))
            kind = delta.schema[ORDER].dataType.jsonValue()
            if facts.setdefault("order", kind) != kind:
                raise ValueError(f"{self.name}: the order has other types than before")
        facts["schema"] = schema.jsonValue()
        ties = F.xxhash64(*[quoted(c) for c in delta.columns])
        rows = delta if one_per_key else keep_last(delta, keys, [*([F.col(ORDER)] if facts["newest"] else by), ties])
        rows = rows.select(
            *[(quoted(f.name) if f.name.lower() in {c.lower() for c in rows.columns} else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields],
            *([ORDER] if facts["newest"] else []),
            key_bucket(keys, facts["buckets"]).alias(PART),
            F.lit(gone).alias(GONE),
        )
        if state is None and gone:
            return None
        if state is None:
            return self._write_base(rows.drop(GONE), "base", facts)
        if changed:
            return self._write_base(self._retyped(state, rows, schema, facts), "whole", facts)
        return self._write_delta(rows, "gone" if gone else "delta", facts)

    def _retyped(self, state: _State, rows: DataFrame, schema: T.StructType, facts: dict) -> DataFrame:
        """The stored rows in the new types beside the new ones."""
        stored = self._merged(state).drop(V)
        extra = [ORDER] if facts["newest"] else []
        own = {f.name for f in state.schema.fields}
        stored = stored.select(
            *[(quoted(f.name) if f.name in own else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields], *extra
        ).withColumn(PART, key_bucket(facts["keys"], facts["buckets"]))  # a key's text may have changed with its type
        both = stored.withColumns({GONE: F.lit(False), V: F.lit("")}).unionByName(rows.withColumn(V, F.lit("1")))
        return self._newest(both, facts).filter(~F.col(GONE)).drop(GONE, V)

    def _write_base(self, rows: DataFrame, kind: str, facts: dict) -> Entry | None:
        v = self.commits.next_v()
        path = f"{self.path}/base"
        rows.drop(V).sortWithinPartitions(PART).withColumn(V, F.lit(v)).write.mode("append").partitionBy(PART, V).parquet(path)
        # Rows are counted in the written files, which a lost executor cannot count twice.
        typed = T.StructType([T.StructField(PART, T.IntegerType()), T.StructField(V, T.StringType())])
        written = read_if_exists(self.spark, f"{path}/{PART}=*/{V}={v}", typed, basePath=path)
        return self._entry(written, kind, v, facts)

    def _write_delta(self, rows: DataFrame, kind: str, facts: dict) -> Entry | None:
        v = self.commits.next_v("b" if kind == "fold" else "a")
        path = f"{self.path}/delta/{V}={v}"
        rows.sortWithinPartitions(PART).write.parquet(path)
        return self._entry(self.spark.read.schema(f"{PART} int").parquet(path), kind, v, facts)

    def _entry(self, written: DataFrame | None, kind: str, v: str, facts: dict) -> Entry | None:
        counts = [] if written is None else written.groupBy(PART).count().collect()
        if not counts and kind != "fold":
            return None
        return Entry(self.name, kind, v, tuple(sorted((r[PART], r["count"]) for r in counts)), json.dumps(facts))

    def upsert(self, delta: DataFrame, order: Sequence[Column | str] = (), txn: str = "") -> int:
        """Apply a delta in a commit of its own; returns its keyed rows, one a key. Tends the table."""
        entry = self.stage(delta, order)
        self.commits.commit(txn, [entry])
        self.tend()
        return 0 if entry is None else entry.rows

    def delete(self, keys: DataFrame, order: Sequence[Column | str] = (), txn: str = "") -> int:
        """Put tombstones for the given keys; returns how many. Unknown keys do no harm."""
        entry = self.stage(keys, order, gone=True)
        self.commits.commit(txn, [entry])
        self.tend()
        return 0 if entry is None else entry.rows

    # Upkeep

    def grown_parts(self) -> list[int]:
        """The parts whose deltas hold more than a share of the rows of their base."""
        state = self._state()
        if state is None:
            return []
        parts = {p for e in state.deltas for p, _ in e.parts}
        return sorted(p for p in parts if 0 < state.delta_rows(p) >= GROWN_SHARE * state.base_rows.get(p, 0))

    def tend(self) -> bool:
        """Compact when there are many deltas or they hold as much as the base."""
        state = self._state()
        fresh = [] if state is None else [e for e in state.deltas if e.kind != "fold"]
        held = sum(e.rows for e in fresh)
        if not fresh or len(fresh) < MOST_DELTAS and held < sum(state.base_rows.values()):
            return False
        return self.compact()

    def compact(self, *, all_parts: bool = False) -> bool:
        """Write the grown parts anew, or all with deltas, and fold what is left into one delta.

        What it writes follows what has changed, not the table. Where the newest row counts,
        tombstones stay, as an older row may still come. A run that dies leaves the table as
        it was.
        """
        state = self._state()
        if state is None or not state.deltas:
            return False
        touched = {p for e in state.deltas for p, _ in e.parts if state.delta_rows(p)}
        parts = touched if all_parts else set(self.grown_parts())
        entries = []
        if parts:
            entry = self._write_base(self._merged(state, parts), "base", state.facts)
            # A part of which all rows are gone has an empty base.
            rows = {**dict.fromkeys(parts, 0), **dict(entry.parts if entry else ())}
            v = entry.v if entry else self.commits.next_v()
            entries.append(Entry(self.name, "base", v, tuple(sorted(rows.items())), json.dumps(state.facts)))
        tombstones = bool(parts) and state.facts["newest"]
        left = [self._tops(state, parts).filter(GONE)] if tombstones else []
        if touched - parts and (tombstones or len(state.deltas) > 1):
            left.append(self._newest(self._deltas(state, touched - parts), state.facts))
        if left:
            folded = reduce(DataFrame.unionByName, left).drop(V)
            entries.append(self._write_delta(folded, "fold", state.facts))
        self.commits.commit("(compaction)", entries)
        return bool(entries)
