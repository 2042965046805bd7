"""Column names and types of schemaless JSON records."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import clean_name
from tidemark.operators.normalize import loader_name, project_last

# One bit per type; two bits set mean a conflict.
BOOLEAN, INTEGER, FLOAT, STRING = 1, 2, 4, 8
# A table of more columns is taken for a mistake.
MAX_FIELDS = 10_000
SPARK_TYPES = {BOOLEAN: "boolean", INTEGER: "bigint", FLOAT: "double"}


def _type_bit(kind: Column) -> Column:
    return (
        F.when(kind == "VOID", F.lit(0))
        .when(kind == "BOOLEAN", F.lit(BOOLEAN))
        .when(kind == "BIGINT", F.lit(INTEGER))
        .when((kind == "DOUBLE") | kind.startswith("DECIMAL"), F.lit(FLOAT))
        .otherwise(F.lit(STRING))
    )


def _type_name(bits: Column) -> Column:
    return (
        F.when(bits == BOOLEAN, "BOOLEAN")
        .when(bits == INTEGER, "INTEGER")
        .when(bits == FLOAT, "FLOAT")
        .otherwise("STRING")
    )


def _entries(records: DataFrame, record: str) -> DataFrame:
    """(key, value, kind) of every field of a variant column."""
    each = records.sparkSession.tvf.variant_explode(F.col(record).outer())
    return (
        records.select(record)
        .lateralJoin(each)
        .filter(F.col("key").isNotNull())
        .select("key", "value", F.schema_of_variant("value").alias("kind"))
    )


def infer_types(records: DataFrame, json_column: str) -> DataFrame:
    """(column, type) over all records, in name order.

    A column seen with two types, or only with nulls, is STRING. Each task reduces
    its records to one row per column before the shuffle.
    """
    parsed = records.select(F.try_parse_json(F.col(json_column)).alias("record"))
    seen = (
        _entries(parsed, "record")
        .select(clean_name(F.col("key")).alias("column"), _type_bit(F.col("kind")).alias("bit"))
        .groupBy("column")
        .agg(F.bit_or("bit").alias("bits"))
    )
    return seen.select("column", _type_name(F.col("bits")).alias("type")).orderBy("column")


def flat_fields(records: DataFrame, record: str) -> DataFrame:
    """(key, inner, type): the fields of a variant column, objects one level down."""
    is_object = F.col("kind").startswith("OBJECT")
    entries = _entries(records, record)
    # A field that is no object gives one row without an inner field.
    inside = records.sparkSession.tvf.variant_explode_outer(
        F.when(is_object, F.col("value")).outer()
    ).toDF("at", "inner", "of")
    fields = (
        entries.lateralJoin(inside)
        .filter(F.col("inner").isNotNull() | ~is_object)
        .select(
            "key",
            "inner",
            F.when(is_object, F.schema_of_variant("of")).otherwise(F.col("kind")).alias("kind"),
        )
    )
    return (
        fields.groupBy("key", "inner")
        .agg(F.bit_or(_type_bit(F.col("kind"))).alias("bits"))
        .select("key", "inner", "bits", _type_name(F.col("bits")).alias("type"))
    )


def typed_records(
    records: DataFrame, record: str, keep: Sequence[str] = (), *, empty: Sequence[str] | None = None
) -> DataFrame:
    """Columns for all fields that any record of a variant column has.

    Objects are flattened one level, names cleaned, types inferred over all records;
    nested values become JSON text. ``keep`` names further columns to go along, which
    win over a field of their name. The driver reads the list of fields, never a
    record. ``records`` should be a written table, as it is read twice. Where the names
    of several fields become equal the last in name order that has a value wins; a
    field only seen null gives way to one of its name with values. A field that is null in
    all records is text; given ``empty``, only the fields it names are kept, as a delta
    cannot know their type.
    """
    fields = flat_fields(records, record).limit(MAX_FIELDS + 1).collect()
    if len(fields) > MAX_FIELDS:
        raise ValueError(f"more than {MAX_FIELDS} different fields: does a feed use ids as field names?")
    found = sorted(
        (row["key"], row["inner"] or "", row["inner"] is not None, row["bits"], row["type"]) for row in fields
    )
    objects = {key for key, _, nested, _, _ in found if nested}
    by_name: dict[str, list[tuple[str, int, Callable[[str], Column]]]] = {}
    for key, inner, nested, bits, _ in found:
        name = loader_name(f"{key}_{inner}" if nested else key)
        path = f"$[{_quoted(key)}]" + (f"[{_quoted(inner)}]" if nested else "")
        read = _reader(record, path, skip_objects=not nested and key in objects)
        by_name.setdefault(name.lower(), []).append((name, bits, read))
    pairs = []
    for fields in by_name.values():
        bits = reduce(or_, (b for _, b, _ in fields))
        if not bits and empty is not None and fields[-1][0] not in empty:
            continue
        kind = SPARK_TYPES.get(bits, "string")
        values = [read(kind) for _, _, read in reversed(fields)]
        pairs.append((fields[-1][0], F.coalesce(*values)))
    pairs = sorted(pairs, key=lambda pair: pair[0]) + [(name, F.col(name)) for name in keep]
    return project_last(records, pairs)


def _reader(record: str, path: str, *, skip_objects: bool) -> Callable[[str], Column]:
    """Reads a field as a type; a field that some records hold as an object is read
    only from the others, as the object went to columns of its own."""

    def read(kind: str) -> Column:
        value = F.try_variant_get(record, path, kind)
        if not skip_objects:
            return value
        shape = F.schema_of_variant(F.try_variant_get(record, path, "variant"))
        return F.when(~shape.startswith("OBJECT"), value)

    return read


def _quoted(key: str) -> str:
    """A key inside a variant path, which knows no escapes."""
    for quote in ('"', "'"):
        if quote not in key:
            return f"{quote}{key}{quote}"
    raise ValueError(f"a field name with both kinds of quotes cannot be read: {key}")
