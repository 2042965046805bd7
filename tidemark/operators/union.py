"""Unions and differences of tables whose columns need not agree."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.text import as_text
from tidemark.operators.normalize import quoted


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """Shared type of one column: equal, the wider of two integers or floats, a double
    for an integer beside a float, or text."""
    if a == b:
        return a
    integers = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    floats = (T.FloatType, T.DoubleType)
    for family in (integers, floats):
        if isinstance(a, family) and isinstance(b, family):
            return max(a, b, key=lambda t: family.index(type(t)))
    if isinstance(a, integers + floats) and isinstance(b, integers + floats):
        return T.DoubleType()
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    return T.StringType()


def align_types(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cast the columns both sides have to one type; a conflict becomes text.

    A plain union would cast text to the number type and fail on the first word.
    """
    wanted: dict[str, T.DataType] = {}
    theirs = {f.name.lower(): f.dataType for f in right.schema.fields}
    for field in left.schema.fields:
        other = theirs.get(field.name.lower())
        if other is not None:
            wanted[field.name.lower()] = common_type(field.dataType, other)

    def cast(df: DataFrame) -> DataFrame:
        def one(field: T.StructField) -> Column:
            column, kind = quoted(field.name), wanted.get(field.name.lower(), field.dataType)
            if kind == field.dataType:
                return column
            if isinstance(kind, T.StringType):
                return as_text(column, field.dataType).alias(field.name)
            return column.cast(kind).alias(field.name)

        return df.select(*[one(f) for f in df.schema.fields])

    return cast(left), cast(right)


def union_evolving(left: DataFrame, right: DataFrame) -> DataFrame:
    """All rows of both; a column only one side has is null on the other."""
    left, right = align_types(left, right)
    return left.unionByName(right, allowMissingColumns=True)


def tagged_projection(df: DataFrame, columns: Mapping[str, Column], tag: str) -> DataFrame:
    """A renamed projection that says which source it came from."""
    return df.select(*[c.alias(n) for n, c in columns.items()], F.lit(tag).alias("source"))


def tagged_passes(active: DataFrame, archived: DataFrame) -> DataFrame:
    """Two passes over one source, the pass kept as a flag."""
    return active.withColumn("archived", F.lit(False)).unionByName(
        archived.withColumn("archived", F.lit(True)), allowMissingColumns=True
    )


def missing_labels(wanted: DataFrame, found: DataFrame, column: str = "label") -> DataFrame:
    """Labels asked for and not found."""
    return wanted.select(column).distinct().join(found.select(column).distinct(), column, "left_anti")
