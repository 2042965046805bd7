"""Shape records into flat, cleanly named, safely typed columns."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.text import as_text, null_if_token

NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)


def loader_name(name: str) -> str:
    """``$`` deleted; dash, dot and space to underscore; no leading digit."""
    flat = re.sub(r"[-. ]", "_", name.replace("$", ""))
    return f"_{flat}" if flat[:1].isdigit() else flat


def strict_name(name: str) -> str:
    """One leading ``$`` deleted; anything but letters, digits, underscore replaced."""
    flat = re.sub(r"[^a-zA-Z0-9_]", "_", name.removeprefix("$"))
    return f"_{flat}" if flat[:1].isdigit() else flat


def quoted(name: str) -> Column:
    """Column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def project_last(df: DataFrame, pairs: Iterable[tuple[str, Column]]) -> DataFrame:
    """Select named columns; of names equal but for case the last one wins.

    The result keeps the first position of a repeated name. Empty names are dropped.
    """
    chosen: dict[str, tuple[str, Column]] = {}
    for name, column in pairs:
        if name:
            chosen[name.lower()] = (name, column)
    return df.select(*[column.alias(name) for name, column in chosen.values()])


def flatten_one_level(df: DataFrame) -> DataFrame:
    """Each struct column becomes ``column_field`` columns; deeper levels stay."""
    pairs: list[tuple[str, Column]] = []
    for field in df.schema.fields:
        parent = quoted(field.name)
        if isinstance(field.dataType, T.StructType):
            pairs += [
                (f"{field.name}_{inner}", parent.getField(inner))
                for inner in field.dataType.names
            ]
        else:
            pairs.append((field.name, parent))
    return project_last(df, pairs)


def rename_all(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    return project_last(df, [(rule(name), quoted(name)) for name in df.columns])


def sanitize_columns(df: DataFrame) -> DataFrame:
    return rename_all(df, loader_name)


def sanitize_columns_strict(df: DataFrame) -> DataFrame:
    return rename_all(df, strict_name)


def normalize_values(df: DataFrame) -> DataFrame:
    """Nested values to JSON text; booleans and numbers kept; the rest to text."""

    def value(field: T.StructField) -> Column:
        column = quoted(field.name)
        if isinstance(field.dataType, (T.BooleanType, T.NumericType)):
            return column
        return as_text(column, field.dataType)

    return df.select(*[value(f).alias(f.name) for f in df.schema.fields])


def _texts(df: DataFrame, wanted: Callable[[str], bool]) -> DataFrame:
    return df.select(
        *[
            (as_text(quoted(f.name), f.dataType) if wanted(f.name) else quoted(f.name)).alias(f.name)
            for f in df.schema.fields
        ]
    )


def ids_to_string(df: DataFrame) -> DataFrame:
    """Columns whose name ends in ``id`` (any case) become text."""
    return _texts(df, lambda name: name.lower().endswith("id"))


def stringify_all(df: DataFrame) -> DataFrame:
    return _texts(df, lambda name: True)


def null_tokens(df: DataFrame) -> DataFrame:
    """Texts that stand for a missing value become null."""
    return df.select(
        *[
            null_if_token(quoted(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else quoted(f.name)
            for f in df.schema.fields
        ]
    )


def for_loading(df: DataFrame) -> DataFrame:
    """Flatten, rename and normalise, as records are staged by the incremental load."""
    return normalize_values(sanitize_columns(flatten_one_level(df)))


def for_full_refresh(df: DataFrame) -> DataFrame:
    """Flatten, rename strictly and turn everything to text, as the full refresh does."""
    return null_tokens(stringify_all(sanitize_columns_strict(flatten_one_level(df))))
