"""Association arrays and id lists."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.text import blank_to_null, strip


def association_ids(entries: Column) -> Column:
    """Distinct ids of an association array, sorted and comma-joined; null when none."""
    ids = F.transform(entries, lambda e: e["id"].cast("string"))
    given = F.filter(ids, lambda i: i.isNotNull() & (i != ""))
    return blank_to_null(F.array_join(F.array_sort(F.array_distinct(given)), ","))


def first_association(entries: Column) -> Column:
    """Id of the first entry, null for a missing or empty array."""
    return F.get(entries, F.lit(0))["id"].cast("string")


def split_ids(text: Column) -> Column:
    """Array of the trimmed, non-blank parts of a comma-joined id list."""
    parts = F.transform(F.split(text, ","), strip)
    return F.filter(parts, lambda p: p != "")
