"""Projections that depend on a catalog or on the columns present."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.text import as_text, blank_to_null, canonical_amount
from tidemark.operators.normalize import quoted

# The properties read of an object when its catalog is unavailable, and
# the ones whose absence is reported.
DEFAULT_PROPERTIES = {
    "deals": ("dealname", "amount", "dealstage", "pipeline", "closedate"),
    "companies": ("name", "domain"),
}
REQUIRED_PROPERTIES = {"deals": ("bidding",)}


def visible_names(catalog: DataFrame) -> list[str]:
    """Names of a property catalog that are not hidden; a missing flag means visible.

    The catalog lists the columns of one table, so the driver reads a schema, not data.
    """
    shown = catalog.filter(~F.coalesce(F.col("hidden"), F.lit(False)))
    return [row["name"] for row in shown.select("name").collect()]


def project_visible(
    df: DataFrame, catalog: DataFrame | None, default: Sequence[str] = ()
) -> DataFrame:
    """Keep the visible columns, or the default ones where no catalog is available."""
    names = set(default) if catalog is None else set(visible_names(catalog))
    return df.select(*[quoted(name) for name in df.columns if name in names])


def promote_properties(df: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    """Lift the named keys of a map column to columns of their own; of keys equal but for
    case the last one that has a value."""
    by_name: dict[str, list[str]] = {}
    for name in names:
        by_name.setdefault(name.lower(), []).append(name)
    lifted = [
        F.coalesce(*[F.try_element_at(F.col(column), F.lit(n)) for n in reversed(same)]).alias(same[-1])
        for same in by_name.values()
    ]
    return df.select(*lifted, *[quoted(c) for c in df.columns if c != column])


def lookup_struct(df: DataFrame, name: str) -> tuple[Column, Column]:
    """(id, name) texts of a lookup: from its struct, else from flattened columns."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    kind = fields.get(name)

    def part(field: str) -> Column:
        if isinstance(kind, T.StructType):
            if field not in kind.names:
                return F.lit(None).cast("string")
            return as_text(quoted(name).getField(field), kind[field].dataType)
        flat = f"{name}_{field}"
        if flat not in fields:
            return F.lit(None).cast("string")
        return as_text(quoted(flat), fields[flat])

    return blank_to_null(part("id")), blank_to_null(part("name"))


def fuzzy_amount(df: DataFrame, preferred: str = "Amount") -> Column:
    """Canonical text of the preferred column, else of the first non-null column whose
    name mentions an amount; of a ``{currency, value}`` struct, also a flattened one, the
    value counts."""
    names = set(df.columns)
    similar = [
        f
        for f in df.schema.fields
        if "amount" in f.name.lower()
        and not (f.name.endswith("_currency") and f"{f.name[:-9]}_value" in names)
    ]
    first = (preferred, f"{preferred}_value")
    ordered = sorted(similar, key=lambda f: first.index(f.name) if f.name in first else len(first))
    picked = F.lit(None).cast("string")
    for field in reversed(ordered):
        column, kind = quoted(field.name), field.dataType
        text = as_text(column, kind)
        if isinstance(kind, T.StructType) and "value" in kind.names:
            text = as_text(column.getField("value"), kind["value"].dataType)
        picked = F.when(column.isNotNull(), text).otherwise(picked)
    return canonical_amount(picked)
