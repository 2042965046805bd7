"""Nested arrays to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.text import any_of, as_text, first_nonempty
from tidemark.operators.normalize import quoted
from tidemark.operators.union import common_type

# Fields that mark a subform, and the columns that may name its parent.
SUBFORM_MARKS = ("Site_Percentage", "Site")
PARENT_NAMES = ("Name", "Block_Name", "name")
PARENT_COLUMNS = ("Parent_Id_id", "Parent_Id_name")


def explode_stages(pipelines: DataFrame) -> DataFrame:
    """One row per stage with its pipeline; a pipeline without stages gives none."""
    return pipelines.select(
        F.col("id").alias("pipeline_id"),
        F.col("label").alias("pipeline_label"),
        F.explode("stages").alias("stage"),
    ).select(
        "pipeline_id",
        "pipeline_label",
        F.col("stage.id").alias("stage_id"),
        F.col("stage.label").alias("stage_label"),
        F.col("stage.displayOrder").alias("display_order"),
    )


def _subforms(schema: T.StructType) -> list[T.StructField]:
    return [
        f
        for f in schema.fields
        if isinstance(f.dataType, T.ArrayType)
        and isinstance(f.dataType.elementType, T.StructType)
        and set(SUBFORM_MARKS) & set(f.dataType.elementType.names)
    ]


def explode_subform(parents: DataFrame, key: str = "id") -> DataFrame:
    """One row per subform element with the parent's id and name.

    Of the array columns that look like a subform each parent uses its first
    non-empty one, in column order. Elements of different columns share their fields.
    Parents without such a column give no rows.
    """
    candidates = _subforms(parents.schema)
    if not candidates:
        return parents.select(*_parent(parents, key)).filter(F.lit(False))
    kinds: dict[str, T.DataType] = {}
    for field in candidates:
        for inner in field.dataType.elementType.fields:
            kinds[inner.name] = common_type(kinds.get(inner.name, inner.dataType), inner.dataType)

    def elements(field: T.StructField) -> Column:
        have = field.dataType.elementType

        def part(item: Column, name: str) -> Column:
            kind = kinds[name]
            if name not in have.names:
                return F.lit(None).cast(kind)
            if isinstance(kind, T.StringType):
                return as_text(item.getField(name), have[name].dataType)
            return item.getField(name).cast(kind)

        return F.transform(
            quoted(field.name),
            lambda item: F.struct(*[part(item, name).alias(name) for name in kinds]),
        )

    picked = F.lit(None)
    for field in reversed(candidates):
        rows = elements(field)
        picked = F.when(F.size(rows) > 0, rows).otherwise(picked)

    return parents.select(F.explode(picked).alias("split"), *_parent(parents, key)).select(
        "split.*", *PARENT_COLUMNS
    )


def _parent(parents: DataFrame, key: str) -> list[Column]:
    names = [quoted(n).cast("string") for n in PARENT_NAMES if n in parents.columns]
    return [
        F.coalesce(quoted(key).cast("string"), F.lit("")).alias("Parent_Id_id"),
        first_nonempty(*names).alias("Parent_Id_name"),
    ]


def subform_elements(parents: DataFrame, key: str = "id") -> DataFrame:
    """The same for parents whose arrays are JSON text: one variant ``element`` per row."""
    picked = F.lit(None).cast("variant")
    for field in reversed(parents.schema.fields):
        if not isinstance(field.dataType, T.StringType):
            continue
        text = quoted(field.name)
        value = F.when(text.startswith("["), F.try_parse_json(text))
        marks = [F.try_variant_get(value, f"$[0].{mark}", "variant") for mark in SUBFORM_MARKS]
        picked = F.when(any_of([m.isNotNull() for m in marks]), value).otherwise(picked)
    chosen = parents.select(picked.alias("subform"), *_parent(parents, key))
    each = parents.sparkSession.tvf.variant_explode(F.col("subform").outer())
    return chosen.lateralJoin(each).select(F.col("value").alias("element"), *PARENT_COLUMNS)
