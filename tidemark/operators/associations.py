"""Linked entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.arrays import split_ids


def explode_id_list(parents: DataFrame, column: str, name: str = "id") -> DataFrame:
    """Distinct ids named in comma-joined lists."""
    return parents.select(F.explode(split_ids(F.col(column))).alias(name)).distinct()


def lookup_by_ids(entities: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Rows of the entities whose key is among the ids."""
    wanted = ids.select(F.col(ids.columns[0]).alias(key)).distinct()
    return entities.join(wanted, key, "left_semi")


def referenced_only(
    entities: DataFrame, parents: DataFrame, column: str, key: str = "id"
) -> DataFrame:
    """Entities that some parent's id list names."""
    return lookup_by_ids(entities, explode_id_list(parents, column, key), key)


def association_catchup(
    children: DataFrame, parents: DataFrame, entities: DataFrame, column: str, key: str = "id"
) -> DataFrame:
    """The child delta plus the entities its parents name that are not yet in it."""
    named = explode_id_list(parents, column, key)
    absent = named.join(children.select(key).distinct(), key, "left_anti")
    return children.unionByName(
        entities.join(absent, key, "left_semi"), allowMissingColumns=True
    )
