"""Configured labels to catalog names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.text import norm_label
from tidemark.operators.ranking import latest_per_key


def resolve_labels(
    catalog: DataFrame, labels: Sequence[str], *, sequence: str = "sequence"
) -> DataFrame:
    """(label, api_name) for every configured label.

    In catalog order each entry offers its plural label, singular label and api name,
    and takes the first of them that names a label nobody has taken. A label without
    an entry stands for itself.

    Of the entries that offer a label only the first ``len(labels)`` can matter: all
    but one label can go to entries ahead of the one that gets it. So the choice runs
    over at most ``3 * len(labels) ** 2`` offers, however long the catalog is.
    """
    spark = catalog.sparkSession
    by_norm: dict[str, str] = {}
    for label in labels:
        by_norm[label.replace("_", "").replace(" ", "").lower()] = label
    if not by_norm:
        return spark.createDataFrame([], "label string, api_name string")
    names = F.create_map(*[F.lit(x) for pair in by_norm.items() for x in pair])

    offered = F.posexplode(F.array("plural_label", "singular_label", "api_name")).alias("turn", "text")
    offers = (
        catalog.select(sequence, "api_name", offered)
        .filter(norm_label(F.col("text")).isin(*by_norm))
        .select(
            F.col(sequence).alias("seq"),
            "turn",
            names[norm_label(F.col("text"))].alias("label"),
            "api_name",
        )
    )
    rank = F.row_number().over(Window.partitionBy("label").orderBy("seq", "api_name", "turn"))
    relevant = offers.withColumn("rank", rank).filter(F.col("rank") <= 3 * len(by_norm))

    ordered = relevant.agg(
        F.array_sort(F.collect_list(F.struct("seq", "turn", "label", "api_name"))).alias("offers")
    )
    start = F.struct(
        F.expr("cast(map() as map<string,string>)").alias("taken"),
        F.expr("cast(array() as array<string>)").alias("served"),
    )

    def take(state, offer):
        entry = F.concat_ws("\x1f", offer["seq"].cast("string"), offer["api_name"])
        free = ~F.map_contains_key(state["taken"], offer["label"]) & ~F.array_contains(
            state["served"], entry
        )
        won = F.struct(
            F.map_concat(state["taken"], F.create_map(offer["label"], offer["api_name"])).alias("taken"),
            F.array_append(state["served"], entry).alias("served"),
        )
        return F.when(free, won).otherwise(state)

    taken = ordered.select(F.aggregate("offers", start, take)["taken"].alias("taken"))
    wanted = F.explode(F.array(*[F.lit(x) for x in dict.fromkeys(labels)])).alias("label")
    return taken.select(wanted, "taken").select(
        "label",
        F.coalesce(F.try_element_at("taken", F.col("label")), F.col("label")).alias("api_name"),
    )


def resolve_labels_exact(
    catalog: DataFrame, labels: Sequence[str], *, sequence: str = "sequence"
) -> DataFrame:
    """(label, api_name): the catalog entries whose plural label or api name is a
    configured label, by plural label, the last entry winning; plus the configured
    labels no entry has, with a null name.

    The labels are configuration, so the match is a filter of the scan, not a join.
    """
    wanted = list(dict.fromkeys(labels))
    matched = catalog.filter(
        F.col("plural_label").isNotNull()
        & (F.col("plural_label").isin(wanted) | F.col("api_name").isin(wanted))
    ).select(F.col("plural_label").alias("label"), "api_name", F.col(sequence).alias("seq"))
    last = latest_per_key(
        matched, ["label"], [F.col("seq").desc(), F.col("api_name").desc()]
    ).drop("seq")
    asked = catalog.sparkSession.createDataFrame([(x,) for x in wanted], "label string")
    return last.unionByName(
        asked.join(last.select("label"), "label", "left_anti"), allowMissingColumns=True
    )


def discovered_names(resolved: DataFrame, default: Sequence[str]) -> list[str]:
    """Api names of the resolved labels, or the default ones where none was found.

    They are the modules a run goes through, so the driver reads them.
    """
    found = resolved.filter(F.col("api_name").isNotNull()).select("api_name").distinct()
    return sorted(row["api_name"] for row in found.collect()) or list(default)
