"""Landed API pages: one JSON envelope per line.

Two envelopes are read. A module page is ``{page, data: [record], info: {more_records}}``.
An object page is ``{results: [{id, properties, createdAt, updatedAt, archived,
associations}], paging: {next: {after}}}``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.arrays import association_ids, first_association
from tidemark.operators.select import promote_properties

_LINKS = "struct<results: array<struct<id: string>>>"
_OBJECT = (
    "struct<id: string, properties: map<string,string>, createdAt: string, updatedAt: string,"
    f" archived: boolean, associations: struct<companies: {_LINKS}, deals: {_LINKS}>>"
)
OBJECT_PAGE = f"results array<{_OBJECT}>, paging struct<next: struct<after: string>>, unreadable string"

# A table of more columns is taken for a mistake.
MAX_PROPERTIES = 10_000

# The properties read of a line item.
LINE_ITEM_PROPERTIES = (
    "name",
    "price",
    "quantity",
    "amount",
    "hs_product_id",
    "description",
    "recurringbillingfrequency",
    "hs_recurring_billing_start_date",
    "lastmodifieddate",
)


def read_object_pages(spark: SparkSession, *paths: str) -> DataFrame:
    """Object pages; a line that is no JSON, or no such page, stands whole in ``unreadable``."""
    return read_result_pages(spark, OBJECT_PAGE, *paths)


def read_result_pages(spark: SparkSession, schema: str, *paths: str) -> DataFrame:
    """Pages of a schema with ``results``, ``paging`` and ``unreadable``, and when their file was written."""
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", "unreadable").option("recursiveFileLookup", "true")
    read = reader.json(list(paths))
    return read.withColumn("written_at", F.col("_metadata.file_modification_time"))


def readable(pages: DataFrame) -> DataFrame:
    """Pages without the lines that could not be read, whose results may be cut."""
    return pages.filter(F.col("unreadable").isNull())


def property_names(pages: DataFrame) -> list[str]:
    """Every property name the pages mention: the columns of the table to come."""
    objects = pages.select(F.explode("results").alias("r"))
    names = objects.select(F.explode(F.map_keys("r.properties")).alias("name")).distinct()
    found = names.limit(MAX_PROPERTIES + 1).collect()
    if len(found) > MAX_PROPERTIES:
        raise ValueError(f"more than {MAX_PROPERTIES} different properties")
    return sorted(row["name"] for row in found)


#: Columns of an object beside its properties.
OBJECT_COLUMNS = ("id", "createdAt", "updatedAt", "archived", "associated_company_ids")


def unwrap_objects(
    pages: DataFrame, properties: Sequence[str], *, companies: bool = False
) -> DataFrame:
    """One row per object: its named properties, id, stamps and archived flag, and on
    request the ids of its associated companies."""
    columns = [
        F.col("r.properties").alias("properties"),
        F.col("r.id").alias("id"),
        F.col("r.createdAt").alias("createdAt"),
        F.col("r.updatedAt").alias("updatedAt"),
        F.coalesce(F.col("r.archived"), F.lit(False)).alias("archived"),
    ]
    if companies:
        links = F.col("r.associations.companies.results")
        columns.append(association_ids(links).alias("associated_company_ids"))
    objects = pages.select(F.explode("results").alias("r")).select(*columns)
    own = {c.lower() for c in objects.columns}
    return promote_properties(objects, "properties", [p for p in properties if p.lower() not in own])


def unwrap_line_items(
    pages: DataFrame, properties: Sequence[str] = LINE_ITEM_PROPERTIES
) -> DataFrame:
    """One row per line item: its properties, id and first associated deal."""
    deals = F.col("r.associations.deals.results")
    items = pages.select(F.explode("results").alias("r")).select(
        F.col("r.properties").alias("properties"),
        F.col("r.id").alias("id"),
        first_association(deals).alias("associated_deal_id"),
    )
    return promote_properties(items, "properties", properties)


def read_module_pages(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    """Module pages whose records have the given fields; others are ignored."""
    page = T.StructType(
        [
            T.StructField("page", T.LongType()),
            T.StructField("data", T.ArrayType(record)),
            T.StructField(
                "info",
                T.StructType(
                    [T.StructField("more_records", T.BooleanType()), T.StructField("page", T.LongType())]
                ),
            ),
            T.StructField("unreadable", T.StringType()),
        ]
    )
    read = spark.read.schema(page).option("columnNameOfCorruptRecord", "unreadable").json(path)
    return read.withColumn("page", F.coalesce("page", "info.page"))


def read_variant_pages(spark: SparkSession, *paths: str) -> DataFrame:
    """Module pages whose records have no schema: ``data`` is a variant array.

    The page number stands at the top or in ``info``. A line that is no JSON is kept
    whole in ``unreadable``.
    """
    page = F.try_parse_json("value")

    def number(place: str) -> Column:
        return F.try_variant_get(page, place, "bigint")

    return spark.read.option("recursiveFileLookup", "true").text(list(paths)).select(
        F.coalesce(number("$.page"), number("$.info.page")).alias("page"),
        F.try_variant_get(page, "$.data", "variant").alias("data"),
        F.struct(
            F.try_variant_get(page, "$.info.more_records", "boolean").alias("more_records")
        ).alias("info"),
        F.when(page.isNull() & (F.trim("value") != ""), F.col("value")).alias("unreadable"),
        F.col("_metadata.file_modification_time").alias("written_at"),
    )


def variant_records(pages: DataFrame) -> DataFrame:
    """One variant ``record`` per element of the pages' data."""
    each = pages.sparkSession.tvf.variant_explode(F.col("data").outer())
    return pages.select("data").lateralJoin(each).select(F.col("value").alias("record"))


def landed_records(pages: DataFrame) -> DataFrame:
    """(record, unreadable): one row per element of the pages' data, and per line that is
    no JSON; read from the pages in one pass."""
    each = pages.sparkSession.tvf.variant_explode_outer(F.col("data").outer())
    rows = pages.select("data", "unreadable").lateralJoin(each)
    found = F.col("value").isNotNull() | F.col("unreadable").isNotNull()
    return rows.filter(found).select(F.col("value").alias("record"), "unreadable")


def landed_pages(pages: DataFrame) -> DataFrame:
    """(page, more, written_at, record, unreadable): a row per record, page without records, and unreadable line."""
    each = pages.sparkSession.tvf.variant_explode_outer(F.col("data").outer())
    named = pages.select("page", F.col("info.more_records").alias("more"), "written_at", "data", "unreadable")
    rows = named.lateralJoin(each)
    return rows.select("page", "more", "written_at", F.col("value").alias("record"), "unreadable")


def page_facts(landed: DataFrame, records: Column) -> DataFrame:
    """(page, more, records, unreadable) of landed pages, one row a number.

    Of a page that came twice the one written last counts; pages without numbers announce
    more if all of them do. Lines that could not be read are no pages.
    """
    read = F.col("unreadable").isNull()
    by_page = landed.filter(read).groupBy("page").agg(
        F.when(F.first("page").isNull(), F.bool_and(F.coalesce("more", F.lit(False)))).otherwise(F.max_by("more", "written_at")).alias("more"),
        F.sum(records).cast("long").alias("records"),
    )
    return by_page.select("page", "more", "records", F.lit(0).cast("long").alias("unreadable"))


def unwrap_module_pages(pages: DataFrame) -> DataFrame:
    return pages.select(F.explode("data").alias("r")).select("r.*")


def feed_complete(pages: DataFrame) -> DataFrame:
    """One row: did the fetch reach its last page, and is no page before it missing?

    Only a page that says so is the last one; a line that could not be read makes the
    feed incomplete, as do unnumbered pages among numbered ones. Pages without numbers
    are complete when one of them announces no further page. A cut feed must not be
    taken for deletions.
    """
    more = F.col("info.more_records")
    lost = F.col("unreadable").isNotNull() if "unreadable" in pages.columns else F.lit(False)
    facts = pages.agg(
        F.max("page").alias("last_page"),
        F.count_distinct("page").alias("pages"),
        F.max_by(more, "page").alias("more"),
        F.bool_or(~more).alias("ended"),
        F.bool_or(lost | (F.col("page").isNull() & more.isNull())).alias("lost"),
        F.count_if(F.col("page").isNull()).alias("unnumbered"),
    )
    whole = (F.col("more") == F.lit(False)) & (F.col("pages") == F.col("last_page")) & (F.col("unnumbered") == 0)
    complete = F.when(F.col("last_page").isNull(), F.col("ended")).otherwise(whole) & ~F.col("lost")
    return facts.select("last_page", "pages", F.coalesce(complete, F.lit(False)).alias("complete"))


def cursor_complete(pages: DataFrame) -> DataFrame:
    """One row: does a cursor feed end, that is, have a page without a next cursor?

    A line that could not be read has no results and makes the feed incomplete; so does
    a feed without pages.
    """
    read = F.col("results").isNotNull()
    return pages.agg(
        F.coalesce(F.bool_or(read & F.col("paging.next.after").isNull()) & F.bool_and(read), F.lit(False)).alias("complete")
    )
