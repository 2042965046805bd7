"""Landed pages: every page written, and fewer bytes than plain JSON."""

from __future__ import annotations

import glob

from pyspark.sql import functions as F

from tidemark.sources.pages import read_object_pages
from tidemark.workloads.scans import land


def test_landed_pages_are_compressed_and_whole(spark):
    pages = spark.range(200).select(
        F.array(F.struct(F.col("id").cast("string").alias("id"), F.create_map(F.lit("name"), F.lit("x" * 50)).alias("properties"))).alias("results")
    )
    path = land(pages, "pages")
    files = [f for f in glob.glob(f"{path}/part-*")]
    assert files and all(f.endswith(".json.gz") for f in files)
    read = read_object_pages(spark, path).select(F.explode("results").alias("r"))
    assert sorted(int(r["id"]) for r in read.select("r.id").collect()) == list(range(200))
