"""Reconciliation of what should be in the store with what is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eqscene.functions.scalars import delivery_key


def expected_keys(manifest: DataFrame, prefix: str) -> DataFrame:
    """``key`` of each file and browse image of a manifest; rows without a year are skipped."""
    files = manifest.select(
        "name", "year", F.explode(F.concat(F.transform("files", lambda f: f["filename"]), F.coalesce("browse_images", F.array()))).alias("file")
    )
    event = F.regexp_extract("name", r"^(.*)-([^-]*)$", 1)
    return files.filter("year IS NOT NULL").select("name", "file", delivery_key(prefix, F.col("year"), event, F.col("file")).alias("key"))


def missing(expected: DataFrame, listing: DataFrame) -> DataFrame:
    return expected.join(listing.select("key"), "key", "left_anti")


def present(expected: DataFrame, listing: DataFrame) -> DataFrame:
    return expected.join(listing.select("key"), "key", "left_semi")


def dirs_without(dirs: DataFrame, listing: DataFrame, ext: str = ".png") -> DataFrame:
    """Directories (``dir``) with no key of an ending anywhere below: an equi-join on all parents of such keys."""
    parts = F.split("key", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    having = listing.filter(F.col("key").endswith(ext) & F.col("key").contains("/")).select(F.explode(above).alias("dir")).distinct()
    return dirs.select("dir").distinct().join(having, "dir", "left_anti")


def missing_local(expected: DataFrame, local: DataFrame) -> DataFrame:
    return expected.join(local.select("file"), "file", "left_anti")


def delivery_totals(expected: DataFrame, listing: DataFrame) -> DataFrame:
    """Present and missing in one pass."""
    there = listing.select("key", F.lit(True).alias("there")).distinct()
    return expected.join(there, "key", "left").agg(
        F.count_if(F.col("there")).alias("n_present"), F.count_if(F.col("there").isNull()).alias("n_missing")
    )


def product_boxes(products: DataFrame) -> DataFrame:
    """``filename, earthquake_name, magnitude`` and the box of each product's ring."""
    from eqscene.functions.scalars import event_from_path, name_magnitude
    from eqscene.sources.readers import ring_box

    event = event_from_path(F.col("path"))
    return products.select(
        F.substring_index("path", "/", -1).alias("filename"),
        F.lit("productBoundingBox").alias("source_layer"),
        event.alias("earthquake_name"),
        name_magnitude(event, "tenths").alias("magnitude"),
        ring_box(F.col("ring")).alias("box"),
    )
