"""The registry index and membership in it: existence, semi and anti joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.functions.jsonvalue import with_variant


def _ids(lines: DataFrame, value: str) -> DataFrame:
    return with_variant(lines.select(F.col(value).alias("value")), F.col("value"), "v").select(F.try_variant_get("v", "$.id", "variant").alias("i"))


def registry_ids(lines: DataFrame, value: str = "value") -> DataFrame:
    """(id): distinct lower-case ids of JSON lines; lines without a string id, or not JSON, are skipped, empty ids too."""
    found = _ids(lines, value).where((F.schema_of_variant("i") == "STRING") & F.col("i").isNotNull())
    return index_of(found.select(F.try_variant_get("i", "$", "string").alias("id")), "id")


def registry_stats(lines: DataFrame, value: str = "value") -> DataFrame:
    """One row: lines, lines_skipped, ids (distinct)."""
    each = _ids(lines, value).select(F.when(F.schema_of_variant("i") == "STRING", F.try_variant_get("i", "$", "string")).alias("id"))
    return each.agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col("id").isNull()).alias("lines_skipped"), F.countDistinct(F.nullif(F.lower("id"), F.lit(""))).alias("ids"))


def index_of(records: DataFrame, id_column: str) -> DataFrame:
    """(id): distinct lower-case ids; NULL and empty ones are left out."""
    return records.select(F.lower(F.col(id_column)).alias("id")).where("id <> ''").distinct()


def with_validity(works: DataFrame, index: DataFrame | None, key: str = "cited_id") -> DataFrame:
    """Adds is_valid: whether the lower-case key is in the index. Without an index no work is valid.

    The index is distinct, so no row is repeated. Spark broadcasts it where its measured size allows, else it shuffles;
    works come one row per work, so no key is hot.
    """
    if index is None:
        return works.withColumn("is_valid", F.lit(False))
    hit = index.select(F.col("id").alias("__id"), F.lit(True).alias("__hit"))
    return works.join(hit, F.lower(F.col(key)) == F.col("__id"), "left").withColumn("is_valid", F.coalesce("__hit", F.lit(False))).drop("__id", "__hit")


def valid_works(works: DataFrame, index: DataFrame, key: str = "cited_id") -> DataFrame:
    """Works in the index."""
    return works.join(index.select(F.col("id").alias("__id")), F.lower(F.col(key)) == F.col("__id"), "left_semi")


def failed_works(works: DataFrame, index: DataFrame, key: str = "cited_id") -> DataFrame:
    """Works not in the index, those without a key included."""
    return works.join(index.select(F.col("id").alias("__id")), F.lower(F.col(key)) == F.col("__id"), "left_anti")


def unfinished(files: DataFrame, manifest: DataFrame, key: str = "file_name") -> DataFrame:
    """Files that the manifest does not list as done."""
    return files.join(manifest.where("status = 'done'").select(key), key, "left_anti")
