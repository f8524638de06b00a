"""Readers: work documents, registry records, staged citation rows and the registry index."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.schema import CITATION_ROW
from citeloom.sources.archives import read_archives
from citeloom.sources.detect import RegistryInput, WorksInput, detect_registry, detect_works, spark_listing

#: What Spark calls the directory of a partition without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def read_works(spark: SparkSession, path: str, kind: WorksInput | None = None) -> DataFrame:
    """(file_name, value): one row per document. An archive's documents are spread over tasks after the scan.

    Unreadable files and damaged archives fail the read.
    """
    kind = kind or detect_works(path, spark_listing(spark))
    if kind is WorksInput.TAR_GZ:
        return read_archives(spark, path).repartition(spark.sparkContext.defaultParallelism)
    reader = spark.read.option("pathGlobFilter", "*.json") if kind is WorksInput.JSON_DIRECTORY else spark.read
    return reader.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file_name"), "value")


def file_order(file_name) -> list:  # noqa: ANN001
    """Order of documents: numbered ones by number, the others by name behind them."""
    stem = F.regexp_extract(F.col(file_name), r"([^/]*)\.json$", 1)
    number = stem.try_cast("bigint") if hasattr(stem, "try_cast") else F.expr(f"try_cast(regexp_extract({file_name}, '([^/]*)\\\\.json$', 1) AS BIGINT)")
    return [number.asc_nulls_last(), F.col(file_name)]


def read_registry_lines(spark: SparkSession, path: str, kind: RegistryInput | None = None) -> DataFrame:
    """(value): the lines of registry files that are not blank. A nested snapshot has its compressed files only.

    In a directory, a file that can't be read is left out from where it is broken, and Spark logs a warning; a single file fails.
    """
    kind = kind or detect_registry(path, spark_listing(spark))
    if kind is RegistryInput.NESTED_SNAPSHOT:
        lines = spark.read.option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl.gz").text(path)
    elif kind is RegistryInput.FLAT_DIRECTORY:
        lines = spark.read.option("ignoreCorruptFiles", "true").option("pathGlobFilter", "*.{jsonl,jsonl.gz}").text(path)
    else:
        lines = spark.read.text(path)
    return lines.where(F.trim("value") != "")


def read_staged(spark: SparkSession, path: str, parts: list[str] | None = None) -> DataFrame:
    """Staged citation rows with part; parts prunes directories before any file is opened."""
    rows = spark.read.schema(f"{CITATION_ROW}, part string").parquet(path).withColumn("part", F.coalesce("part", F.lit("")))  # Spark writes "" as it writes NULL
    return rows.where(F.col("part").isin(parts)) if parts is not None else rows


def staged_parts(spark: SparkSession, path: str) -> list[str]:
    """The directories of staged rows, in order, from their names alone."""
    found = spark_listing(spark)(path)
    names = [unquote(n.removeprefix("part=")) for n in found[1] if n.startswith("part=")] if found else []
    return sorted("" if n == NO_VALUE else n for n in names)


def count_rows(spark: SparkSession, path: str) -> int:
    """Rows of Parquet files, from their footers."""
    return spark.read.parquet(path).count()


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(id): the registry index."""
    return spark.read.schema("id string").parquet(path)
