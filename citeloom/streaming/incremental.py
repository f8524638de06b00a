"""Resumable ingest of a directory of work documents with Structured Streaming.

The file source's checkpoint is the list of finished documents: rows are durable in the staged table before a batch is
committed, and a document is read once however often the run is started. Documents that fail are kept in a manifest,
as the source counts them as read; retry_failed reads them again in a batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from citeloom.functions.arxiv import partition_key
from citeloom.operators.extraction import citations_of, document_references, document_status
from citeloom.operators.registry import unfinished
from citeloom.session import materialize, scratch
from citeloom.sources.inputs import read_works

MANIFEST = "file_name string, status string, batch bigint"


def _append(batch: DataFrame, batch_id: int, staged: str, manifest: str, allowed: Sequence[str]) -> None:
    """Write one batch under its own number: a batch that is repeated after a failure replaces what it wrote. Each document is read and parsed once."""
    spark = batch.sparkSession
    with scratch(spark):
        references = materialize(document_references(batch), "batch-references")
        rows = citations_of(references, allowed).withColumn("part", partition_key(F.col("cited_id")))
        rows.write.mode("overwrite").partitionBy("part").option("compression", "zstd").parquet(f"{staged}/batch={batch_id}")
        done = document_status(references).withColumn("batch", F.lit(batch_id).cast("bigint"))
        done.write.mode("overwrite").parquet(f"{manifest}/batch={batch_id}")


def ingest(spark: SparkSession, directory: str, staged: str, manifest: str, checkpoint: str, allowed: Sequence[str] = (), max_files: int = 25) -> StreamingQuery:
    """Start a run over the documents that no run has read yet; it ends when there are none left.

    max_files bounds the documents of one batch, and so the work that a failure repeats.
    """
    files = spark.readStream.format("text").option("wholetext", "true").option("pathGlobFilter", "*.json").option("maxFilesPerTrigger", max_files).load(directory)
    named = files.select(F.col("_metadata.file_name").alias("file_name"), "value")
    return named.writeStream.foreachBatch(lambda batch, i: _append(batch, i, staged, manifest, allowed)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """(file_name, status) of all documents read so far; done outweighs failed."""
    rows = spark.read.schema("file_name string, status string").option("recursiveFileLookup", "true").parquet(manifest)
    return rows.groupBy("file_name").agg(F.min("status").alias("status"))


def read_ingested(spark: SparkSession, staged: str) -> DataFrame:
    """All staged rows of all batches."""
    return spark.read.option("basePath", staged).parquet(f"{staged}/batch=*").drop("batch")


def retry_failed(spark: SparkSession, directory: str, staged: str, manifest: str, number: int, allowed: Sequence[str] = ()) -> None:
    """Read all documents of directory that are not done again, as the batch -number."""
    if number < 1:
        raise ValueError("number must be at least 1")
    left = unfinished(read_works(spark, directory), read_manifest(spark, manifest))
    _append(left, -number, staged, manifest, allowed)
