"""A data source for gzipped tar archives of JSON documents; Spark reads none."""

from __future__ import annotations

import gzip
import json
import tarfile
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from citeloom.schema import RAW_FILE
from citeloom.session import hadoop_path
from citeloom.sources.detect import spark_listing

#: Names that other libraries have for the schemes of Hadoop's file systems.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


class ArchivePart(InputPartition):
    """One archive; a gzipped stream can't be split."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.path = path


class ArchiveReader(DataSourceReader):
    def __init__(self, paths: list[str]) -> None:
        self.paths = paths

    def partitions(self) -> list[ArchivePart]:
        return [ArchivePart(p) for p in self.paths]

    def read(self, partition: ArchivePart) -> Iterator[tuple[str, str]]:
        """Members whose path ends in .json, streamed in their order; a damaged archive fails the task."""
        scheme, colon, rest = partition.path.partition(":")
        files, path = fs.FileSystem.from_uri(_SCHEMES.get(scheme, scheme) + colon + rest)
        with files.open_input_stream(path, compression=None) as raw, gzip.open(raw) as plain, tarfile.open(fileobj=plain, mode="r|") as archive:
            for member in archive:
                if member.isfile() and member.name.endswith(".json"):
                    yield member.name, archive.extractfile(member).read().decode("utf-8", "replace")
            while plain.read(1 << 20):  # to the end, where a cut is noticed
                pass


class ArchiveSource(DataSource):
    """format("json_archives") with the option archives, a JSON list of addresses: one row per document of each."""

    @classmethod
    def name(cls) -> str:
        return "json_archives"

    def schema(self) -> str:
        return RAW_FILE

    def reader(self, schema) -> ArchiveReader:  # noqa: ANN001
        return ArchiveReader(json.loads(self.options["archives"]))


def archives_at(spark: SparkSession, path: str) -> list[str]:
    """Addresses, with their schemes, of the archive at a path, or of all in the directory there."""
    found = spark_listing(spark)(path)
    names = [path] if found is None else [f"{path.rstrip('/')}/{n}" for n in sorted(found[0]) if n.lower().endswith(".tar.gz")]
    out = []
    for name in names:
        files, target = hadoop_path(spark, name)
        address = files.makeQualified(target).toString()
        out.append(address if "://" in address else address.replace("file:/", "file:///", 1))
    return out


def read_archives(spark: SparkSession, path: str):  # noqa: ANN201
    """(file_name, value) of the documents of an archive, or of all archives in a directory."""
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("json_archives").option("archives", json.dumps(archives_at(spark, path))).load()
