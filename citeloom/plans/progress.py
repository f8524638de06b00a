"""What a run has finished, as small JSON files on any file system, written whole or not at all."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from citeloom.session import hadoop_path


def write_json(spark: SparkSession, path: str, value: object) -> None:
    """Write a value under another name and rename it: a reader sees the old file or the new one. A stale other name is replaced."""
    files, target = hadoop_path(spark, path)
    _, draft = hadoop_path(spark, f"{path}.tmp")
    out = files.create(draft, True)
    out.write(json.dumps(value).encode())
    out.close()
    files.delete(target, False)
    if not files.rename(draft, target):
        raise OSError(f"{path}.tmp could not be renamed")


def read_json(spark: SparkSession, path: str) -> object | None:
    """The value in a file of write_json, None if there is none. Where the run ended just before its rename, the draft is taken."""
    for name in (path, f"{path}.tmp"):
        files, target = hadoop_path(spark, name)
        if files.exists(target):
            stream = files.open(target)
            text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            try:
                return json.loads(text)
            except ValueError:
                return None
    return None


@dataclass(frozen=True)
class Progress:
    """Directories that are aggregated, in so many commits, and the sums of their counters."""

    parts: frozenset[str] = frozenset()
    commits: int = 0
    counters: dict[str, int] = field(default_factory=dict)

    def after(self, parts: list[str], counted: dict[str, int]) -> Progress:
        """This with one commit more."""
        return Progress(self.parts | set(parts), self.commits + 1, {k: self.counters.get(k, 0) + v for k, v in counted.items()})

    def save(self, spark: SparkSession, path: str) -> None:
        write_json(spark, path, {"parts": sorted(self.parts), "commits": self.commits, "counters": self.counters})

    @staticmethod
    def load(spark: SparkSession, path: str) -> Progress:
        """What was saved, nothing where there is none."""
        held = read_json(spark, path)
        return Progress(frozenset(held["parts"]), held["commits"], held["counters"]) if isinstance(held, dict) else Progress()
