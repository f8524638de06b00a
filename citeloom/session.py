"""Session settings, the shared folder, and tables written there to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What the library relies on; none of it is about the size of a machine.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "citeloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with SETTINGS; conf overrides them (dots written as two underscores)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Where it is unset, a temporary folder is chosen once and kept in the session, in local mode only: elsewhere executors
    would each write to a disk of their own, so that is an error.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("citeloom.shared.dir", "")
    if not named:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        named = "file://" + tempfile.mkdtemp(prefix="citeloom-")
        spark.conf.set("citeloom.shared.dir", named)
        spark.sparkContext.setCheckpointDir(named)
        _delete_at_exit(spark, named)
    return named.rstrip("/")


def hadoop_path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system of a path, and the path, as the JVM has them."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _delete_at_exit(spark: SparkSession, path: str) -> None:
    files, target = hadoop_path(spark, path)
    files.deleteOnExit(target)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on any file system; nothing happens if there is none."""
    files, target = hadoop_path(spark, path)
    files.delete(target, True)


#: Tables of the runs that are open, one list each.
_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Delete the tables that materialize writes inside, and the paths that are added to the list, when it ends.

    For runs that have written all they want by then; frames that were returned can't be read any more.
    """
    own: list[str] = []
    _scratch.append(own)
    try:
        yield own
    finally:
        _scratch.remove(own)
        for path in own:
            delete(spark, path)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run has."""
    return f"{shared_dir(spark)}/citeloom-{uuid.uuid4().hex}-{label}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: a lineage cut that survives lost executors.

    Parquet rather than checkpoint(): later readers prune columns and push filters into it. The table is removed at
    the end of the scratch() around it, or when the driver's JVM ends, as the returned frame is lazy.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if _scratch:
        _scratch[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    _delete_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    """How many parts a shuffle of this session has; the operators size their ranges by it."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def spread(df: DataFrame) -> DataFrame:
    """df in no fewer parts than the cluster has cores, for costly work on each row.

    A table of fewer parts lies in a few files that Spark can't split; its rows are dealt out. One with more is left as
    it is: nothing large is shuffled for this.
    """
    width = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= width else df.repartition(width)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table of that name under sf_dir."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_broadcast(df: DataFrame, max_rows: int) -> tuple[DataFrame, int]:
    """df with a broadcast hint if it has at most max_rows rows, else df as it is; and its counted rows.

    The count stops at max_rows + 1, so a large df is not read to the end.
    """
    rows = df.limit(max_rows + 1).count()
    return (F.broadcast(df) if rows <= max_rows else df), rows


def col_or_null(df: DataFrame, name: str, kind: str) -> Column:
    """Column name of df cast to kind, or a typed NULL where df has no such column."""
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)
