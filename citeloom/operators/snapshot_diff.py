"""Changes between consecutive full snapshots, by Merkle trees over hash ranges of the keys.

Every row becomes (snapshot, key, 64-bit digest of its content). A leaf of the tree is a range of the keys'
hashes; its digest is the XOR of its rows' hashes with their count, so it needs no order and has a partial
aggregate. An inner node's digest is made of those of the leaves below it in the same way. Consecutive snapshots are
compared from the root's children down: of each level only the children of nodes that differ are read, which are cut
out of the level before its two snapshots meet, and only rows of leaves that differ are compared as rows.
"""

from __future__ import annotations

import math
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.jsonvalue import digest_batches
from citeloom.session import materialize, spread

#: Rows of a leaf to aim at, and the bits by which one level of the tree is finer than the one above.
LEAF_ROWS = 32
FAN_BITS = 5


def content_digests(snapshots: DataFrame, snapshot: str, key: Column, json: str, delivered: str) -> DataFrame:
    """(snapshot, key, digest): the content that holds for each key in each snapshot, that of the latest delivery.

    Ties of delivery go to the larger digest; a NULL delivery is earlier than any other. Rows without snapshot or key
    are left out. The digest is made before the shuffle, so the content itself is never shuffled; copies of a
    key's rows, as many as there may be, shrink in the map-side aggregate.
    """
    rows = snapshots.select(F.col(snapshot).cast("string").alias("snapshot"), key.alias("key"), F.col(json).cast("string").alias("json"), F.col(delivered).cast("timestamp").alias("delivered"))
    rows = spread(rows.where("snapshot IS NOT NULL AND key IS NOT NULL")).mapInArrow(digest_batches, "snapshot string, key string, digest bigint, delivered timestamp")
    return rows.groupBy("snapshot", "key").agg(F.max(F.struct("delivered", "digest")).alias("last")).select("snapshot", "key", F.col("last.digest").alias("digest"))


def _levels(rows: DataFrame, depth: int) -> list[DataFrame]:
    """(snapshot, node, digest) of each level, that of the root's children first: one pass for the leaves, and one over the leaves for all others."""
    leaves = materialize(rows.groupBy("snapshot", "node").agg(F.xxhash64(F.bit_xor(F.xxhash64("key", "digest")), F.count(F.lit(1))).alias("digest")), "merkle-leaves")
    if depth == 1:
        return [leaves]
    each = leaves.select("snapshot", F.xxhash64("node", "digest").alias("h"), F.explode(F.array(*(F.struct(F.lit(i).alias("level"), F.shiftright("node", FAN_BITS * (depth - i)).alias("node")) for i in range(1, depth)))).alias("at"))
    inner = materialize(each.groupBy("snapshot", "at.level", "at.node").agg(F.xxhash64(F.bit_xor("h"), F.count(F.lit(1))).alias("digest")), "merkle-inner-nodes")
    return [*(inner.where(F.col("level") == i).drop("level") for i in range(1, depth)), leaves]


def _side(pairs: DataFrame, level: DataFrame, side: str, within: DataFrame | None) -> DataFrame:
    """(snapshot, before, node, digest) of one side of each pair of snapshots, of all nodes or of the children of the nodes in within."""
    own = level.withColumnRenamed("snapshot", side)
    if within is None:
        return own.join(pairs, side).select("snapshot", "before", "node", "digest")
    up = within.withColumnRenamed("node", "parent")  # a written table: Spark broadcasts it where its size on disk allows, else it shuffles
    return own.withColumn("parent", F.shiftright("node", FAN_BITS)).join(up, [side, "parent"]).select("snapshot", "before", "node", "digest")


def level_pairs(pairs: DataFrame, level: DataFrame, within: DataFrame | None) -> DataFrame:
    """(snapshot, before, node, new, old): the digests of both sides of each node that is looked at."""
    both = _side(pairs, level, "snapshot", within).select("snapshot", "before", "node", F.col("digest").alias("new"), F.lit(None).cast("bigint").alias("old"))
    both = both.unionByName(_side(pairs, level, "before", within).select("snapshot", "before", "node", F.lit(None).cast("bigint").alias("new"), F.col("digest").alias("old")))
    return both.groupBy("snapshot", "before", "node").agg(F.max("new").alias("new"), F.max("old").alias("old"))


def _differing(pairs: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(snapshot, before, node) of the leaves whose digests differ, found from the root down. The nodes of each level that differ are kept."""
    found = None
    for level in levels:
        differ = level_pairs(pairs, level, found).where(~F.col("new").eqNullSafe(F.col("old"))).select("snapshot", "before", "node")
        found = materialize(differ, "merkle-nodes-that-differ")
    return found


def snapshot_changes(snapshots: DataFrame, snapshot: str, key: Column, json: str, delivered: str, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(snapshot, key, change_type) of each key added, removed or altered against the snapshot before among those present.

    Snapshots are ordered as strings; one is present if any row names it, rows without key included. NULL snapshots and
    keys are left out; repeated rows count once (see content_digests). One snapshot, or none, gives no rows.
    Contents are compared as JSON values by value_digest: unequal ones pass for equal with a probability of 2^-64
    per comparison, as keys are compared themselves and only digests of one key meet.
    """
    rows = materialize(content_digests(snapshots, snapshot, key, json, delivered), "snapshot-digests")
    days = sorted(r[0] for r in snapshots.select(F.col(snapshot).cast("string")).distinct().where(F.col(snapshot).isNotNull()).collect())  # one row per snapshot
    if len(days) < 2:
        return rows.limit(0).select("snapshot", "key", F.lit("").alias("change_type"))
    pairs = F.broadcast(snapshots.sparkSession.createDataFrame(list(pairwise(days)), "before string, snapshot string"))
    largest = rows.groupBy("snapshot").count().agg(F.max("count")).first()[0] or 0
    depth = max(1, math.ceil(math.log2(max(2, largest / leaf_rows)) / FAN_BITS))
    rows = rows.withColumn("node", F.shiftrightunsigned(F.xxhash64("key"), 64 - depth * FAN_BITS))
    found = _differing(pairs, _levels(rows, depth))
    # each row of a differing leaf once as the pair's newer and once as its older side
    newer = rows.join(found, ["snapshot", "node"]).select("snapshot", "key", F.col("digest").alias("new"), F.lit(None).cast("bigint").alias("old"))
    older = rows.withColumnRenamed("snapshot", "before").join(found, ["before", "node"]).select("snapshot", "key", F.lit(None).cast("bigint").alias("new"), F.col("digest").alias("old"))
    both = newer.unionByName(older).groupBy("snapshot", "key").agg(F.max("new").alias("new"), F.max("old").alias("old"))
    kind = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old") != F.col("new"), "altered")
    return both.withColumn("change_type", kind).where("change_type IS NOT NULL").select("snapshot", "key", "change_type")
