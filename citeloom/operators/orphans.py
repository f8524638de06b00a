"""References whose parent is missing, gone or not there yet, by probing sorted arrays per key range.

Keys are placed on the line of their 64-bit hashes, which is cut into equal ranges: every range holds about as
many parents, however the keys are spelt. A range's parents become sorted arrays in one task; its references
stream past them in Arrow batches and are found by binary search, a whole batch at a time. The references of
each range are counted first; a range that holds more than its share, because of a hot key, is cut into pieces
by a hash of the row, and only that range's parents are repeated to each piece.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.session import materialize, shuffle_width

#: References of a range over its fair share beyond which the range is cut into pieces.
SHARE = 1.5
#: Parents of a range, about: they are held in one task's memory, so more parents make more ranges.
RANGE_PARENTS = 500_000

_SHAPE = "side int, hash bigint, key string, t1 bigint, t2 bigint, src string, row_no bigint"
_OUT = "src_table string, at bigint, row_no bigint"


class _Parents:
    """Sorted arrays of one range: hash, key, start and end of life."""

    def __init__(self, batches: list[pa.RecordBatch]) -> None:
        table = pa.Table.from_batches(batches) if batches else None
        hashes = table["hash"].to_numpy() if table is not None else np.empty(0, np.int64)
        order = np.argsort(hashes, kind="stable")
        self.hash = hashes[order]
        take = pa.array(order)
        self.key = table["key"].take(take).combine_chunks() if table is not None else pa.array([], pa.string())
        far = np.iinfo(np.int64)
        fill = lambda name, x: pc.fill_null(table[name], x).to_numpy()[order] if table is not None else np.empty(0, np.int64)
        self.start, self.end = fill("t1", far.max), fill("t2", far.max)  # never began: NULL start; never ends: NULL end

    def find(self, batch: pa.RecordBatch) -> np.ndarray:
        """Position of each reference's parent, -1 where there is none. Equal hashes of unlike keys are stepped over."""
        wanted = batch.column("hash").to_numpy()
        found = np.full(len(wanted), -1, np.int64)
        if not len(self.hash):
            return found
        at = np.searchsorted(self.hash, wanted)
        open_ = np.flatnonzero((at < len(self.hash)) & (self.hash[np.minimum(at, len(self.hash) - 1)] == wanted))
        while len(open_):
            same = pc.equal(self.key.take(pa.array(at[open_])), batch.column("key").take(pa.array(open_))).to_numpy(zero_copy_only=False)
            found[open_[same]] = at[open_[same]]
            open_ = open_[~same]
            at[open_] += 1
            open_ = open_[at[open_] < len(self.hash)]
            open_ = open_[self.hash[at[open_]] == wanted[open_]]
        return found


def _probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parents of the range come first, then its references; yields the references without a live parent."""
    held: list[pa.RecordBatch] = []
    parents = None
    for batch in batches:
        side = batch.column("side").to_numpy()
        cut = int(np.searchsorted(side, 1))
        if cut:
            held.append(batch.slice(0, cut))
        refs = batch.slice(cut)
        if not refs.num_rows:
            continue
        if parents is None:
            parents, held = _Parents(held), []
        at = parents.find(refs)
        known = at >= 0
        written = refs.column("t1")
        timed = written.is_valid().to_numpy(zero_copy_only=False)
        when = pc.fill_null(written, 0).to_numpy()
        live = known & ~timed  # without a time, a reference is an orphan only if its parent is unknown
        check = np.flatnonzero(known & timed)
        live[check] = (parents.start[at[check]] <= when[check]) & (parents.end[at[check]] > when[check])
        lost = refs.filter(pa.array(~live))
        yield pa.RecordBatch.from_arrays([lost.column("src"), lost.column("t1"), lost.column("row_no")], ["src_table", "at", "row_no"])


def orphan_references(refs: DataFrame, parents: DataFrame, ranges: int | None = None) -> DataFrame:
    """(src_table, written_at, row_no) of every row of refs whose key has no live parent at written_at.

    refs: (src_table string, key string, written_at timestamp, row_no bigint); rows with a NULL key refer to nothing
    and are left out. parents: (key string, starts_at timestamp, ends_at timestamp), one row per key; NULL keys are
    no parents. A parent is live at t if starts_at <= t and ends_at is NULL or > t; a NULL starts_at is never live.
    A reference without written_at is an orphan only if no parent has its key. Repeated references come out as
    often as they occur. Empty parents make every reference an orphan; empty refs give nothing. Other columns of
    either input are not read.
    """
    spark = refs.sparkSession
    hashed = F.xxhash64("key")
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    near = refs.where("key IS NOT NULL").select(F.lit(1).alias("side"), hashed.alias("hash"), "key", micros("written_at").alias("t1"), F.lit(None).cast("bigint").alias("t2"), F.col("src_table").alias("src"), F.col("row_no").cast("bigint").alias("row_no"))
    far = materialize(parents.where("key IS NOT NULL").select(F.lit(0).alias("side"), hashed.alias("hash"), "key", micros("starts_at").alias("t1"), micros("ends_at").alias("t2"), F.lit(None).cast("string").alias("src"), F.lit(None).cast("bigint").alias("row_no")), "parents")  # counted, then sent to its ranges
    ranges = ranges or max(shuffle_width(spark), -(-far.count() // RANGE_PARENTS))
    # (hash / 2^64 + 1/2) * ranges, in integers: the range's place on the line of hashes
    range_of = F.shiftright(F.expr(f"((hash >> 32) + 2147483648L) * {ranges}L"), 32).cast("int")
    held = dict(near.groupBy(range_of.alias("r")).count().collect())  # one row per range at most
    fair = max(1.0, sum(held.values()) / ranges * SHARE)
    pieces = [max(1, -(-held.get(r, 0) // int(fair))) for r in range(ranges)]
    starts = np.concatenate([[0], np.cumsum(pieces)])
    units = int(starts[-1])
    plan = F.broadcast(spark.createDataFrame([(r, int(starts[r]), pieces[r]) for r in range(ranges)], "r int, start int, pieces int"))
    spread = (F.col("start") + F.pmod(F.xxhash64("row_no", "t1", "src"), F.col("pieces"))).cast("int")
    columns = [f.strip().split()[0] for f in _SHAPE.split(",")]
    placed = near.withColumn("r", range_of).join(plan, "r").select(spread.alias("unit"), *columns)
    repeated = far.withColumn("r", range_of).join(plan, "r").select(F.explode(F.sequence("start", F.col("start") + F.col("pieces") - 1)).alias("unit"), *columns)
    met = repeated.unionByName(placed).repartitionById(units, F.col("unit")).sortWithinPartitions("side").select(*columns)
    return met.mapInArrow(_probe, _OUT).select("src_table", F.timestamp_micros("at").alias("written_at"), "row_no")


def latest_parents(records: DataFrame, key: str, starts: str, ends: str, delivered: str, tie: str) -> DataFrame:
    """(key, starts_at, ends_at) of the record of each key with the latest delivery; ties go to the larger tie column.

    A NULL delivery is earlier than any other. Records with a NULL key are left out.
    """
    picked = F.max(F.struct(F.col(delivered).alias("d"), F.col(tie).alias("i"), F.col(starts).alias("s"), F.col(ends).alias("e")))
    return records.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(picked.alias("p")).select("key", F.col("p.s").alias("starts_at"), F.col("p.e").alias("ends_at"))
