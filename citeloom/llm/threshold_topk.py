"""Exact top-k of a column in three phases with a threshold, over nodes of bounded size.

A node is a run of at most chunk_rows rows of one input partition. Its counts are made in one pass in
Python's Arrow kernels and written to the shared folder: memory is bounded by chunk_rows, whatever the number
of distinct values. Then

1. every node names its k local leaders; the k-th largest sum of leaders is a lower bound L of the k-th count;
2. a value with a count of L or more must have at least L / nodes in some node: only local counts of that
   threshold T or more are fetched. Their sums give a better bound, and a value whose sum plus (T - 1) for each
   silent node stays below it is out;
3. the few values left are counted exactly, from the nodes' counts.

Only leaders, counts above the threshold and counts of candidates are shuffled, never the long tail.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.session import bounded_broadcast, materialize

#: Rows of a node at most; a node's counts have as many entries at most.
CHUNK_ROWS = 1 << 20
#: Candidates that may be broadcast; beyond it the last phase shuffles.
BROADCAST_ITEMS = 100_000


def node_counts(df: DataFrame, item: Column, k: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(node, item, n, lead) of every node: each value's count there, and whether it is among the node's k leaders."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seq = TaskContext.get().partitionId(), 0
        held: list[pa.Array] = []
        rows = 0

        def flush() -> pa.RecordBatch:
            both = pc.value_counts(pa.chunked_array(held))
            n, values = both.field("counts"), both.field("values")
            table = pa.table({"item": values, "n": n, "at": pa.array(range(len(n)), pa.int64())})
            top = table.take(pc.select_k_unstable(table, min(k, len(n)), [("n", "descending"), ("item", "ascending")]))
            lead = pc.is_in(table["at"], value_set=top["at"].combine_chunks())
            node = pa.array([(task << 32) + seq], pa.int64()).take(pa.array([0] * len(n), pa.int32()))
            return pa.table({"node": node, "item": values, "n": n, "lead": lead}).combine_chunks().to_batches()[0]

        for batch in batches:
            for start in range(0, batch.num_rows, chunk_rows):
                part = batch.column(0).slice(start, chunk_rows).drop_null()
                if rows and rows + len(part) > chunk_rows:
                    yield flush()
                    held, rows, seq = [], 0, seq + 1
                held.append(part)
                rows += len(part)
        if rows:
            yield flush()

    values = df.select(item.cast("string").alias("item"))  # NULLs are dropped above: a filter would evaluate item twice
    return values.mapInArrow(count, "node bigint, item string, n bigint, lead boolean")


def threshold_topk(df: DataFrame, item: Column, k: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(item, n): the k most frequent values of item with their exact counts; ties at the border go to the smaller value.

    NULL values are no items; empty strings are. Fewer than k distinct values give as many rows; an empty df
    gives none. Values are compared as strings. Other columns of df are not read.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    nodes = materialize(node_counts(df, item, k, chunk_rows), "node-counts")
    order = (F.desc("n"), F.asc("item"))

    def kth(sums: DataFrame) -> int:
        top = [r.n for r in sums.select("n").orderBy(F.desc("n")).limit(k).collect()]
        return top[-1] if len(top) == k else 0

    leaders = nodes.where("lead")
    bound = kth(leaders.groupBy("item").agg(F.sum("n").alias("n")))
    m = leaders.agg(F.countDistinct("node")).first()[0]
    threshold = max(1, -(-bound // max(1, m)))
    # kept, as its sums are read for the bound, for the candidates and, where all was fetched, for the result
    fetched = materialize(nodes.where(F.col("n") >= threshold).groupBy("item").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("heard")), "fetched-counts")
    if threshold == 1:  # every local count was fetched: the sums are exact
        return fetched.select("item", "n").orderBy(*order).limit(k)
    better = max(bound, kth(fetched))
    left = fetched.where(F.col("n") + (F.lit(m) - F.col("heard")) * (threshold - 1) >= better).select("item")
    candidates, _ = bounded_broadcast(left, BROADCAST_ITEMS)
    return nodes.select("item", "n").join(candidates, "item", "left_semi").groupBy("item").agg(F.sum("n").alias("n")).orderBy(*order).limit(k)
