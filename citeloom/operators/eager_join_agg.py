"""Eager aggregation through joins: both inputs shrink to one compact state per key before they meet.

A plain join of two tables with a hot key sends all its rows to one task and multiplies them there. Here
each side is aggregated by (join key, group columns) first, with Spark's map-side partial aggregates, so a
key with a third of all rows reaches the shuffle as one state per map task. The join then sees one row per
key and group, counts are multiplied, sums are scaled by the other side's count, and a last aggregate rolls
up what the group columns leave open.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    """One output of the join's aggregate.

    kind: "pairs" (rows of the join), "left_rows" or "right_rows" (rows of one side, each counted once per
    state met), "sum", "min", "max", "count" (non-NULL values) of column on side "left" or "right".
    """

    kind: str
    alias: str
    side: str = "left"
    column: str = ""


def _state(df: DataFrame, side: str, on: Sequence[str], group: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """One row per (on, group): row count and, for each measured column, what its measures need."""
    keys = [F.col(c).alias(f"__k{i}") for i, c in enumerate(on)] + [F.col(c).alias(f"__{side}g{i}") for i, c in enumerate(group)]
    own = [(i, m) for i, m in enumerate(measures) if m.column and m.side == side]
    narrow = df.select(*keys, *(F.col(m.column).alias(f"__v{i}") for i, m in own))
    make = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}
    aggs = [F.count(F.lit(1)).alias(f"__{side}n")] + [make[m.kind](f"__v{i}").alias(f"__s{i}") for i, m in own]
    return narrow.groupBy(*narrow.columns[: len(keys)]).agg(*aggs)


def eager_join_aggregate(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    measures: Sequence[Measure],
    group_left: Sequence[str] = (),
    group_right: Sequence[str] = (),
    group_on: bool = True,
    how: str = "inner",
) -> DataFrame:
    """Aggregate of left JOIN right USING (on), without forming the join's pairs.

    Result columns: the on columns if group_on, group_left, group_right, then the measures' aliases.
    how: "inner", "left", "right" or "full". group columns must have distinct names on the two sides.

    NULL keys match nothing, as in SQL; outer joins keep them as a group of their own. A side missing in an
    outer join counts as the one NULL-extended row of SQL for "pairs" and for the other side's sums and
    counts, and as 0 for "left_rows" / "right_rows". Repeated rows count as often as they occur. Empty inputs
    give no groups. Only the named columns are read, so other columns may have any name.
    """
    sides = {s: _state(df, s, on, g, measures) for s, df, g in (("left", left, group_left), ("right", right, group_right))}
    keys = [f"__k{i}" for i in range(len(on))]
    joined = sides["left"].join(sides["right"], keys, how)
    n = {s: F.coalesce(F.col(f"__{s}n"), F.lit(1)) for s in sides}

    def rolled(i: int, m: Measure) -> Column:
        other = "right" if m.side == "left" else "left"
        if m.kind == "pairs":
            return F.sum(n["left"] * n["right"])
        if m.kind in ("left_rows", "right_rows"):
            return F.sum(F.coalesce(F.col(f"__{m.kind.split('_')[0]}n"), F.lit(0).cast("bigint")))
        if m.kind in ("sum", "count"):
            total = F.sum(F.col(f"__s{i}") * n[other])
            return F.coalesce(total, F.lit(0).cast("bigint")) if m.kind == "count" else total
        return {"min": F.min, "max": F.max}[m.kind](f"__s{i}")

    out = [F.col(k).alias(c) for k, c in zip(keys, on, strict=True) if group_on]
    out += [F.col(f"__leftg{i}").alias(c) for i, c in enumerate(group_left)]
    out += [F.col(f"__rightg{i}").alias(c) for i, c in enumerate(group_right)]
    return joined.groupBy(*out).agg(*(rolled(i, m).alias(m.alias) for i, m in enumerate(measures)))


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of columns. The shuffle key is all of them, so no single hot key gathers its rows."""
    return df.select(*columns).distinct()
