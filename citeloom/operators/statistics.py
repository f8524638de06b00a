"""Counters of a run, as one row each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.functions.references import PROVENANCES


def aggregation_stats(works: DataFrame, provenance_outputs: bool = True) -> DataFrame:
    """Counters over works (citation_count, <provenance>_count, is_valid): totals count failed works too, provenances valid ones only.

    Without any provenance output the provenances' counters stay 0.
    """
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    out = [F.count(F.lit(1)).alias("works"), total(F.col("citation_count")).alias("total_citations"), F.count_if("is_valid").alias("valid_works"), F.count_if(~F.col("is_valid")).alias("failed_works")]
    for p in PROVENANCES:
        n = F.when(F.col("is_valid"), F.col(f"{p}_count")) if provenance_outputs else F.lit(0)
        out += [F.count_if(n > 0).alias(f"{p}_works"), total(n).alias(f"{p}_citations")]
    return works.agg(*out)


def partition_stats(rows: DataFrame, part: str = "part") -> DataFrame:
    """Rows per directory."""
    return rows.groupBy(F.col(part).alias("part")).agg(F.count(F.lit(1)).alias("rows_written"))
