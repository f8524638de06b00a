"""Writers: staged rows, JSON lines, the registry index, and the comparison's report."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.functions.arxiv import partition_key
from citeloom.operators.grouping import of_provenance, record_json
from citeloom.schema import VERIFICATION
from citeloom.session import col_or_null
from citeloom.sinks.selection import Output

#: Rows of one staged file: a hundredth of the batch size, but no fewer than this.
LEAST_ROWS_PER_FILE = 10_000


def rows_per_file(batch_size: int) -> int:
    """Rows after which a staged file is closed."""
    return max(batch_size // 100, LEAST_ROWS_PER_FILE)


def write_staged(rows: DataFrame, path: str, batch_size: int = 5_000_000) -> None:
    """Write citation rows to one directory per partition key, compressed, replacing what was there.

    Rows are first gathered by key, else every task would open a file in every directory; a rebalance splits the keys
    that are larger than the advisory size of a partition, however large they are.
    """
    keyed = rows.withColumn("part", partition_key(F.col("cited_id")))
    gathered = keyed.hint("rebalance", F.col("part"))
    gathered.write.mode("overwrite").partitionBy("part").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file(batch_size)).parquet(path)


def write_index(ids: DataFrame, path: str) -> None:
    """Write the registry index, sorted within its files, so that readers can skip row groups."""
    ids.repartitionByRange("id").sortWithinPartitions("id").write.mode("overwrite").parquet(path)


def write_records(works: DataFrame, paths: dict[Output, str]) -> None:
    """Write the selected outputs of works (grouped_citations with is_valid), a directory of JSON lines each.

    works is read once per output: materialise it before. Provenance outputs have valid works only, with their own counts.
    """
    valid = works.where("is_valid")
    views = {Output.VALID: valid, Output.FAILED: works.where("NOT is_valid")}
    for output, path in paths.items():
        view = views[output] if output in views else of_provenance(valid, output.value)
        line = record_json(F.col("cited_id"), F.col("citation_count"), F.col("cited_by"), F.col("page_no"), F.col("n_pages")).alias("value")
        view.select(line).write.mode("overwrite").text(path)


def write_csv(results: DataFrame, path: str) -> None:
    """Verified pairs as CSV with a header: the columns of VERIFICATION in their order, those that results lacks (notes) empty."""
    columns = [c.split() for c in VERIFICATION.split(",")]
    results.select(*(col_or_null(results, c, t).alias(c) for c, t in columns)).write.mode("overwrite").option("header", True).csv(path)


def summary_document(summary: DataFrame) -> dict:
    """The summary (one row per subset) as one document; an empty subset has its count only."""
    rows = {r.subset: {k: v for k, v in r.asDict().items() if k != "subset" and v is not None} for r in summary.collect()}  # four rows and the total
    sizes = {name: row.get("count", 0) for name, row in rows.items()}
    return {"sample_size": sizes} | {f"{name}_results": row for name, row in rows.items() if name != "total"}


def write_summary(summary: DataFrame, path: str) -> None:
    """The summary as a JSON file."""
    with open(path, "w", encoding="utf-8") as out:
        json.dump(summary_document(summary), out, indent=2)


def summary_text(summary: DataFrame) -> str:
    """The summary as a report."""
    document = summary_document(summary)
    lines = ["Citation comparison", ""]
    for name, row in document.items():
        lines.append(name.replace("_", " "))
        lines += [f"  {k.replace('_', ' ')}: {v:.1%}" if isinstance(v, float) else f"  {k.replace('_', ' ')}: {v:,}" for k, v in row.items()]
    return "\n".join(lines)
