"""Queries p1 and p3 to p5: the operators over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions.ids import canonical_from_key, doi_key, keyed
from citeloom.operators.eager_join_agg import Measure, distinct_rows, eager_join_aggregate
from citeloom.operators.nested_tables import KNOWN, REFERENCE_VARIANTS, is_typed, nested_rows, nested_table, typed_columns, variants_with
from citeloom.operators.orphans import latest_parents, orphan_references
from citeloom.operators.snapshot_diff import snapshot_changes
from citeloom.session import table


def _reported(records: DataFrame) -> DataFrame:
    """(run_id, cited_id, citation_count): of a work delivered more than once by a run, the latest record holds."""
    last = F.max(F.struct("produced_at", "record_no", "citation_count")).alias("p")
    known = keyed(records.where("run_id IS NOT NULL").select("run_id", "doi", "produced_at", "record_no", "citation_count"), "doi", "__work")
    return known.groupBy("run_id", canonical_from_key(F.col("__work")).alias("cited_id")).agg(last).select("run_id", "cited_id", F.col("p.citation_count").alias("citation_count"))


def _pairs(rows: DataFrame) -> DataFrame:
    """Distinct (run_id, cited_id, citing, ref_index); a NULL citing DOI or index is a value of its own."""
    known = keyed(rows.where("run_id IS NOT NULL").select("run_id", "cited_id", "citing_doi", "ref_index"), "cited_id", "__work")
    return distinct_rows(known.select("run_id", canonical_from_key(F.col("__work")).alias("cited_id"), F.lower("citing_doi").alias("citing"), "ref_index"), ["run_id", "cited_id", "citing", "ref_index"])


def p1_citation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True and reported count of every work of every run that either side knows."""
    measures = [Measure("left_rows", "true_count"), Measure("max", "reported_count", "right", "citation_count")]
    return eager_join_aggregate(_pairs(table(spark, sf_dir, "partition_rows")), _reported(table(spark, sf_dir, "cited_records")), ["run_id", "cited_id"], measures, how="full")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works of runs whose reported count is not the true one."""
    counts = p1_citation_counts(spark, sf_dir)
    return counts.where(F.col("reported_count").isNull() | (F.col("reported_count") != F.col("true_count"))).select("run_id", "cited_id")


def p1_join_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per run and provenance: rows of partition_rows JOIN cited_records on run and work, and the sum of reported counts over them."""
    left = keyed(table(spark, sf_dir, "partition_rows").select("run_id", "cited_id", "provenance"), "cited_id", "work")
    right = keyed(table(spark, sf_dir, "cited_records").select("run_id", "doi", "citation_count"), "doi", "work")
    measures = [Measure("pairs", "n_pairs"), Measure("sum", "sum_reported", "right", "citation_count")]
    states = eager_join_aggregate(left, right, ["run_id", "work"], measures, group_left=["provenance"])
    return states.groupBy("run_id", "provenance").agg(F.sum("n_pairs").alias("n_pairs"), F.sum("sum_reported").alias("sum_reported"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """String fields doi-asserted-by and unstructured of every reference, from the typed tables of the variants that can have them."""
    fields = ("doi-asserted-by", "unstructured")
    rows = nested_rows(table(spark, sf_dir, "work_files"), "record_no", "file_name", "raw_json", variants_with(*fields), ["typed"])
    names = F.array_compact(F.array(*(F.when(is_typed(f), F.lit(f)) for f in fields)))
    return rows.select("record_no", "item_pos", "ref_pos", F.explode(names).alias("field_name"))


def _p3_table(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return nested_table(nested_rows(table(spark, sf_dir, "work_files"), "record_no", "file_name", "raw_json", [name]), name)

    query.__doc__ = f"The flat table {name} of all work files."
    return query


def _without_shape(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _p3_table(name)(spark, sf_dir).drop("shape", "typed")

    query.__doc__ = f"The flat table {name} without the numbers of its shapes, which SQL can't make."
    return query


def p3_leaf_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields of references that are no lists or objects."""
    return _p3_table("fields")(spark, sf_dir).where("kind NOT IN ('list', 'object')")


def p3_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many references each variant has, and in how many shapes."""
    return _p3_table("references")(spark, sf_dir).groupBy("variant").agg(F.count(F.lit(1)).alias("n_references"), F.countDistinct("shape").alias("n_shapes"))


def _p4_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    one = lambda name: keyed(table(spark, sf_dir, name).select("cited_id", "written_at", "row_no"), "cited_id", "key").select(F.lit(name).alias("src_table"), "key", "written_at", "row_no")
    records = keyed(table(spark, sf_dir, "id_records").select("id", "registered_at", "removed_at", "delivered_at", "record_no"), "id", "key")
    return one("merge_rows").unionByName(one("partition_rows")), latest_parents(records, "key", "registered_at", "removed_at", "delivered_at", "record_no")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of merge_rows and partition_rows that cite a work which is not live at written_at."""
    lost = orphan_references(*_p4_inputs(spark, sf_dir))
    return lost.select("src_table", F.date_format("written_at", "yyyy-MM").alias("period_ym"), "row_no")


def p4_orphan_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan rows per table and month."""
    return p4_found(spark, sf_dir).groupBy("src_table", "period_ym").agg(F.count(F.lit(1)).alias("n_orphans"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works added, removed or altered between consecutive snapshots."""
    changes = snapshot_changes(table(spark, sf_dir, "item_snapshots"), "snapshot_day", doi_key(F.col("doi")), "reference", "delivered_at")
    return changes.select(F.col("snapshot").alias("snapshot_day"), F.col("key").alias("doi"), "change_type")


def p5_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The added and removed works of p5_found, which SQL can state."""
    return p5_found(spark, sf_dir).where("change_type <> 'altered'")


QUERIES = {
    "p1_found": p1_found,
    "p1_citation_counts": p1_citation_counts,
    "p1_join_totals": p1_join_totals,
    "p3_found": p3_found,
    "p3_files": _p3_table("files"),
    "p3_items": _without_shape("items"),
    "p3_references": _without_shape("references"),
    "p3_fields": _p3_table("fields"),
    "p3_leaf_fields": p3_leaf_fields,
    "p3_shapes": p3_shapes,
    **{f"p3_{n}": _without_shape(n) for n, _ in REFERENCE_VARIANTS},
    "p4_found": p4_found,
    "p4_orphan_report": p4_orphan_report,
    "p5_found": p5_found,
    "p5_membership": p5_membership,
}


def sql_key(c: str) -> str:
    """SQL of work_key."""
    blank = "chr(9) || chr(10) || chr(13) || ' '"
    return rf"nullif(trim(regexp_replace(lower(trim({c}, {blank})), '^((info:|urn:)?doi[\s:/]+)+', ''), {blank}), '')"


def sql_canonical(c: str) -> str:
    k = sql_key(c)
    return f"CASE WHEN starts_with({k}, '10.48550/arxiv.') THEN '10.48550/arXiv.' || substr({k}, 16) ELSE {k} END"


_COUNTS = f"""
WITH t AS (SELECT run_id, cited_id, CAST(count(*) AS BIGINT) AS true_count FROM (
    SELECT DISTINCT run_id, {sql_canonical("cited_id")} AS cited_id, lower(citing_doi) AS c, ref_index FROM partition_rows) x
  WHERE cited_id IS NOT NULL GROUP BY run_id, cited_id),
r AS (SELECT run_id, cited_id, citation_count AS reported_count FROM (
    SELECT run_id, cited_id, citation_count, row_number() OVER (PARTITION BY run_id, cited_id ORDER BY produced_at DESC, record_no DESC) AS k
    FROM (SELECT run_id, citation_count, produced_at, record_no, {sql_canonical("doi")} AS cited_id FROM cited_records) y WHERE cited_id IS NOT NULL) z WHERE k = 1),
counts AS (SELECT run_id, cited_id, coalesce(true_count, 0) AS true_count, reported_count FROM t FULL JOIN r USING (run_id, cited_id))
"""
_ORPHANS = f"""
WITH p AS (SELECT key, registered_at, removed_at FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY delivered_at DESC, record_no DESC) AS k
    FROM (SELECT record_no, registered_at, removed_at, delivered_at, {sql_key("id")} AS key FROM id_records) x WHERE key IS NOT NULL) y WHERE k = 1),
c AS (SELECT 'merge_rows' AS src_table, {sql_key("cited_id")} AS key, written_at, row_no FROM merge_rows
  UNION ALL SELECT 'partition_rows', {sql_key("cited_id")}, written_at, row_no FROM partition_rows),
lost AS (SELECT src_table, strftime(written_at, '%Y-%m') AS period_ym, row_no FROM c WHERE key IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM p WHERE p.key = c.key AND p.registered_at <= c.written_at AND (p.removed_at IS NULL OR p.removed_at > c.written_at)))
"""
_DAYS = f"""
WITH d AS (SELECT snapshot_day, lag(snapshot_day) OVER (ORDER BY snapshot_day) AS before FROM (SELECT DISTINCT snapshot_day FROM item_snapshots) x),
w AS (SELECT DISTINCT snapshot_day, regexp_replace({sql_key("doi")}, '\\s+', '', 'g') AS doi FROM item_snapshots WHERE {sql_key("doi")} IS NOT NULL)
SELECT d.snapshot_day, w.doi, 'added' AS change_type FROM d JOIN w ON w.snapshot_day = d.snapshot_day WHERE before IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM w v WHERE v.snapshot_day = d.before AND v.doi = w.doi)
UNION ALL SELECT d.snapshot_day, w.doi, 'removed' FROM d JOIN w ON w.snapshot_day = d.before
  WHERE NOT EXISTS (SELECT 1 FROM w v WHERE v.snapshot_day = d.snapshot_day AND v.doi = w.doi)
"""
_JOINED = f"""
SELECT l.run_id, l.provenance, CAST(count(*) AS BIGINT) AS n_pairs, CAST(sum(citation_count) AS BIGINT) AS sum_reported
FROM (SELECT run_id, provenance, {sql_canonical("cited_id")} AS work FROM partition_rows) l
JOIN (SELECT run_id, citation_count, {sql_canonical("doi")} AS work FROM cited_records) r ON l.run_id = r.run_id AND l.work = r.work
GROUP BY l.run_id, l.provenance
"""

_NESTED = """
WITH f AS (SELECT record_no, file_name, CASE WHEN json_valid(raw_json) THEN CAST(raw_json AS JSON) END AS j FROM work_files),
i AS (SELECT record_no, item_pos, json_extract(j, '$.items[' || item_pos || ']') AS item FROM (
  SELECT record_no, j, CAST(unnest(range(CAST(json_array_length(j, '$.items') AS BIGINT))) AS INTEGER) AS item_pos FROM f WHERE json_type(j, '$.items') = 'ARRAY') x),
r AS (SELECT record_no, item_pos, ref_pos, json_extract(item, '$.reference[' || ref_pos || ']') AS ref FROM (
  SELECT record_no, item_pos, item, CAST(unnest(range(CAST(json_array_length(item, '$.reference') AS BIGINT))) AS INTEGER) AS ref_pos FROM i WHERE json_type(item, '$.reference') = 'ARRAY') y),
n AS (SELECT unnest(['doi-asserted-by', 'unstructured']) AS field_name)
"""


def _kind(kind: str) -> str:
    """SQL of kind_of, for a type as json_type names it."""
    return f"CASE {kind} WHEN 'NULL' THEN 'null' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'VARCHAR' THEN 'string' WHEN 'ARRAY' THEN 'list' WHEN 'OBJECT' THEN 'object' ELSE 'number' END"


def _string(field: str) -> str:
    """SQL of a field of ref if it is a string, else NULL."""
    return f"""CASE WHEN json_type(ref, '$."{field}"') = 'VARCHAR' THEN json_extract_string(ref, '$."{field}"') END"""


_ITS = {f: f.lower().replace("-", "_") for f in KNOWN}
_VARIANT = "CASE " + " ".join(f"WHEN {' AND '.join(f'{_ITS[f]} IS NOT NULL' for f in fields)} THEN '{name}'" for name, fields in REFERENCE_VARIANTS if fields) + " ELSE 'other' END"
_REFS = (
    _NESTED.rstrip()
    + f""",
s AS (SELECT *, {", ".join(f"{_string(f)} AS {c}" for f, c in _ITS.items())} FROM r),
t AS (SELECT *, CASE WHEN json_type(ref) = 'OBJECT' THEN {_VARIANT} ELSE {_kind("json_type(ref)")} END AS variant FROM s)
"""
)
_P3 = {
    "p3_found": _NESTED + """SELECT record_no, item_pos, ref_pos, field_name FROM r, n WHERE json_type(ref) = 'OBJECT' AND json_type(ref, '$."' || field_name || '"') = 'VARCHAR'""",
    "p3_files": _NESTED + f"""SELECT record_no, file_name, CASE WHEN j IS NULL THEN 'broken' WHEN json_type(j) <> 'OBJECT' THEN {_kind("json_type(j)")} WHEN json_type(j, '$.items') IS NULL THEN 'items_absent'
      ELSE 'items_' || {_kind("json_type(j, '$.items')")} END AS variant, CAST(CASE WHEN json_type(j, '$.items') = 'ARRAY' THEN json_array_length(j, '$.items') ELSE 0 END AS INTEGER) AS n_items FROM f""",
    "p3_items": _NESTED + f"""SELECT record_no, item_pos, CASE WHEN json_type(item, '$.DOI') = 'VARCHAR' THEN json_extract_string(item, '$.DOI') END AS doi,
      CASE WHEN json_type(item) <> 'OBJECT' THEN {_kind("json_type(item)")} WHEN json_type(item, '$.reference') IS NULL THEN 'references_absent' ELSE 'references_' || {_kind("json_type(item, '$.reference')")} END AS variant,
      CAST(CASE WHEN json_type(item, '$.reference') = 'ARRAY' THEN json_array_length(item, '$.reference') ELSE 0 END AS INTEGER) AS n_references FROM i""",
    "p3_references": _REFS + f"SELECT record_no, item_pos, ref_pos, variant, {', '.join(_ITS.values())} FROM t",
    "p3_leaf_fields": _REFS + f""", k AS (SELECT record_no, item_pos, ref_pos, variant, ref, unnest(json_keys(ref)) AS field_name FROM t WHERE json_type(ref) = 'OBJECT'),
      v AS (SELECT *, json_extract(ref, '$."' || field_name || '"') AS x FROM k)
      SELECT record_no, item_pos, ref_pos, variant, field_name, {_kind("json_type(x)")} AS kind, json_extract_string(x, '$') AS value FROM v WHERE json_type(x) NOT IN ('ARRAY', 'OBJECT')""",
    **{f"p3_{n}": _REFS + f"SELECT record_no, item_pos, ref_pos, {', '.join(_ITS[f] for f in typed_columns(n))} FROM t WHERE variant = '{n}' AND json_type(ref) = 'OBJECT'" for n, _ in REFERENCE_VARIANTS},
}

#: p3_fields, p3_shapes and p5_found have none, as SQL can't compare JSON values, spell nested ones or number shapes. They are tested against brute force.
ORACLE = {
    **_P3,
    "p1_citation_counts": _COUNTS + "SELECT * FROM counts",
    "p1_found": _COUNTS + "SELECT run_id, cited_id FROM counts WHERE reported_count IS NULL OR reported_count <> true_count",
    "p1_join_totals": _JOINED,
    "p4_found": _ORPHANS + "SELECT * FROM lost",
    "p4_orphan_report": _ORPHANS + "SELECT src_table, period_ym, CAST(count(*) AS BIGINT) AS n_orphans FROM lost GROUP BY 1, 2",
    "p5_membership": _DAYS,
}
