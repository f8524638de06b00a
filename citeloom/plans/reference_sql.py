"""The SQL of the queries in reference_queries."""

from __future__ import annotations

from citeloom.functions.arxiv import ARXIV_LEAD, ARXIV_PATTERN
from citeloom.functions.references import FIELDS, PROVENANCES
from citeloom.plans.data_queries import sql_canonical, sql_key

_PATHS = {c: f'$."{f}"' for c, f in FIELDS.items()}


def _kind_in(value: str, path: str, kinds: str) -> str:
    return f"coalesce(json_type({value}, '{path}'), 'absent') IN ({kinds})"


_READABLE = " AND ".join(_kind_in("ref", p, "'absent', 'NULL', 'VARCHAR'") for p in _PATHS.values())
_FILES = f"""
WITH f AS (SELECT CAST(record_no AS VARCHAR) AS file_name, CASE WHEN json_valid(raw_json) THEN CAST(raw_json AS JSON) END AS j FROM work_files),
fi AS (SELECT file_name, item_pos, json_extract(j, '$.items[' || item_pos || ']') AS item FROM (
  SELECT file_name, j, CAST(unnest(range(CAST(json_array_length(j, '$.items') AS BIGINT))) AS INTEGER) AS item_pos FROM f WHERE json_type(j, '$.items') = 'ARRAY') x),
bad AS (SELECT DISTINCT file_name FROM fi WHERE json_type(item) <> 'OBJECT' OR NOT {_kind_in("item", "$.DOI", "'absent', 'NULL', 'VARCHAR'")} OR NOT {_kind_in("item", "$.reference", "'absent', 'ARRAY'")}),
status AS (SELECT file_name, j IS NULL OR json_type(j) <> 'OBJECT' OR NOT {_kind_in("j", "$.items", "'absent', 'ARRAY'")} OR file_name IN (SELECT file_name FROM bad) AS parse_failed FROM f),
items AS (SELECT file_name, item_pos, json_extract_string(item, '$.DOI') AS doi, item, CAST(coalesce(json_array_length(item, '$.reference'), 0) AS BIGINT) AS n FROM fi WHERE file_name IN (SELECT file_name FROM status WHERE NOT parse_failed)),
refs AS (SELECT file_name, item_pos, citing_doi, ref_index, json_extract(item, '$.reference[' || ref_index || ']') AS ref FROM (
  SELECT file_name, item_pos, item, lower(doi) AS citing_doi, CAST(unnest(range(n)) AS INTEGER) AS ref_index FROM items WHERE doi IS NOT NULL) x),
r AS (SELECT file_name, item_pos, citing_doi, ref_index, json_extract_string(ref, '$.key') AS ref_key, json_type(ref) = 'OBJECT' AND {_READABLE} AS parseable,
  {", ".join(f"json_extract_string(ref, '{p}') AS {c}" for c, p in _PATHS.items())} FROM refs),
texts AS (SELECT *, coalesce(doi || ' ', '') || coalesce(url || ' ', '') || coalesce(article_title || ' ', '') || coalesce(journal_title || ' ', '') || coalesce(unstructured, '') AS search_text FROM r WHERE parseable),
likely AS (SELECT * FROM texts WHERE contains(lower(search_text), 'arxiv')),
raw AS (SELECT *, unnest(regexp_extract_all(search_text, '(?i){ARXIV_PATTERN}', 0)) AS raw_match FROM likely),
ids AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_replace(raw_match, '(?i){ARXIV_LEAD}', '')), '\\s+', '', 'g'), '^([^v]*)v[0-9]+$', '\\1') AS arxiv_id FROM raw),
cand AS (SELECT DISTINCT file_name, item_pos, citing_doi, ref_index, ref_key, '10.48550/arXiv.' || arxiv_id AS cited_id,
  CASE WHEN lower(doi) = lower('10.48550/arXiv.' || arxiv_id) AND asserted_by IN ('publisher', 'crossref') THEN asserted_by ELSE 'mined' END AS provenance FROM ids)
"""
_RANK = "CASE provenance WHEN 'publisher' THEN 0 WHEN 'crossref' THEN 1 ELSE 2 END"
_STAGED = f"""
WITH s AS (SELECT coalesce(citing_doi, '') AS citing_doi, coalesce(ref_index, 0) AS ref_index, coalesce(cited_id, '') AS cited_id, coalesce(provenance, 'mined') AS provenance, coalesce(ref_json, 'null') AS ref_json FROM merge_rows),
c AS (SELECT * FROM (SELECT *, {_RANK} AS rank, row_number() OVER (PARTITION BY cited_id, citing_doi, ref_index ORDER BY {_RANK}, provenance, ref_json) AS k FROM s WHERE citing_doi <> cited_id) x WHERE k = 1),
idx AS (SELECT DISTINCT lower(id) AS id FROM id_records WHERE id <> ''),
w AS (SELECT cited_id, CAST(count(*) AS BIGINT) AS citation_count, {", ".join(f"CAST(count(*) FILTER (rank = {i}) AS BIGINT) AS {p}_count" for i, p in enumerate(PROVENANCES))}, lower(cited_id) IN (SELECT id FROM idx) AS is_valid FROM c GROUP BY cited_id)
"""
_PART = "CASE WHEN starts_with(e, '10.') AND contains(e, '/') THEN split_part(e, '/', 1) ELSE replace(substr(e, 1, 4), '/', '_') END"
_REST = "regexp_replace(lower({}), '^10\\.48550/arxiv\\.', '')"


def _field(name: str) -> str:
    return f"json_extract_string(j, '$.\"{name}\"')"


_COVERAGE = f"""
WITH e AS (SELECT {sql_key("doi")} AS work, {sql_canonical("doi")} AS arxiv_doi, unnest(cited_by) AS c FROM cited_records),
s AS (SELECT DISTINCT replace(replace(lower(c.doi), 'https://doi.org/', ''), 'http://doi.org/', '') AS citing_doi, substr(work, 16) AS arxiv_id, arxiv_doi,
  CASE WHEN c.provenance IN ('publisher', 'crossref') THEN 'asserted' ELSE 'mined' END AS source, CASE WHEN c.provenance IN ('publisher', 'crossref') THEN c.provenance END AS doi_asserted_by,
  coalesce(CASE WHEN json_valid(c.reference) THEN json_exists(CAST(c.reference AS JSON), '$.DOI') END, false) AS has_structured_doi_in_source
  FROM e WHERE work LIKE '10.48550/arxiv.%' AND lower(c.doi) <> ''),
p AS (SELECT *, lower(citing_doi) AS citing, {sql_key("cited_id")} AS cited, CASE WHEN json_valid(ref_json) THEN CAST(ref_json AS JSON) END AS j FROM partition_rows),
works AS (SELECT citing AS doi, ref_index AS ref_pos, {_field("key")} AS key, lower({_field("DOI")}) AS d, {_field("unstructured")} AS u,
  coalesce({_field("article-title")}, '') AS t1, coalesce({_field("journal-title")}, '') AS t2, coalesce({_field("volume-title")}, '') AS t3 FROM p),
pairs AS (SELECT DISTINCT citing_doi, arxiv_id, arxiv_doi FROM s),
seen AS (SELECT pairs.citing_doi, pairs.arxiv_id, works.doi, ref_pos, key, coalesce(d <> '' AND contains(d, 'arxiv') AND contains(d, arxiv_id), false) AS st,
  coalesce(len(list_filter(regexp_extract_all(u, '(?i)(?:arXiv[:\\s./]*)?(\\d{{4}}\\.\\d{{4,5}}(?:v\\d+)?)', 1), lambda m: split_part(m, 'v', 1) = split_part(arxiv_id, 'v', 1))) > 0, false) AS un,
  contains(t1, arxiv_id) OR contains(t2, arxiv_id) OR contains(t3, arxiv_id) AS ti FROM pairs LEFT JOIN works ON works.doi = pairs.citing_doi),
firsts AS (SELECT * FROM (SELECT citing_doi, arxiv_id, ref_pos, key, st, row_number() OVER (PARTITION BY citing_doi, arxiv_id ORDER BY ref_pos, key NULLS FIRST, st) AS k FROM seen WHERE st OR un) x WHERE k = 1),
titled AS (SELECT * FROM (SELECT seen.citing_doi, seen.arxiv_id, seen.key, row_number() OVER (PARTITION BY seen.citing_doi, seen.arxiv_id ORDER BY seen.ref_pos DESC, seen.key DESC NULLS LAST) AS k FROM seen
  LEFT JOIN firsts ON firsts.citing_doi = seen.citing_doi AND firsts.arxiv_id = seen.arxiv_id WHERE ti AND NOT seen.st AND NOT un AND (firsts.ref_pos IS NULL OR seen.ref_pos < firsts.ref_pos)) x WHERE k = 1),
found AS (SELECT citing_doi, arxiv_id, bool_or(doi IS NOT NULL) AS crossref_found, bool_or(ref_pos IS NOT NULL) AS crossref_has_references FROM seen GROUP BY 1, 2),
v1 AS (SELECT s.*, crossref_found, crossref_has_references, coalesce(firsts.st, false) AS crossref_structured_doi_match, coalesce(NOT firsts.st, false) OR titled.k IS NOT NULL AS crossref_unstructured_match,
  CASE WHEN firsts.k IS NOT NULL THEN firsts.key ELSE titled.key END AS crossref_reference_key
  FROM s JOIN found USING (citing_doi, arxiv_id) LEFT JOIN firsts USING (citing_doi, arxiv_id) LEFT JOIN titled USING (citing_doi, arxiv_id)),
oa AS (SELECT citing, cited FROM p WHERE provenance IN ('publisher', 'crossref') AND cited IS NOT NULL),
v2 AS (SELECT s.*, EXISTS (SELECT 1 FROM oa WHERE citing = citing_doi OR cited = citing_doi) AS openalex_citing_found,
  EXISTS (SELECT 1 FROM oa WHERE citing = citing_doi AND cited = lower(arxiv_doi)) AS openalex_arxiv_in_refs,
  CASE WHEN EXISTS (SELECT 1 FROM oa WHERE citing = lower(arxiv_doi) OR cited = lower(arxiv_doi)) THEN 'W:' || lower(arxiv_doi) END AS openalex_arxiv_work_id FROM s),
ev AS (SELECT cited, lower('https://doi.org/' || citing_doi) AS subj FROM p WHERE provenance = 'crossref' AND cited IS NOT NULL),
n AS (SELECT cited, CAST(count(*) AS BIGINT) AS n FROM ev GROUP BY cited),
v3 AS (SELECT s.*, EXISTS (SELECT 1 FROM ev WHERE ev.cited = lower(arxiv_doi) AND subj = lower('https://doi.org/' || citing_doi)) AS datacite_event_found, n.n AS datacite_total_events FROM s LEFT JOIN n ON n.cited = lower(arxiv_doi)),
oc AS (SELECT citing, ref_index, lower('doi:' || coalesce(cited_id, '')) AS text, CAST(row_no AS VARCHAR) AS oci FROM p WHERE provenance = 'publisher'),
hits AS (SELECT * FROM (SELECT pairs.citing_doi, pairs.arxiv_doi, oci, row_number() OVER (PARTITION BY pairs.citing_doi, pairs.arxiv_doi ORDER BY ref_index, oci) AS k FROM pairs JOIN oc ON oc.citing = pairs.citing_doi AND contains(text, lower(pairs.arxiv_doi))) x WHERE k = 1),
v4 AS (SELECT s.*, EXISTS (SELECT 1 FROM oc WHERE citing = s.citing_doi) AS opencitations_citing_found, hits.k IS NOT NULL AS opencitations_arxiv_in_refs, hits.oci AS opencitations_oci FROM s LEFT JOIN hits ON hits.citing_doi = s.citing_doi AND hits.arxiv_doi = s.arxiv_doi)
"""
_PAIR = "citing_doi, arxiv_id, source, doi_asserted_by, has_structured_doi_in_source"
_FLAGS = {
    "crossref_citing_found": "crossref_found",
    "crossref_has_references": "crossref_has_references",
    "crossref_structured_doi_match": "crossref_structured_doi_match",
    "crossref_unstructured_only": "crossref_unstructured_match AND NOT crossref_structured_doi_match",
    "crossref_no_match": "crossref_has_references AND NOT crossref_structured_doi_match AND NOT crossref_unstructured_match",
    "openalex_citing_found": "openalex_citing_found",
    "openalex_arxiv_in_refs": "openalex_arxiv_in_refs",
    "datacite_event_found": "datacite_event_found",
    "opencitations_citing_found": "opencitations_citing_found",
    "opencitations_arxiv_in_refs": "opencitations_arxiv_in_refs",
}
_RATES = {"crossref_structured_match_rate": "crossref_structured_doi_match", "crossref_unstructured_only_rate": "crossref_unstructured_only", "crossref_no_match_rate": "crossref_no_match", "openalex_match_rate": "openalex_arxiv_in_refs", "datacite_event_match_rate": "datacite_event_found", "opencitations_match_rate": "opencitations_arxiv_in_refs"}
_SUBSETS = {"asserted": "source = 'asserted'", "asserted_publisher": "source = 'asserted' AND doi_asserted_by = 'publisher'", "asserted_crossref": "source = 'asserted' AND doi_asserted_by = 'crossref'", "mined": "source = 'mined'", "total": "true"}


def _subset(name: str, condition: str) -> str:
    counts = [f"CASE WHEN count(*) > 0 THEN CAST(count(*) FILTER ({c}) AS BIGINT) END AS {n}" for n, c in _FLAGS.items()]
    rates = [f"CASE WHEN count(*) > 0 THEN CAST(count(*) FILTER ({_FLAGS[n]}) AS DOUBLE) / count(*) END AS {r}" for r, n in _RATES.items()]
    return f"SELECT '{name}' AS subset, CAST(count(*) AS BIGINT) AS count, {', '.join(counts + rates)} FROM v WHERE {condition}"


_ALL = f"""
v AS (SELECT v1.*, openalex_citing_found, openalex_arxiv_in_refs, datacite_event_found, opencitations_citing_found, opencitations_arxiv_in_refs FROM v1
  {" ".join(f"JOIN v{i} ON v{i}.citing_doi = v1.citing_doi AND v{i}.arxiv_doi = v1.arxiv_doi AND v{i}.source = v1.source AND v{i}.doi_asserted_by IS NOT DISTINCT FROM v1.doi_asserted_by AND v{i}.has_structured_doi_in_source = v1.has_structured_doi_in_source" for i in (2, 3, 4))})
"""
_KEPT = "lower(citing_doi) <> lower(cited_id)"
_KEY = "file_name, item_pos, ref_index"

ORACLE = {
    "parse_file_status": _FILES + "SELECT file_name, parse_failed FROM status",
    "explode_items": _FILES + "SELECT file_name, item_pos, doi, CAST(n AS BIGINT) AS n_references FROM items",
    "explode_references": _FILES + "SELECT file_name, item_pos, citing_doi, ref_index, parseable FROM r",
    "reference_fields": _FILES + f"SELECT {_KEY}, {', '.join(FIELDS)} FROM r WHERE parseable",
    "search_text": _FILES + f"SELECT {_KEY}, search_text FROM texts WHERE search_text <> ''",
    "prefilter_arxiv": _FILES + f"SELECT {_KEY} FROM likely",
    "extract_ids": _FILES + f"SELECT DISTINCT {_KEY}, arxiv_id FROM ids",
    "normalize_ids": _FILES + "SELECT DISTINCT raw_match, arxiv_id FROM ids",
    "arxiv_doi": _FILES + "SELECT DISTINCT arxiv_id, '10.48550/arXiv.' || arxiv_id AS arxiv_doi FROM ids",
    "provenance": _FILES + "SELECT file_name, item_pos, citing_doi, ref_index, cited_id, provenance FROM cand",
    "provenance_filter": _FILES + "SELECT file_name, item_pos, citing_doi, ref_index, cited_id, provenance FROM cand WHERE provenance IN ('publisher', 'crossref')",
    "drop_self_citations": _FILES + f"SELECT {_KEY}, cited_id FROM cand WHERE {_KEPT}",
    "citation_rows": _FILES + f"SELECT citing_doi, ref_index, cited_id, provenance, ref_key FROM cand WHERE {_KEPT}",
    "drop_exact_self": "SELECT row_no FROM merge_rows WHERE citing_doi <> cited_id",
    "partition_key": f"SELECT cited_id, {_PART} AS part FROM (SELECT DISTINCT cited_id, {_REST.format('cited_id')} AS e FROM merge_rows) x",
    "partition_counts": f"SELECT {_PART} AS part, CAST(count(*) AS BIGINT) AS rows_written FROM (SELECT {_REST.format("coalesce(cited_id, '')")} AS e FROM merge_rows) x GROUP BY 1",
    "dedup_citations": _STAGED + "SELECT cited_id, citing_doi, ref_index, provenance, ref_json FROM c",
    "cited_work_counts": _STAGED + "SELECT * FROM w",
    "cited_by_ordered": _STAGED + "SELECT cited_id, 0 AS page_no, CAST(count(*) AS BIGINT) AS citation_count, string_agg(provenance || '|' || citing_doi || '|' || ref_index, ';' ORDER BY rank, citing_doi, ref_index) AS cited_by FROM c GROUP BY cited_id",
    "paged_records": _STAGED + """, o AS (SELECT *, row_number() OVER (PARTITION BY cited_id ORDER BY rank, citing_doi, ref_index) - 1 AS pos FROM c)
      SELECT cited_id, CAST(pos // 50 AS INTEGER) AS page_no, CAST((any_value(citation_count) + 49) // 50 AS INTEGER) AS n_pages, any_value(citation_count) AS citation_count, """
    + ", ".join(f"any_value({p}_count) AS {p}_count" for p in PROVENANCES)
    + """, CAST(count(*) AS BIGINT) AS n_listed,
      first(provenance || '|' || citing_doi || '|' || ref_index ORDER BY pos) AS first_citation, last(provenance || '|' || citing_doi || '|' || ref_index ORDER BY pos) AS last_citation
      FROM o JOIN w USING (cited_id) GROUP BY cited_id, pos // 50""",
    "index_build": "SELECT DISTINCT lower(id) AS id FROM id_records WHERE id <> ''",
    "valid_works": _STAGED + "SELECT cited_id, citation_count FROM w WHERE is_valid",
    "failed_works": _STAGED + "SELECT cited_id, citation_count FROM w WHERE NOT is_valid",
    **{f"{p}_output": _STAGED + f"SELECT cited_id, 0 AS page_no, {p}_count AS citation_count FROM w WHERE is_valid AND {p}_count > 0" for p in PROVENANCES},
    "extraction_stats": _FILES + f"""SELECT (SELECT CAST(count(*) AS BIGINT) FROM status) AS files, (SELECT CAST(count(*) AS BIGINT) FROM status WHERE parse_failed) AS files_failed, (SELECT CAST(count(*) AS BIGINT) FROM items) AS items,
      (SELECT CAST(count(*) AS BIGINT) FROM r WHERE NOT parseable) AS refs_unparseable, (SELECT CAST(count(*) AS BIGINT) FROM likely WHERE len(regexp_extract_all(search_text, '(?i){ARXIV_PATTERN}', 0)) = 0) AS no_match,
      (SELECT CAST(count(*) AS BIGINT) FROM cand WHERE NOT {_KEPT}) AS filtered_self_cite, (SELECT CAST(count(*) AS BIGINT) FROM cand WHERE {_KEPT} AND provenance = 'mined') AS filtered_provenance,
      (SELECT CAST(count(*) AS BIGINT) FROM cand WHERE {_KEPT} AND provenance <> 'mined') AS extracted""",
    "aggregation_stats": _STAGED + "SELECT CAST(count(*) AS BIGINT) AS works, CAST(sum(citation_count) AS BIGINT) AS total_citations, CAST(count(*) FILTER (is_valid) AS BIGINT) AS valid_works, CAST(count(*) FILTER (NOT is_valid) AS BIGINT) AS failed_works, "
    + ", ".join(f"CAST(count(*) FILTER (is_valid AND {p}_count > 0) AS BIGINT) AS {p}_works, CAST(coalesce(sum({p}_count) FILTER (is_valid), 0) AS BIGINT) AS {p}_citations" for p in PROVENANCES) + " FROM w",
    "resume_anti_join": _FILES + "SELECT file_name FROM status WHERE parse_failed",
    "union_segments": "SELECT provenance, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(ref_index) AS BIGINT) AS sum_ref_index FROM (SELECT provenance, ref_index FROM merge_rows UNION ALL SELECT provenance, ref_index FROM partition_rows) x GROUP BY provenance",
    "jsonl_records": _STAGED + "SELECT cited_id AS doi, CAST(count(*) AS BIGINT) AS citation_count, CAST(count(*) AS BIGINT) AS n_listed, first(citing_doi ORDER BY rank, citing_doi, ref_index) AS first_citing, CAST(count(*) FILTER (CASE WHEN json_valid(ref_json) THEN json_type(CAST(ref_json AS JSON)) = 'OBJECT' ELSE false END) AS BIGINT) AS n_objects FROM c GROUP BY cited_id",
    "row_slice": "SELECT row_no, segment, cited_id FROM merge_rows ORDER BY row_no LIMIT 1000 OFFSET 5000",
    "json_events": "SELECT event_type, CAST(count(k) AS BIGINT) AS n_values, CAST(sum(k) AS BIGINT) AS sum_values FROM (SELECT event_type, TRY_CAST(json_extract_string(CASE WHEN json_valid(props) THEN CAST(props AS JSON) END, '$.k') AS BIGINT) AS k FROM events) x GROUP BY event_type",
    "verify_references": _COVERAGE + f"SELECT {_PAIR}, crossref_found, crossref_has_references, crossref_structured_doi_match, crossref_unstructured_match, crossref_reference_key FROM v1",
    "verify_referenced_works": _COVERAGE + f"SELECT {_PAIR}, openalex_citing_found, openalex_arxiv_in_refs, openalex_arxiv_work_id, CASE WHEN NOT openalex_citing_found THEN 'citing_not_found' END AS openalex_error FROM v2",
    "verify_events": _COVERAGE + f"SELECT {_PAIR}, datacite_event_found, datacite_total_events, CASE WHEN datacite_total_events IS NULL THEN 'no_response' END AS datacite_error FROM v3",
    "verify_contained": _COVERAGE + f"SELECT {_PAIR}, opencitations_citing_found, opencitations_arxiv_in_refs, opencitations_oci FROM v4",
    "compare_summary": _COVERAGE.rstrip() + "," + _ALL + " UNION ALL ".join(_subset(*x) for x in _SUBSETS.items()),
    "sample_strata": _COVERAGE + "SELECT source, least(50, CAST(count(*) AS BIGINT)) AS n_pairs FROM s GROUP BY source",
    "staged_roundtrip": f"SELECT {_PART} AS part, CAST(count(*) AS BIGINT) AS rows_read, CAST(count(DISTINCT citing_doi) AS BIGINT) AS citing_works FROM (SELECT {_REST.format("coalesce(cited_id, '')")} AS e, coalesce(citing_doi, '') AS citing_doi FROM merge_rows) x GROUP BY 1",
    "index_roundtrip": "SELECT CAST(count(DISTINCT lower(id)) AS BIGINT) AS n_ids, min(lower(id)) AS first_id, max(lower(id)) AS last_id FROM id_records WHERE id <> ''",
    "output_lines": _STAGED + " UNION ALL ".join(f"SELECT '{o}' AS output, CAST(count(*) AS BIGINT) AS n_lines, CAST(coalesce(sum({n}), 0) AS BIGINT) AS sum_counts, CAST(coalesce(sum({n}), 0) AS BIGINT) AS n_listed FROM w WHERE {c}"
      for o, n, c in [("valid", "citation_count", "is_valid"), ("failed", "citation_count", "NOT is_valid"), *((p, f"{p}_count", f"is_valid AND {p}_count > 0") for p in PROVENANCES)]),
}
