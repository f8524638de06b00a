"""Queries over the tables for every step of the pipeline and the comparison, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions.arxiv import ARXIV_LEAD, ARXIV_PATTERN, FLAGS, arxiv_doi, arxiv_ids, likely_arxiv, normalize_arxiv_id, partition_key
from citeloom.functions.ids import canonical_work_id, work_key
from citeloom.functions.jsonvalue import with_variant
from citeloom.functions.references import FIELDS, PROVENANCES, provenance_allowed, provenance_rank, search_text
from citeloom.operators import coverage
from citeloom.operators.extraction import candidate_citations, citation_rows, explode_items, explode_references, extraction_stats, match_references, parse_files
from citeloom.operators.grouping import dedup_citations, drop_exact_self, grouped_citations, of_provenance, record_json, staged_defaults, with_work_flags, work_counts
from citeloom.operators.registry import failed_works, index_of, unfinished, valid_works, with_validity
from citeloom.operators.statistics import aggregation_stats, partition_stats
from citeloom.plans.pipeline import compare
from citeloom.session import materialize, scratch_path, table
from citeloom.sinks.selection import output_paths, parse_outputs
from citeloom.sinks.writers import write_index, write_records, write_staged
from citeloom.sources.inputs import read_index, read_staged

Query = Callable[[SparkSession, str], DataFrame]


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "work_files").select(F.col("record_no").cast("string").alias("file_name"), F.col("raw_json").alias("value"))


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_items(parse_files(_files(spark, sf_dir)))


def _references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_references(_items(spark, sf_dir))


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidate_citations(match_references(_references(spark, sf_dir)))


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "merge_rows").select("citing_doi", "ref_index", "cited_id", "provenance", "ref_json")


def _citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_citations(_staged(spark, sf_dir))


def _kept_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, written down as in a run: what groups them reads them several times."""
    return materialize(_citations(spark, sf_dir), "citations")


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_of(table(spark, sf_dir, "id_records"), "id")


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each work's pages of citations, and whether the registry knows it."""
    citations = _kept_citations(spark, sf_dir)
    return with_work_flags(grouped_citations(citations), with_validity(work_counts(citations), _index(spark, sf_dir)))


def parse_file_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents fail as a whole."""
    return parse_files(_files(spark, sf_dir)).select("file_name", "parse_failed")


def exploded_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with their number of references."""
    return _items(spark, sf_dir).select("file_name", "item_pos", "doi", F.greatest(F.coalesce(F.size("references"), F.lit(0)), F.lit(0)).cast("bigint").alias("n_references"))


def exploded_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References of items with a DOI, and whether their declared fields can be read."""
    return _references(spark, sf_dir).select("file_name", "item_pos", "citing_doi", "ref_index", "parseable")


def reference_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six fields of readable references."""
    return _references(spark, sf_dir).where("parseable").select("file_name", "item_pos", "ref_index", *FIELDS)


def search_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of readable references in which identifiers are sought."""
    return _references(spark, sf_dir).where("parseable").select("file_name", "item_pos", "ref_index", search_text().alias("search_text")).where("search_text <> ''")


def prefilter_arxiv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References that pass the cheap test."""
    return search_texts(spark, sf_dir).where(likely_arxiv(F.col("search_text"))).select("file_name", "item_pos", "ref_index")


def extract_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each distinct id of each reference."""
    likely = search_texts(spark, sf_dir).where(likely_arxiv(F.col("search_text")))
    return likely.select("file_name", "item_pos", "ref_index", F.explode(arxiv_ids(F.col("search_text"))).alias("arxiv_id"))


def normalize_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids as found and as normalised."""
    likely = search_texts(spark, sf_dir).where(likely_arxiv(F.col("search_text")))
    raw = likely.select(F.explode(F.regexp_extract_all("search_text", F.lit(FLAGS + ARXIV_PATTERN), F.lit(0))).alias("raw_match")).distinct()
    return raw.select("raw_match", normalize_arxiv_id(F.regexp_replace("raw_match", FLAGS + ARXIV_LEAD, "")).alias("arxiv_id"))


def arxiv_dois(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The DOI of each distinct id."""
    return extract_ids(spark, sf_dir).select("arxiv_id").distinct().select("arxiv_id", arxiv_doi(F.col("arxiv_id")).alias("arxiv_doi"))


def provenances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates with their provenance."""
    return _candidates(spark, sf_dir).select("file_name", "item_pos", "citing_doi", "ref_index", "cited_id", "provenance")


def provenance_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of two provenances, named in other letter case."""
    return provenances(spark, sf_dir).where(provenance_allowed(F.col("provenance"), ["PUBLISHER", "Crossref"]))


def drop_self_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates that are no self-citations."""
    return _candidates(spark, sf_dir).where("other_work").select("file_name", "item_pos", "ref_index", "cited_id")


def extracted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as they are staged, with the key of their payload instead of its text."""
    rows = citation_rows(_candidates(spark, sf_dir))
    return rows.select("citing_doi", "ref_index", "cited_id", "provenance", F.get_json_object("ref_json", "$.key").alias("ref_key"))


def drop_exact_self_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged rows whose cited id is not the citing DOI to the letter."""
    return drop_exact_self(table(spark, sf_dir, "merge_rows")).select("row_no")


def partition_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The directory of each distinct cited id."""
    return table(spark, sf_dir, "merge_rows").select("cited_id").distinct().select("cited_id", partition_key(F.col("cited_id")).alias("part"))


def partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each directory."""
    return partition_stats(staged_defaults(_staged(spark, sf_dir)).withColumn("part", partition_key(F.col("cited_id"))))


def deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged rows without repeated keys."""
    return _citations(spark, sf_dir).select("cited_id", "citing_doi", "ref_index", "provenance", "ref_json")


def cited_work_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations of each work, in all and by provenance, and whether the registry knows it."""
    return with_validity(work_counts(_citations(spark, sf_dir)), _index(spark, sf_dir))


def cited_by_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each work's citations in order, as one text a page."""
    entries = F.transform("cited_by", lambda c: F.concat_ws("|", c["provenance"], c["doi"], c["ref_index"].cast("string")))
    return grouped_citations(_kept_citations(spark, sf_dir)).select("cited_id", "page_no", "citation_count", F.array_join(entries, ";").alias("cited_by"))


#: Citations of a page in paged_records: small, so that many works have several pages.
SMALL_PAGE = 50


def paged_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page of works in pages of 50: the work's totals, and the page's first and last citation and their number."""
    entry = lambda c: F.concat_ws("|", c["provenance"], c["doi"], c["ref_index"].cast("string"))
    grouped = grouped_citations(_kept_citations(spark, sf_dir), SMALL_PAGE)
    first, last = entry(F.element_at("cited_by", 1)).alias("first_citation"), entry(F.element_at("cited_by", -1)).alias("last_citation")
    return grouped.select("cited_id", "page_no", "n_pages", "citation_count", *(f"{p}_count" for p in PROVENANCES), F.size("cited_by").cast("bigint").alias("n_listed"), first, last)


def index_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry index."""
    return _index(spark, sf_dir)


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works that the registry knows."""
    return valid_works(work_counts(_citations(spark, sf_dir)), _index(spark, sf_dir)).select("cited_id", "citation_count")


def failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works that it doesn't."""
    return failed_works(work_counts(_citations(spark, sf_dir)), _index(spark, sf_dir)).select("cited_id", "citation_count")


def _output(provenance: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return of_provenance(_flagged(spark, sf_dir).where("is_valid"), provenance).select("cited_id", "page_no", "citation_count")

    query.__doc__ = f"Valid works with their {provenance} citations."
    return query


def extraction_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of the extraction of publisher and crossref citations."""
    return extraction_stats(_files(spark, sf_dir), ["publisher", "crossref"])


def aggregation_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of the aggregation."""
    return aggregation_stats(cited_work_counts(spark, sf_dir))


def resume_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that a manifest of those that did not fail leaves to be read."""
    status = parse_file_status(spark, sf_dir)
    manifest = status.select("file_name", F.when(F.col("parse_failed"), "failed").otherwise("done").alias("status"))
    return unfinished(_files(spark, sf_dir).select("file_name"), manifest)


def union_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both staged tables as one bag, counted by provenance."""
    columns = ["citing_doi", "ref_index", "cited_id", "provenance", "ref_json"]
    both = table(spark, sf_dir, "merge_rows").select(columns).unionByName(table(spark, sf_dir, "partition_rows").select(columns))
    return both.groupBy("provenance").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("ref_index").alias("sum_ref_index"))


def jsonl_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Output lines, read back: DOI, count, listed citations, first citing DOI, and listed payloads that are objects."""
    lines = grouped_citations(_kept_citations(spark, sf_dir)).select(record_json(F.col("cited_id"), F.col("citation_count"), F.col("cited_by")).alias("line"))
    v = lines.select(F.parse_json("line").alias("v"))
    entries = F.try_variant_get("v", "$.cited_by", "array<variant>")
    objects = F.size(F.filter(entries, lambda e: F.try_variant_get(e, "$.reference", "map<string,variant>").isNotNull())).cast("bigint")
    return v.select(F.variant_get("v", "$.doi", "string").alias("doi"), F.variant_get("v", "$.citation_count", "bigint").alias("citation_count"), F.size(entries).cast("bigint").alias("n_listed"), F.variant_get("v", "$.cited_by[0].doi", "string").alias("first_citing"), objects.alias("n_objects"))


def row_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows 5,000 to 5,999 of the staged rows in the order of their numbers: a slice, as chunked readers take it."""
    return table(spark, sf_dir, "merge_rows").orderBy("row_no").offset(5000).limit(1000).select("row_no", "segment", "cited_id")


def json_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value out of a JSON column, by type of event."""
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(k).alias("n_values"), F.sum(k).alias("sum_values"))


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citation pairs of the published records, in the shape of sampled pairs."""
    each = table(spark, sf_dir, "cited_records").select(work_key(F.col("doi")).alias("work"), canonical_work_id(F.col("doi")).alias("arxiv_doi"), F.explode("cited_by").alias("c")).where("work LIKE '10.48550/arxiv.%'")
    ref = F.col("ref")
    return with_variant(each, F.col("c.reference"), "ref").select(
        coverage.bare_doi(F.col("c.doi")).alias("citing_doi"), F.expr("substring(work, 16)").alias("arxiv_id"), "arxiv_doi",
        F.when(F.col("c.provenance").isin("publisher", "crossref"), "asserted").otherwise("mined").alias("source"), F.lit("").alias("raw_match"),
        F.try_variant_get(ref, "$.DOI", "variant").isNotNull().alias("has_structured_doi_in_source"),
        F.when(F.col("c.provenance").isin("publisher", "crossref"), F.col("c.provenance")).alias("doi_asserted_by"),
    ).where("citing_doi <> ''").distinct()


def _works(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_variant(table(spark, sf_dir, "partition_rows").select(F.lower("citing_doi").alias("doi"), F.col("ref_index").alias("ref_pos"), "ref_json"), F.col("ref_json"), "r")
    field = lambda f: F.try_variant_get("r", f"$['{f}']", "string")
    return rows.select("doi", "ref_pos", field("key").alias("key"), field("DOI").alias("ref_doi"), field("unstructured").alias("unstructured"), field("article-title").alias("article_title"), field("journal-title").alias("journal_title"), field("volume-title").alias("volume_title"))


def _openalex(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "partition_rows").where("provenance IN ('publisher', 'crossref')")
    cited = rows.select(F.lower("citing_doi").alias("citing"), work_key(F.col("cited_id")).alias("cited")).where("cited IS NOT NULL")
    works = cited.select(F.col("citing").alias("doi")).union(cited.select("cited")).distinct()
    return works.select("doi", F.concat(F.lit("W:"), "doi").alias("id")), cited.select(F.col("citing").alias("doi"), F.concat(F.lit("W:"), "cited").alias("referenced_work"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "partition_rows").where("provenance = 'crossref'")
    return rows.select(work_key(F.col("cited_id")).alias("doi"), F.concat(F.lit("https://doi.org/"), "citing_doi").alias("subj_id")).where("doi IS NOT NULL")


def _oc_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "partition_rows").where("provenance = 'publisher'")
    return rows.select("citing_doi", F.col("ref_index").alias("ref_pos"), F.concat(F.lit("doi:"), F.coalesce("cited_id", F.lit(""))).alias("cited"), F.col("row_no").cast("string").alias("oci"))


_PAIR = ["citing_doi", "arxiv_id", "source", "doi_asserted_by", "has_structured_doi_in_source"]


def verify_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled pairs against the references of works."""
    return coverage.verify_references(_samples(spark, sf_dir), _works(spark, sf_dir)).select(*_PAIR, "crossref_found", "crossref_has_references", "crossref_structured_doi_match", "crossref_unstructured_match", "crossref_reference_key")


def verify_referenced_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled pairs against lists of referenced works."""
    return coverage.verify_referenced_works(_samples(spark, sf_dir), *_openalex(spark, sf_dir)).select(*_PAIR, "openalex_citing_found", "openalex_arxiv_in_refs", "openalex_arxiv_work_id", "openalex_error")


def verify_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled pairs against events."""
    return coverage.verify_events(_samples(spark, sf_dir), _events(spark, sf_dir)).select(*_PAIR, "datacite_event_found", "datacite_total_events", "datacite_error")


def verify_contained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled pairs against references that hold the DOI in their text."""
    return coverage.verify_contained(_samples(spark, sf_dir), _oc_refs(spark, sf_dir)).select(*_PAIR, "opencitations_citing_found", "opencitations_arxiv_in_refs", "opencitations_oci")


def compare_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary over all subsets."""
    return compare(_samples(spark, sf_dir), _works(spark, sf_dir), *_openalex(spark, sf_dir), _events(spark, sf_dir), _oc_refs(spark, sf_dir))[1]


def sample_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many pairs of each kind a sample of 100, half of them asserted, has."""
    return stratified_sample(spark, sf_dir).groupBy("source").agg(F.count(F.lit(1)).alias("n_pairs"))


def staged_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged rows written to directories and read back: rows and citing works of each."""
    path = scratch_path(spark, "staged-roundtrip")
    write_staged(staged_defaults(_staged(spark, sf_dir)), path)
    return read_staged(spark, path).groupBy("part").agg(F.count(F.lit(1)).alias("rows_read"), F.countDistinct("citing_doi").alias("citing_works"))


def index_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index written and read back: works in it, and the least and greatest id."""
    path = scratch_path(spark, "index-roundtrip")
    write_index(_index(spark, sf_dir), path)
    return read_index(spark, path).agg(F.count(F.lit(1)).alias("n_ids"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


def output_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five outputs written as JSON lines and read back: lines of each, sum of their counts, and listed citations."""
    works = materialize(_flagged(spark, sf_dir), "output-works")
    paths = output_paths(parse_outputs([]), scratch_path(spark, "outputs"), "works")
    write_records(works, paths)
    each = [spark.read.schema("doi string, citation_count bigint, cited_by array<struct<doi:string>>").json(p).select(F.lit(o.value).alias("output"), "citation_count", F.size("cited_by").alias("listed")) for o, p in paths.items()]
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return reduce(DataFrame.unionByName, each).groupBy("output").agg(F.count(F.lit(1)).alias("n_lines"), total("citation_count").alias("sum_counts"), total("listed").alias("n_listed"))


def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of 100 pairs, half of them asserted."""
    pairs = _samples(spark, sf_dir)
    return coverage.stratified_sample(pairs.where("source = 'asserted'"), pairs.where("source = 'mined'"), 100, (50, 50))


QUERIES: dict[str, Query] = {
    "parse_file_status": parse_file_status,
    "explode_items": exploded_items,
    "explode_references": exploded_references,
    "reference_fields": reference_fields,
    "search_text": search_texts,
    "prefilter_arxiv": prefilter_arxiv,
    "extract_ids": extract_ids,
    "normalize_ids": normalize_ids,
    "arxiv_doi": arxiv_dois,
    "provenance": provenances,
    "provenance_filter": provenance_filter,
    "drop_self_citations": drop_self_citations,
    "citation_rows": extracted_rows,
    "drop_exact_self": drop_exact_self_rows,
    "partition_key": partition_keys,
    "partition_counts": partition_counts,
    "dedup_citations": deduplicated,
    "cited_work_counts": cited_work_counts,
    "cited_by_ordered": cited_by_ordered,
    "paged_records": paged_records,
    "index_build": index_build,
    "valid_works": valid,
    "failed_works": failed,
    **{f"{p}_output": _output(p) for p in PROVENANCES},
    "extraction_stats": extraction_counters,
    "aggregation_stats": aggregation_counters,
    "resume_anti_join": resume_files,
    "union_segments": union_segments,
    "jsonl_records": jsonl_records,
    "row_slice": row_slice,
    "json_events": json_events,
    "verify_references": verify_references,
    "verify_referenced_works": verify_referenced_works,
    "verify_events": verify_events,
    "verify_contained": verify_contained,
    "compare_summary": compare_summary,
    "stratified_sample": stratified_sample,
    "sample_strata": sample_strata,
    "staged_roundtrip": staged_roundtrip,
    "index_roundtrip": index_roundtrip,
    "output_lines": output_lines,
}
