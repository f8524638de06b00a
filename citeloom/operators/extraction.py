"""From raw documents to citation rows: strict parse, unnest, search, classify, filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.arxiv import arxiv_dois, likely_arxiv
from citeloom.functions.jsonvalue import with_variant
from citeloom.functions.references import FIELDS, has_searchable_content, is_other_work, provenance, provenance_allowed, search_text


def _at(v: Column, field: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, f"$['{field}']", kind)


def _is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def _absent_or_list(v: Column, field: str) -> Column:
    return _at(v, field).isNull() | _at(v, field, "array<variant>").isNotNull()


def _absent_or_text(v: Column, field: str) -> Column:
    """Absent, null or a string; a number is no string here, although a cast would make it one."""
    own = _at(v, field)
    return own.isNull() | F.is_variant_null(own) | (F.schema_of_variant(own) == "STRING")


def parse_files(files: DataFrame, name: str = "file_name", value: str = "value") -> DataFrame:
    """(file_name, items array<variant>, parse_failed) of each document.

    A document fails as a whole if it is not JSON, not an object, or if items, an item, its DOI or its list of references
    has a wrong type; null counts as wrong for the lists. Absent lists are empty.
    """
    doc = with_variant(files.select(F.col(name).alias("file_name"), F.col(value).alias("value")), F.col("value"), "v")
    doc = doc.select("file_name", "v", _at(F.col("v"), "items", "array<variant>").alias("items"))
    fine = _is_object(F.col("v")) & _absent_or_list(F.col("v"), "items") & F.coalesce(F.forall("items", lambda i: _is_object(i) & _absent_or_text(i, "DOI") & _absent_or_list(i, "reference")), F.lit(True))
    return doc.select("file_name", "items", (~F.coalesce(fine, F.lit(False))).alias("parse_failed"))


def explode_items(parsed: DataFrame) -> DataFrame:
    """(file_name, item_pos, doi, references) of every item of documents that did not fail; doi as written."""
    items = parsed.where("NOT parse_failed").select("file_name", F.posexplode("items").alias("item_pos", "item"))
    return items.select("file_name", "item_pos", _at(F.col("item"), "DOI", "string").alias("doi"), _at(F.col("item"), "reference", "array<variant>").alias("references"))


def _with_fields(each: DataFrame, *keys: str) -> DataFrame:
    """keys, citing_doi, ref_index and ref of each reference, with its six fields and whether they can be read."""
    fine = _is_object(F.col("ref"))
    for field in FIELDS.values():
        fine = fine & _absent_or_text(F.col("ref"), field)
    read = F.struct(*(_at(F.col("ref"), f, "string").alias(c) for c, f in FIELDS.items()), F.coalesce(fine, F.lit(False)).alias("parseable"))
    # a generator of one row: later filters can't be pulled below it, where they would read the fields again
    return each.select("*", F.explode(F.array(read)).alias("f")).select(*keys, "citing_doi", "ref_index", "ref", "f.*")


def explode_references(items: DataFrame) -> DataFrame:
    """One row per reference of items with a DOI: citing_doi in lower case, 0-based ref_index, the six fields, ref, parseable."""
    each = items.where("doi IS NOT NULL").select("file_name", "item_pos", F.lower("doi").alias("citing_doi"), F.posexplode("references").alias("ref_index", "ref"))
    return _with_fields(each, "file_name", "item_pos")


def match_references(references: DataFrame) -> DataFrame:
    """Adds searched (whether the pattern was run) and cited (DOIs found; NULL where it was not run)."""
    with_text = references.withColumn("search_text", F.when(F.col("parseable") & has_searchable_content(), search_text()))
    searched = F.coalesce((F.col("search_text") != "") & likely_arxiv(F.col("search_text")), F.lit(False))
    return with_text.withColumn("searched", searched).withColumn("cited", F.when(F.col("searched"), arxiv_dois(F.col("search_text"))))


def candidate_citations(matched: DataFrame) -> DataFrame:
    """One row per cited DOI of each reference, with provenance and other_work, before any filter."""
    each = matched.where("searched").select("file_name", "item_pos", "citing_doi", "ref_index", "doi", "asserted_by", "ref", F.explode("cited").alias("cited_id"))
    return each.select("file_name", "item_pos", "citing_doi", "ref_index", "cited_id", provenance(F.col("doi"), F.col("asserted_by"), F.col("cited_id")).alias("provenance"), "ref", is_other_work(F.col("citing_doi"), F.col("cited_id")).alias("other_work"))


def citation_rows(candidates: DataFrame, allowed: Sequence[str] = ()) -> DataFrame:
    """The staged relation: candidates that are no self-citations and of an allowed provenance; ref_json is written last."""
    kept = candidates.where(F.col("other_work") & provenance_allowed(F.col("provenance"), allowed))
    return kept.select("citing_doi", "ref_index", "cited_id", "provenance", F.to_json("ref").alias("ref_json"))


def extract_citations(files: DataFrame, allowed: Sequence[str] = ()) -> DataFrame:
    """Citation rows of raw documents (file_name, value), in one narrow chain of expressions without any shuffle.

    NULL, blank and broken documents give none; a bad reference spoils only itself. Equal references are kept, each
    under its own index; documents delivered twice give their rows twice (dedup_citations removes them).
    """
    return citation_rows(candidate_citations(match_references(explode_references(explode_items(parse_files(files))))), allowed)


def document_references(files: DataFrame) -> DataFrame:
    """One row per reference of each document, one for an item, or a document, that has none: all that rows and counters are made of.

    file_name, parse_failed, n_items, opens (on the first row of a document only), and of the reference ref_index (NULL
    where there is none), citing_doi, parseable, searched, cited, doi, asserted_by, and ref_json where something is cited.
    Every document is parsed once; written down, the table serves the staged rows, the counters and the manifest.
    """
    parsed = parse_files(files)
    n_items = F.when(F.col("parse_failed"), 0).otherwise(F.greatest(F.coalesce(F.size("items"), F.lit(0)), F.lit(0)))
    items = parsed.select("file_name", "parse_failed", n_items.alias("n_items"), F.posexplode_outer(F.when(~F.col("parse_failed"), F.col("items"))).alias("item_pos", "item"))
    doi = F.lower(_at(F.col("item"), "DOI", "string"))
    each = items.select("file_name", "parse_failed", "n_items", "item_pos", doi.alias("citing_doi"), F.posexplode_outer(F.when(doi.isNotNull(), _at(F.col("item"), "reference", "array<variant>"))).alias("ref_index", "ref"))
    matched = match_references(_with_fields(each, "file_name", "parse_failed", "n_items", "item_pos"))
    opens = (F.coalesce("item_pos", F.lit(0)) == 0) & (F.coalesce("ref_index", F.lit(0)) == 0)
    ref_json = F.when(F.size("cited") > 0, F.to_json("ref")).alias("ref_json")
    return matched.select("file_name", "parse_failed", "n_items", opens.alias("opens"), "item_pos", "ref_index", "citing_doi", "parseable", "searched", "cited", "doi", "asserted_by", ref_json)


def citations_of(references: DataFrame, allowed: Sequence[str] = ()) -> DataFrame:
    """The staged relation out of document_references; the same rows as extract_citations."""
    each = references.where(F.size("cited") > 0).select("citing_doi", "ref_index", "doi", "asserted_by", "ref_json", F.explode("cited").alias("cited_id"))
    kept = each.withColumn("provenance", provenance(F.col("doi"), F.col("asserted_by"), F.col("cited_id")))
    kept = kept.where(is_other_work(F.col("citing_doi"), F.col("cited_id")) & provenance_allowed(F.col("provenance"), allowed))
    return kept.select("citing_doi", "ref_index", "cited_id", "provenance", "ref_json")


def document_status(references: DataFrame) -> DataFrame:
    """(file_name, status) of each document of document_references: failed or done."""
    return references.where("opens").select("file_name", F.when(F.col("parse_failed"), "failed").otherwise("done").alias("status"))


def reference_counters(references: DataFrame, allowed: Sequence[str] = ()) -> DataFrame:
    """One row of counters of document_references: files, files_failed, items, refs_unparseable, no_match, filtered_self_cite, filtered_provenance, extracted."""
    searched = F.coalesce("searched", F.lit(False)) & F.col("ref_index").isNotNull()
    kept = F.transform("cited", lambda d: F.struct(is_other_work(F.col("citing_doi"), d).alias("other"), provenance_allowed(provenance(F.col("doi"), F.col("asserted_by"), d), allowed).alias("allowed")))
    each = references.select("opens", "parse_failed", "n_items", "ref_index", "parseable", searched.alias("searched"), "cited", kept.alias("kept"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    sized = lambda keep: total(F.when(F.col("searched"), F.size(F.filter("kept", keep))))
    return each.agg(
        F.count_if("opens").alias("files"),
        F.count_if(F.col("opens") & F.col("parse_failed")).alias("files_failed"),
        total(F.when(F.col("opens"), F.col("n_items"))).alias("items"),
        F.count_if(F.col("ref_index").isNotNull() & ~F.col("parseable")).alias("refs_unparseable"),
        F.count_if(F.col("searched") & (F.size("cited") == 0)).alias("no_match"),
        sized(lambda k: ~k["other"]).alias("filtered_self_cite"),
        sized(lambda k: k["other"] & ~k["allowed"]).alias("filtered_provenance"),
        sized(lambda k: k["other"] & k["allowed"]).alias("extracted"),
    )


def extraction_stats(files: DataFrame, allowed: Sequence[str] = ()) -> DataFrame:
    """The counters of raw documents, in one scan and one parse of each."""
    return reference_counters(document_references(files), allowed)
