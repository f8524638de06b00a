"""The comparison with other sources."""

from __future__ import annotations

import json

import pytest

from citeloom.operators.coverage import citation_samples, compare_summary, parse_ratio, sample_pairs, stratified_sample, verify_contained, verify_events, verify_referenced_works, verify_references
from citeloom.plans.pipeline import compare
from citeloom.sinks.writers import summary_document, summary_text, write_csv, write_summary

SAMPLE = "citing_doi string, arxiv_id string, arxiv_doi string, source string, raw_match string, has_structured_doi_in_source boolean, doi_asserted_by string"


def _samples(spark):
    doi = "10.48550/arXiv."
    values = [("w1", "2403.00001", doi + "2403.00001", "asserted", "", True, "publisher"), ("w1", "2403.00002", doi + "2403.00002", "mined", "", False, None), ("w2", "2403.00003", doi + "2403.00003", "asserted", "", True, "crossref"), ("w3", "2403.00001", doi + "2403.00001", "mined", "", False, None), ("w4", "2403.00001", doi + "2403.00001", "mined", "", False, None)]
    return spark.createDataFrame(values, SAMPLE)


def _works(spark):
    values = [
        ("W1", 0, "k0", None, "Bare 2403.00002v3", None, None, None), ("w1", 1, "k1", "10.48550/ARXIV.2403.00001", None, None, None, None), ("w1", 2, "k2", "10.48550/arxiv.2403.00002", None, None, None, None),
        ("w2", 0, "t0", None, None, "On 2403.00003", None, None), ("w2", 1, "t1", None, "nothing", None, None, "vol 2403.00003"), ("w3", None, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(values, "doi string, ref_pos int, key string, ref_doi string, unstructured string, article_title string, journal_title string, volume_title string")


def test_verify_references(spark):
    got = {(r.citing_doi, r.arxiv_id): (r.crossref_found, r.crossref_has_references, r.crossref_structured_doi_match, r.crossref_unstructured_match, r.crossref_reference_key, r.crossref_error) for r in verify_references(_samples(spark), _works(spark)).collect()}
    assert got == {("w1", "2403.00001"): (True, True, True, False, "k1", None), ("w1", "2403.00002"): (True, True, False, True, "k0", None), ("w2", "2403.00003"): (True, True, False, True, "t1", None), ("w3", "2403.00001"): (True, False, False, False, None, None), ("w4", "2403.00001"): (False, False, False, False, None, "not_found")}


def _others(spark):
    openalex = spark.createDataFrame([("W1", "A"), ("10.48550/arxiv.2403.00001", "B"), ("w2", "C")], "doi string, id string")
    refs = spark.createDataFrame([("w1", "B"), ("w1", "B"), ("w2", "Z")], "doi string, referenced_work string")
    events = spark.createDataFrame([("10.48550/arxiv.2403.00001", "HTTPS://doi.org/W1"), ("10.48550/arxiv.2403.00001", "https://doi.org/other")], "doi string, subj_id string")
    oc = spark.createDataFrame([("w1", 1, "doi:10.48550/ARXIV.2403.00001 omid:x", "second"), ("w1", 0, "doi:10.48550/arxiv.2403.00001", "first"), ("w2", 0, None, None)], "citing_doi string, ref_pos int, cited string, oci string")
    return openalex, refs, events, oc


def test_verify_others(spark):
    openalex, refs, events, oc = _others(spark)
    a = {(r.citing_doi, r.arxiv_id): (r.openalex_citing_found, r.openalex_arxiv_in_refs, r.openalex_arxiv_work_id, r.openalex_error) for r in verify_referenced_works(_samples(spark), openalex, refs).collect()}
    assert a[("w1", "2403.00001")] == (True, True, "B", None) and a[("w2", "2403.00003")] == (True, False, None, None) and a[("w3", "2403.00001")] == (False, False, "B", "citing_not_found")
    e = {(r.citing_doi, r.arxiv_id): (r.datacite_event_found, r.datacite_total_events) for r in verify_events(_samples(spark), events).collect()}
    assert e[("w1", "2403.00001")] == (True, 2) and e[("w3", "2403.00001")] == (False, 2) and e[("w2", "2403.00003")] == (False, None)
    o = {(r.citing_doi, r.arxiv_id): (r.opencitations_citing_found, r.opencitations_arxiv_in_refs, r.opencitations_oci) for r in verify_contained(_samples(spark), oc).collect()}
    assert o[("w1", "2403.00001")] == (True, True, "first") and o[("w1", "2403.00002")] == (True, False, None) and o[("w2", "2403.00003")] == (True, False, None) and o[("w4", "2403.00001")] == (False, False, None)


def test_summary(spark, tmp_path):
    openalex, refs, events, oc = _others(spark)
    results, summary = compare(_samples(spark), _works(spark), openalex, refs, events, oc)
    document = summary_document(summary)
    assert document["sample_size"] == {"asserted": 2, "asserted_publisher": 1, "asserted_crossref": 1, "mined": 3, "total": 5}
    assert document["asserted_results"]["crossref_structured_match_rate"] == 0.5 and document["mined_results"]["crossref_unstructured_only"] == 1 and document["mined_results"]["crossref_no_match"] == 0
    empty = summary_document(compare_summary(results.limit(0)))
    assert empty["asserted_results"] == {"count": 0}
    write_summary(summary, str(tmp_path / "s.json"))
    assert json.loads((tmp_path / "s.json").read_text())["asserted_publisher_results"]["count"] == 1
    assert "asserted publisher" in summary_text(summary)
    write_csv(results, str(tmp_path / "r"))
    assert spark.read.option("header", True).csv(str(tmp_path / "r")).count() == 5


def test_samples(spark):
    records = spark.createDataFrame(
        [("10.48550/arXiv.1", "1", [("https://doi.org/10.1/A", [("raw", '{"DOI":"x","doi-asserted-by":"publisher"}'), ("second", "{}")]), ("", [("raw", "{}")]), ("10.1/b", []), ("10.1/c", [("raw", '{"k":1}')])])],
        "arxiv_doi string, arxiv_id string, cited_by array<struct<doi string, matches array<struct<raw_match string, reference string>>>>",
    )
    got = sorted((r.citing_doi, r.raw_match, r.has_structured_doi_in_source, r.doi_asserted_by) for r in citation_samples(records, "asserted").collect())
    assert got == [("10.1/a", "raw", True, "publisher"), ("10.1/c", "raw", False, None)]


def test_sampling(spark):
    pairs = spark.range(500).selectExpr("concat('d', id) AS citing_doi", "concat('a', id) AS arxiv_doi", "if(id < 100, 'asserted', 'mined') AS source")
    first = sample_pairs(pairs, 50, 1)
    assert first.count() == first.distinct().count() == 50 and sorted(first.collect()) == sorted(sample_pairs(pairs.repartition(7), 50, 1).collect()) != sorted(sample_pairs(pairs, 50, 2).collect())
    mixed = stratified_sample(pairs.where("source = 'asserted'"), pairs.where("source = 'mined'"), 11, (50, 50))
    assert {r.source: r["count"] for r in mixed.groupBy("source").count().collect()} == {"asserted": 5, "mined": 6}
    assert sample_pairs(pairs.limit(0), 5).count() == 0 and sample_pairs(pairs, 9999).count() == 500


def test_ratio():
    assert parse_ratio("30:70") == (30, 70)
    for bad in ("1", "1:2:3", "a:b", "0:0", ""):
        with pytest.raises(ValueError):
            parse_ratio(bad)
