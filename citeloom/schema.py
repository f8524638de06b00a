"""Schemas of the relations that are staged and written."""

from __future__ import annotations

#: Staged citation rows; part is the directory they are in.
CITATION_ROW = "citing_doi string, ref_index int, cited_id string, provenance string, ref_json string"
#: Raw documents.
RAW_FILE = "file_name string, value string"
# Names and order of columns, as readers of the files know them.
#: One sampled citation pair.
CITATION_SAMPLE = "citing_doi string, arxiv_id string, arxiv_doi string, source string, raw_match string, has_structured_doi_in_source boolean, doi_asserted_by string"
#: One verified pair, in the order of the CSV's columns.
VERIFICATION = (
    "citing_doi string, arxiv_id string, source string, doi_asserted_by string,"
    " crossref_found boolean, crossref_has_references boolean, crossref_structured_doi_match boolean, crossref_unstructured_match boolean, crossref_reference_key string, crossref_error string,"
    " openalex_citing_found boolean, openalex_arxiv_in_refs boolean, openalex_arxiv_work_id string, openalex_error string,"
    " datacite_event_found boolean, datacite_total_events bigint, datacite_error string,"
    " opencitations_citing_found boolean, opencitations_arxiv_in_refs boolean, opencitations_oci string, opencitations_error string, notes string"
)
