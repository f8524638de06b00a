"""Preprint identifiers in text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeloom.functions.ids import PREPRINT_PREFIX

# The forms in which an identifier is found, in order of priority, and what stands before the id.
ARXIV_PATTERN = (
    r"10\.48550/arxiv\.\d{4}\.\d{4,6}(?:v\d+)?"
    r"|arxiv\.org/(?:abs|pdf)/(?:\d{4}\.\d{4,6}(?:v\d+)?|[a-z][a-z0-9.-]*/\d{7}(?:v\d+)?)"
    r"|arxiv[.:\s]+\d{4}\.\d{4,6}(?:v\d+)?"
    r"|arxiv[.:\s]+[a-z][a-z0-9.-]*/\s*\d{7}(?:v\d+)?"
)
ARXIV_LEAD = r"^(?:10\.48550/arxiv\.|arxiv\.org/(?:abs|pdf)/|arxiv[.:\s]+)"
# Fixed value: digits, white space and letter case count as Unicode has them.
FLAGS = "(?iU)"


def normalize_arxiv_id(c: Column) -> Column:
    """Lower case, without white space, and without a version if the first v begins it."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"(?U)\s+", ""), "^([^v]*)v[0-9]+$", "$1")


def arxiv_ids(text: Column) -> Column:
    """Distinct normalised ids in text, sorted; an empty array if there are none, NULL for NULL."""
    found = F.regexp_extract_all(text, F.lit(FLAGS + ARXIV_PATTERN), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(found, lambda m: normalize_arxiv_id(F.regexp_replace(m, FLAGS + ARXIV_LEAD, "")))))


def arxiv_doi(arxiv_id: Column) -> Column:
    """The DOI of a normalised id."""
    return F.concat(F.lit(PREPRINT_PREFIX), arxiv_id)


def arxiv_dois(text: Column) -> Column:
    """DOIs of all ids in text."""
    return F.transform(arxiv_ids(text), arxiv_doi)


def likely_arxiv(text: Column) -> Column:
    """Whether text can hold an identifier at all: the cheap test before the pattern."""
    return F.lower(text).contains("arxiv")


def partition_key(c: Column) -> Column:
    """Directory of a cited id: first four characters of a preprint's id, the registrant of another DOI."""
    rest = F.regexp_replace(F.lower(c), r"^10\.48550/arxiv\.", "")
    return F.when(rest.startswith("10.") & rest.contains("/"), F.substring_index(rest, "/", 1)).otherwise(F.translate(F.substring(rest, 1, 4), "/", "_"))
