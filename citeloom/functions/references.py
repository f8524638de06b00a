"""What one reference says: its search text, who asserted it, and whether it is kept."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Column of each declared field of a reference object.
FIELDS = {"doi": "DOI", "url": "URL", "unstructured": "unstructured", "article_title": "article-title", "journal_title": "journal-title", "asserted_by": "doi-asserted-by"}
#: Fields in the order in which they are searched; matches may span two of them.
SEARCHED = ("doi", "url", "article_title", "journal_title", "unstructured")
#: Provenances from the strongest.
PROVENANCES = ("publisher", "crossref", "mined")


def _own(columns: Mapping[str, Column] | None) -> Mapping[str, Column]:
    return columns or {f: F.col(f) for f in FIELDS}


def has_searchable_content(columns: Mapping[str, Column] | None = None) -> Column:
    """Whether any searched field is there, be it empty."""
    c = _own(columns)
    return F.coalesce(*(c[f] for f in SEARCHED)).isNotNull()


def search_text(columns: Mapping[str, Column] | None = None) -> Column:
    """The searched fields that are there, each but the last with a space behind it."""
    c = _own(columns)
    return F.concat(*(F.coalesce(F.concat(c[f], F.lit(" ")), F.lit("")) for f in SEARCHED[:-1]), F.coalesce(c[SEARCHED[-1]], F.lit("")))


def provenance(doi: Column, asserted_by: Column, cited_doi: Column) -> Column:
    """publisher or crossref if the reference's own DOI is the cited one and one of them asserted it, else mined."""
    return F.when((F.lower(doi) == F.lower(cited_doi)) & asserted_by.isin("publisher", "crossref"), asserted_by).otherwise("mined")


def provenance_rank(p: Column) -> Column:
    """0 for publisher, 1 for crossref, 2 for all else."""
    return F.when(p == "publisher", 0).when(p == "crossref", 1).otherwise(2)


def is_other_work(citing: Column, cited: Column) -> Column:
    """Not a self-citation, whatever the letter case."""
    return F.lower(citing) != F.lower(cited)


def provenance_allowed(p: Column, allowed: Sequence[str]) -> Column:
    """Whether p is among allowed, ignoring letter case; an empty list allows all."""
    return F.lower(p).isin([a.lower() for a in allowed]) if allowed else F.lit(True)
