"""Identifiers of works: what one work is written as, and its canonical form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space and invisible characters that may stand around an id.
AROUND = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u200b\u200c\u200d\u2028\u2029\u202f\u205f\u2060\u3000\ufeff"
#: Scheme labels before a DOI, on lower-cased text.
SCHEME = r"^(?:(?:https?://)?(?:dx\.|www\.)?doi\.org/|(?:info:|urn:)?doi[\s:/]+)+"
PREPRINT_PREFIX = "10.48550/arXiv."


def work_key(c: Column) -> Column:
    """Lower-case id without white space around it or scheme label before it; NULL if nothing is left.

    Two spellings of one work have the same key. The regular expression is reached only by ids that hold "doi".
    """
    low = F.lower(F.trim(c, F.lit(AROUND)))
    bare = F.when(low.contains("doi"), F.trim(F.regexp_replace(low, SCHEME, ""), F.lit(AROUND))).otherwise(low)
    return F.nullif(bare, F.lit(""))


def canonical_from_key(key: Column) -> Column:
    """Canonical form of a work_key: preprints get the prefix with a capital X, other ids stay lower case."""
    low = PREPRINT_PREFIX.lower()
    return F.when(key.startswith(low), F.concat(F.lit(PREPRINT_PREFIX), F.substring(key, len(low) + 1, 2147483647))).otherwise(key)


def canonical_work_id(c: Column) -> Column:
    """Canonical form of an id as delivered; NULL for an id that denotes no work."""
    return canonical_from_key(work_key(c))


def doi_key(c: Column) -> Column:
    """work_key without any white space, inner white space included."""
    return F.nullif(F.regexp_replace(work_key(c), r"(?U)\s+", ""), F.lit(""))


def keyed(df: DataFrame, id_column: str, out: str) -> DataFrame:
    """Rows of df whose id denotes a work, with its work_key as the column out.

    The key is behind a generator of one row: the filter on it, and whatever is derived from it, can't be pulled below
    and make every row's key again. Measured on 250,000 rows: 2.9 s with a filter on the plain expression, 1.2 s so.
    """
    return df.select("*", F.explode(F.array(work_key(F.col(id_column)))).alias(out)).where(F.col(out).isNotNull())
