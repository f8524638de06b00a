"""Sampled citation pairs held against other citation sources, which are tables here.

    works     (doi, ref_pos, key, ref_doi, unstructured, article_title, journal_title, volume_title): references of works
    openalex  (doi, id), and openalex_refs (doi, referenced_work)
    events    (doi, subj_id)
    oc_refs   (citing_doi, ref_pos, cited, oci)

References come one per row, not as arrays: a work with a million of them is then no problem. All joins are on a DOI;
what a service says about a pair is aggregated by pair, with map-side partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: ids in free text, bare ones included.
FREE_ID = r"(?iU)(?:arXiv[:\s./]*)?(\d{4}\.\d{4,5}(?:v\d+)?)"

#: Subsets of the summary and the condition of each.
SUBSETS = {
    "asserted": "source = 'asserted'",
    "asserted_publisher": "source = 'asserted' AND doi_asserted_by = 'publisher'",
    "asserted_crossref": "source = 'asserted' AND doi_asserted_by = 'crossref'",
    "mined": "source = 'mined'",
    "total": "true",
}


def parse_ratio(text: str) -> tuple[int, int]:
    """(asserted, mined) of "X:Y"."""
    parts = text.split(":")
    if len(parts) != 2 or not all(p.strip().isdigit() for p in parts) or sum(map(int, parts)) == 0:
        raise ValueError(f"Invalid ratio: '{text}'; expected X:Y")
    return int(parts[0]), int(parts[1])


def bare_doi(c: Column) -> Column:
    """Lower-case DOI without the resolver's address."""
    return F.replace(F.replace(F.lower(c), F.lit("https://doi.org/"), F.lit("")), F.lit("http://doi.org/"), F.lit(""))


def citation_samples(records: DataFrame, source: str) -> DataFrame:
    """Every pair of (arxiv_doi, arxiv_id, cited_by array<struct<doi, matches array<struct<raw_match, reference json>>>>) that can be sampled.

    Pairs without citing DOI or without a match are left out; the first match is taken.
    """
    each = records.select("arxiv_doi", "arxiv_id", F.explode("cited_by").alias("c")).where("c.doi <> '' AND size(c.matches) > 0")
    first = F.element_at("c.matches", 1)
    ref = F.try_parse_json(first["reference"])
    return each.select(
        bare_doi(F.col("c.doi")).alias("citing_doi"), "arxiv_id", "arxiv_doi", F.lit(source).alias("source"), first["raw_match"].alias("raw_match"),
        F.try_variant_get(ref, "$.DOI", "variant").isNotNull().alias("has_structured_doi_in_source"), F.try_variant_get(ref, "$['doi-asserted-by']", "string").alias("doi_asserted_by"),
    )


def sample_pairs(pairs: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """n pairs, each set of n as likely as any other: those with the smallest hashes, of all pairs and not of a head.

    The same seed draws the same pairs from equal tables, however they are stored. A limit in order keeps n rows a task.
    """
    keys = [F.col(c).cast("string") for c in pairs.columns]
    return pairs.orderBy(F.xxhash64(F.lit(seed), *keys), *pairs.columns).limit(n)


def stratified_sample(asserted: DataFrame, mined: DataFrame, n: int, ratio: tuple[int, int], seed: int = 42) -> DataFrame:
    """n pairs in the given ratio, rounded down for asserted, in random order."""
    first = n * ratio[0] // sum(ratio)
    both = sample_pairs(asserted, first, seed).unionByName(sample_pairs(mined, n - first, seed + 1))
    return both.orderBy(F.xxhash64(F.lit(seed), "citing_doi", "arxiv_doi"), "citing_doi", "arxiv_doi")


def _before_version(c: Column) -> Column:
    return F.substring_index(c, "v", 1)


def _bool(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False)).alias(name)


def verify_references(samples: DataFrame, works: DataFrame) -> DataFrame:
    """Adds crossref_*: whether the citing work is known, has references, and how the cited id appears in them.

    References are looked at in order until one has a DOI with the id, or a free text with it; an id in a title counts
    as an unstructured match but does not end the search, and the last such title gives the key unless a decisive one follows.
    """
    # ids are read once per reference, before it meets its pairs: behind a generator of one row, which no later step repeats
    ids = F.transform(F.regexp_extract_all("unstructured", F.lit(FREE_ID), F.lit(1)), _before_version)
    r = works.select(F.lower("doi").alias("__doi"), "ref_pos", "key", F.lower("ref_doi").alias("d"), F.explode(F.array(ids)).alias("ids"), *(F.coalesce(c, F.lit("")).alias(c) for c in ("article_title", "journal_title", "volume_title")))
    at = samples.select(F.col("citing_doi"), "arxiv_id").distinct().join(r, F.col("citing_doi") == F.col("__doi"), "left")
    structured = F.coalesce((F.col("d") != "") & F.col("d").contains("arxiv") & F.col("d").contains(F.col("arxiv_id")), F.lit(False))
    free = F.coalesce(F.array_contains("ids", _before_version(F.col("arxiv_id"))), F.lit(False))
    titled = F.exists(F.array("article_title", "journal_title", "volume_title"), lambda t: t.contains(F.col("arxiv_id")))
    seen = at.select("citing_doi", "arxiv_id", "__doi", "ref_pos", "key", structured.alias("s"), (~structured & free).alias("u"), (~structured & ~free & titled).alias("t"))
    is_ref = F.col("ref_pos").isNotNull()
    decisive = F.min(F.when(F.col("s") | F.col("u"), F.struct("ref_pos", "key", "s"))).alias("first")
    titles = F.array_agg(F.when(F.col("t"), F.struct("ref_pos", "key"))).alias("titles")
    got = seen.groupBy("citing_doi", "arxiv_id").agg(F.max(F.col("__doi").isNotNull()).alias("crossref_found"), F.max(is_ref).alias("crossref_has_references"), decisive, titles)
    before = F.filter("titles", lambda t: F.col("first").isNull() | (t["ref_pos"] < F.col("first.ref_pos")))
    titled_key = F.array_max(before)["key"]
    out = got.select(
        "citing_doi", "arxiv_id", _bool("crossref_found"), _bool("crossref_has_references"),
        F.coalesce(F.col("first.s"), F.lit(False)).alias("crossref_structured_doi_match"),
        F.coalesce(~F.col("first.s"), F.lit(False)).alias("__u") , (F.size(before) > 0).alias("__t"),
        F.when(F.col("first").isNotNull(), F.col("first.key")).otherwise(titled_key).alias("crossref_reference_key"),
    ).withColumn("crossref_unstructured_match", F.col("__u") | F.col("__t")).drop("__u", "__t")
    return samples.join(out.withColumn("crossref_error", F.when(~F.col("crossref_found"), "not_found")), ["citing_doi", "arxiv_id"], "left")


def verify_referenced_works(samples: DataFrame, openalex: DataFrame, openalex_refs: DataFrame) -> DataFrame:
    """Adds openalex_*: whether the citing work is known and names the cited work's id among its references."""
    ids = openalex.groupBy(F.lower("doi").alias("__doi")).agg(F.min("id").alias("id"))
    cited = ids.select(F.col("__doi").alias("__cited"), F.col("id").alias("openalex_arxiv_work_id"))
    citing = ids.select(F.col("__doi").alias("__citing"), F.lit(True).alias("openalex_citing_found"))
    named = openalex_refs.select(F.lower("doi").alias("__ref_doi"), F.col("referenced_work").alias("__ref")).distinct().withColumn("openalex_arxiv_in_refs", F.lit(True))
    out = samples.join(cited, F.lower("arxiv_doi") == F.col("__cited"), "left").join(citing, F.col("citing_doi") == F.col("__citing"), "left")
    out = out.join(named, (F.col("citing_doi") == F.col("__ref_doi")) & (F.col("openalex_arxiv_work_id") == F.col("__ref")), "left")
    out = out.withColumns({"openalex_citing_found": _bool("openalex_citing_found"), "openalex_arxiv_in_refs": F.coalesce(F.col("openalex_arxiv_in_refs") & F.col("openalex_citing_found"), F.lit(False))})
    return out.withColumn("openalex_error", F.when(~F.col("openalex_citing_found"), "citing_not_found")).drop("__cited", "__citing", "__ref_doi", "__ref")


def verify_events(samples: DataFrame, events: DataFrame) -> DataFrame:
    """Adds datacite_*: how many events the cited DOI has, and whether the citing work is the subject of one.

    All events are looked at, not the first thousand.
    """
    e = events.select(F.lower("doi").alias("__doi"), F.lower("subj_id").alias("__subj"))
    totals = e.groupBy("__doi").agg(F.count(F.lit(1)).alias("datacite_total_events"))
    found = e.distinct().withColumn("datacite_event_found", F.lit(True)).withColumnRenamed("__doi", "__event_doi")
    out = samples.join(totals, F.lower("arxiv_doi") == F.col("__doi"), "left").drop("__doi")
    out = out.join(found, (F.lower("arxiv_doi") == F.col("__event_doi")) & (F.lower(F.concat(F.lit("https://doi.org/"), "citing_doi")) == F.col("__subj")), "left").drop("__event_doi", "__subj")
    return out.withColumns({"datacite_event_found": _bool("datacite_event_found"), "datacite_error": F.when(F.col("datacite_total_events").isNull(), "no_response")})


def verify_contained(samples: DataFrame, oc_refs: DataFrame) -> DataFrame:
    """Adds opencitations_*: whether the citing work is known and the first of its references whose text holds the cited DOI."""
    r = oc_refs.select(F.lower("citing_doi").alias("__citing"), "ref_pos", F.lower("cited").alias("__cited"), "oci")
    pairs = samples.select("citing_doi", "arxiv_doi").distinct().join(r, F.col("citing_doi") == F.col("__citing"))
    hit = F.col("__cited").contains(F.lower("arxiv_doi"))
    got = pairs.groupBy("citing_doi", "arxiv_doi").agg(F.lit(True).alias("opencitations_citing_found"), F.coalesce(F.max(hit), F.lit(False)).alias("opencitations_arxiv_in_refs"), F.min(F.when(hit, F.struct("ref_pos", "oci")))["oci"].alias("opencitations_oci"))
    out = samples.join(got, ["citing_doi", "arxiv_doi"], "left")
    out = out.withColumns({c: _bool(c) for c in ("opencitations_citing_found", "opencitations_arxiv_in_refs")})
    return out.withColumn("opencitations_error", F.when(~F.col("opencitations_citing_found"), "no_references"))


def compare_summary(results: DataFrame) -> DataFrame:
    """One row per subset with 17 measures; an empty subset has its count, 0, and NULL elsewhere.

    Subsets overlap: a pair is in each whose condition holds, by one pass that explodes the labels.
    """
    labels = F.array_compact(F.array(*(F.when(F.expr(cond), F.lit(name)) for name, cond in SUBSETS.items())))
    structured, unstructured = F.col("crossref_structured_doi_match"), F.col("crossref_unstructured_match")
    flags = {
        "crossref_citing_found": F.col("crossref_found"),
        "crossref_has_references": F.col("crossref_has_references"),
        "crossref_structured_doi_match": structured,
        "crossref_unstructured_only": unstructured & ~structured,
        "crossref_no_match": F.col("crossref_has_references") & ~structured & ~unstructured,
        "openalex_citing_found": F.col("openalex_citing_found"),
        "openalex_arxiv_in_refs": F.col("openalex_arxiv_in_refs"),
        "datacite_event_found": F.col("datacite_event_found"),
        "opencitations_citing_found": F.col("opencitations_citing_found"),
        "opencitations_arxiv_in_refs": F.col("opencitations_arxiv_in_refs"),
    }
    rates = {
        "crossref_structured_match_rate": "crossref_structured_doi_match", "crossref_unstructured_only_rate": "crossref_unstructured_only", "crossref_no_match_rate": "crossref_no_match",
        "openalex_match_rate": "openalex_arxiv_in_refs", "datacite_event_match_rate": "datacite_event_found", "opencitations_match_rate": "opencitations_arxiv_in_refs",
    }
    each = results.select(F.explode(labels).alias("subset"), *(c.alias(n) for n, c in flags.items()))
    counted = each.groupBy("subset").agg(F.count(F.lit(1)).alias("count"), *(F.count_if(n).alias(n) for n in flags))
    all_subsets = results.sparkSession.createDataFrame([(s,) for s in SUBSETS], "subset string")
    out = all_subsets.join(counted, "subset", "left").withColumn("count", F.coalesce("count", F.lit(0)).cast("bigint"))
    return out.withColumns({r: F.try_divide(F.col(n).cast("double"), F.col("count").cast("double")) for r, n in rates.items()})
