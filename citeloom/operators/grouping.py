"""Citation rows to one record per cited work: dedup, ordered lists, counts, provenance views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions.references import PROVENANCES, provenance_rank
from citeloom.session import bounded_broadcast, materialize

#: Citations of one record at most; a work with more comes in pages.
PAGE = 100_000
#: Works in pages, or parts of their lists, that may be broadcast; of more, each meets its citations in SALTS places.
BROADCAST_WORKS = 100_000
SALTS = 64


def staged_defaults(rows: DataFrame) -> DataFrame:
    """Citation rows with the defaults of absent values: "", 0, "", "mined" and "null"."""
    defaults = {"citing_doi": F.lit(""), "ref_index": F.lit(0), "cited_id": F.lit(""), "provenance": F.lit("mined"), "ref_json": F.lit("null")}
    return rows.select(*(F.coalesce(F.col(c), d).alias(c) if c in rows.columns else d.alias(c) for c, d in defaults.items()))


def drop_exact_self(rows: DataFrame) -> DataFrame:
    """Rows whose cited id is not, to the letter, the citing DOI."""
    return rows.where("citing_doi <> cited_id")


def dedup_citations(rows: DataFrame) -> DataFrame:
    """One row per (cited_id, citing_doi, ref_index), defaults filled in, exact self-citations left out.

    Of several, the one with the strongest provenance holds, then the least provenance and ref_json as text: the
    choice does not depend on the order of files. The shuffle is on all three columns, so a hot work is no hot key.
    """
    best = F.min(F.struct(provenance_rank(F.col("provenance")).alias("rank"), "provenance", "ref_json")).alias("b")
    return drop_exact_self(staged_defaults(rows)).groupBy("cited_id", "citing_doi", "ref_index").agg(best).select("cited_id", "citing_doi", "ref_index", "b.provenance", "b.ref_json", "b.rank")


def work_counts(citations: DataFrame) -> DataFrame:
    """(cited_id, citation_count, publisher_count, crossref_count, mined_count); unknown provenances count as mined."""
    by = {p: F.count_if(provenance_rank(F.col("provenance")) == i).alias(f"{p}_count") for i, p in enumerate(PROVENANCES)}
    return citations.groupBy("cited_id").agg(F.count(F.lit(1)).alias("citation_count"), *by.values())


def _positions(hot: DataFrame) -> DataFrame:
    """hot, rows of works with many citations, with at: each row's 0-based place in the order of its work's list.

    Rows are spread by ranges of the whole order, so a work of any size is cut among tasks; a row's place is its place
    within its task's part of the work, and the rows of the work in the parts before.
    """
    order = ["cited_id", "rank", "citing_doi", "ref_index"]
    parts = materialize(hot.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "hot-citations")
    sizes = parts.groupBy("cited_id", "__part").agg(F.count(F.lit(1)).alias("__size"))  # one row per work and part it is in
    before = F.sum("__size").over(Window.partitionBy("cited_id").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts, _ = bounded_broadcast(sizes.select("cited_id", "__part", F.coalesce(before, F.lit(0)).alias("__start")), BROADCAST_WORKS)
    within = F.row_number().over(Window.partitionBy("__part", "cited_id").orderBy(*order[1:])) - 1
    return parts.withColumn("__within", within).join(starts, ["cited_id", "__part"]).withColumn("at", F.col("__start") + F.col("__within")).drop("__part", "__within", "__start")


def _flagged(citations: DataFrame, hot: DataFrame, hot_rows: int) -> DataFrame:
    """citations with the columns of hot where their work is in it. Hot works are broadcast, or, where they are too many, salted: each meets its citations in SALTS places."""
    if hot_rows <= BROADCAST_WORKS:
        return citations.join(F.broadcast(hot), "cited_id", "left")
    salted = hot.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"))
    return citations.withColumn("__salt", F.pmod(F.xxhash64("citing_doi", "ref_index"), F.lit(SALTS)).cast("int")).join(salted, ["cited_id", "__salt"], "left").drop("__salt")


def grouped_citations(citations: DataFrame, page: int = PAGE) -> DataFrame:
    """(cited_id, page_no, n_pages, citation_count, publisher_count, crossref_count, mined_count, cited_by): deduplicated citations grouped by work, in order of provenance, citing DOI, index.

    cited_by holds struct<doi, ref_index, provenance, ref_json>; all counts are the work's totals, on every page. The
    list of a work with more citations than page is cut into pages of page citations each but for the last; put one
    behind the other by page_no they are the work's list. So no record, and no task's share of a hot work, grows without
    bound. All other works have the one page 0. Nothing is left out. Which works are hot is counted before.
    """
    by = {p: f"{p}_count" for p in PROVENANCES}
    hot = materialize(work_counts(citations).withColumnRenamed("citation_count", "total").where(F.col("total") > page), "hot-works")  # at most rows / page
    hot_rows = hot.count()
    columns = ["cited_id", "citing_doi", "ref_index", "provenance", "ref_json", "rank"]
    totals = ["total", *by.values()]
    if hot_rows:
        flagged = _flagged(citations.select(columns), hot, hot_rows)
        cold = flagged.where("total IS NULL").withColumn("page_no", F.lit(0))
        paged = _positions(flagged.where("total IS NOT NULL")).withColumn("page_no", F.floor(F.col("at") / page).cast("int"))
        placed = cold.unionByName(paged.select(cold.columns))
    else:
        placed = citations.select(*columns, *(F.lit(None).cast("bigint").alias(c) for c in totals))
    entry = F.struct(F.col("rank"), F.col("citing_doi").alias("doi"), "ref_index", "provenance", "ref_json")
    # without pages the work alone is the key, by which later joins find the lists in place
    lists = placed.groupBy("cited_id", *(["page_no"] if hot_rows else [])).agg(*(F.max(c).alias(c) for c in totals), F.array_sort(F.collect_list(entry)).alias("l"))
    out = F.transform("l", lambda c: F.struct(c["doi"].alias("doi"), c["ref_index"].alias("ref_index"), c["provenance"].alias("provenance"), c["ref_json"].alias("ref_json")))
    ranks = F.transform("l", lambda c: c["rank"])
    own = [F.coalesce(by[p], F.size(F.filter(ranks, F.lit(i).eqNullSafe)).cast("bigint")).alias(by[p]) for i, p in enumerate(PROVENANCES)]
    n_pages = F.coalesce(F.ceil(F.col("total") / page), F.lit(1)).cast("int").alias("n_pages")
    page_no = F.col("page_no") if hot_rows else F.lit(0).alias("page_no")
    return lists.select("cited_id", page_no, n_pages, F.coalesce("total", F.size("l").cast("bigint")).alias("citation_count"), *own, out.alias("cited_by"))


def with_work_flags(grouped: DataFrame, works: DataFrame, page: int = PAGE) -> DataFrame:
    """grouped_citations, made with the same page, with is_valid of works (cited_id, citation_count, is_valid).

    Flags are repeated for each page and joined on work and page, by which the lists lie already: only flags are shuffled.
    """
    last = F.greatest(F.ceil(F.col("citation_count") / page).cast("int") - 1, F.lit(0))
    flags = works.select("cited_id", F.explode(F.sequence(F.lit(0), last)).alias("page_no"), "is_valid")
    return grouped.join(flags, ["cited_id", "page_no"])


def of_provenance(grouped: DataFrame, provenance: str) -> DataFrame:
    """The same records with the citations of one provenance; works without any are left out.

    citation_count is the work's total of that provenance, on every page of it; pages without any such citation are left out.
    """
    rank = PROVENANCES.index(provenance)
    own = grouped.withColumn("cited_by", F.filter("cited_by", lambda c: provenance_rank(c["provenance"]) == rank))
    return own.where(F.size("cited_by") > 0).withColumn("citation_count", F.col(f"{provenance}_count"))


def record_json(cited_id: Column, citation_count: Column, cited_by: Column, page_no: Column | None = None, n_pages: Column | None = None) -> Column:
    """The JSON line of a record: doi, citation_count, cited_by with doi, provenance and the reference as JSON, null if it is none.

    A work in several pages has its page and the number of pages in each line too; put together they are its record.
    """
    entries = F.transform(cited_by, lambda c: F.struct(c["doi"].alias("doi"), c["provenance"].alias("provenance"), F.coalesce(F.try_parse_json(c["ref_json"]), F.parse_json(F.lit("null"))).alias("reference")))
    pages = [] if page_no is None or n_pages is None else [F.when(n_pages > 1, page_no).alias("page"), F.when(n_pages > 1, n_pages).alias("pages")]
    return F.to_json(F.struct(cited_id.alias("doi"), citation_count.alias("citation_count"), *pages, entries.alias("cited_by")))
