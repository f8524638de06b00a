"""Queries p2 and p6 to p8, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions.ids import canonical_from_key, keyed
from citeloom.llm.leakage import WINDOW, leaked_items
from citeloom.llm.packing import pack_texts
from citeloom.llm.pii import pii_places, redact
from citeloom.llm.threshold_topk import threshold_topk
from citeloom.plans.data_queries import sql_canonical
from citeloom.session import materialize, table

#: Tokens of a container in the queries.
CAPACITY = 2048


def p2_top_cited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 works with the most rows in merge_rows, with their counts."""
    top = threshold_topk(keyed(table(spark, sf_dir, "merge_rows").select("cited_id"), "cited_id", "__work"), canonical_from_key(F.col("__work")), 20)
    return top.select(F.col("item").alias("cited_id"), "n")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 works with the most rows in merge_rows."""
    return p2_top_cited(spark, sf_dir).select("cited_id")


def p6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of every text, or piece of a text, of documents."""
    return pack_texts(table(spark, sf_dir, "documents"), CAPACITY)


def p6_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens and pieces of every container."""
    return p6_pack(spark, sf_dir).groupBy("container_id").agg(F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_pieces"))


def p6_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: texts packed, texts whose pieces don't follow each other from the first token to the last, containers that hold too much, and those whose pieces overlap or leave gaps between them."""
    pieces = materialize(p6_pack(spark, sf_dir), "packed")
    docs = pieces.groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.max(F.col("token_start") + F.col("n_tokens")).alias("end"), F.count(F.lit(1)).alias("k"), F.max("piece_no").alias("last"), F.countDistinct("token_start").alias("starts"))
    containers = pieces.groupBy("container_id").agg(F.sum("n_tokens").alias("n"), F.max(F.col("container_offset") + F.col("n_tokens")).alias("end"), F.count(F.lit(1)).alias("k"), F.countDistinct("container_offset").alias("starts"))
    broken = (F.col("n") != F.col("end")) | (F.col("k") != F.col("starts"))
    of_docs = docs.agg(F.count(F.lit(1)).alias("n_texts"), F.count_if(broken | (F.col("k") != F.col("last") + 1)).alias("n_broken_texts"))
    of_containers = containers.agg(F.count_if(F.col("n") > CAPACITY).alias("n_overfull"), F.count_if(broken).alias("n_broken_containers"))
    return of_docs.join(F.broadcast(of_containers), F.lit(True))  # one row each


def p7_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the items they overlap with, replaced words allowed."""
    return leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold twelve consecutive words of an item, or all of a shorter one."""
    return p7_overlaps(spark, sf_dir).where(F.col("exact_words") >= F.least(F.lit(WINDOW), F.col("item_words"))).select("doc_id", "item_id")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place with personal information in documents."""
    return pii_places(table(spark, sf_dir, "documents"), table(spark, sf_dir, "known_names")).select("doc_id", "pii_kind", "span_start")


def p8_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of documents with placeholders."""
    return redact(table(spark, sf_dir, "documents"), table(spark, sf_dir, "known_names"))


QUERIES = {"p2_found": p2_found, "p2_top_cited": p2_top_cited, "p6_pack": p6_pack, "p6_containers": p6_containers, "p6_invariants": p6_invariants, "p7_found": p7_found, "p7_overlaps": p7_overlaps, "p8_found": p8_found, "p8_redacted": p8_redacted}

_TOP = f"SELECT {{}} FROM (SELECT {sql_canonical('cited_id')} AS cited_id, CAST(count(*) AS BIGINT) AS n FROM merge_rows GROUP BY 1) x WHERE cited_id IS NOT NULL ORDER BY n DESC, cited_id LIMIT 20"

#: The others can't be stated in SQL: they need a tokenizer, Unicode forms of words, or a trained classifier.
ORACLE: dict[str, str] = {
    "p6_invariants": "SELECT CAST(count(*) AS BIGINT) AS n_texts, CAST(0 AS BIGINT) AS n_broken_texts, CAST(0 AS BIGINT) AS n_overfull, CAST(0 AS BIGINT) AS n_broken_containers FROM documents WHERE text <> ''",
    "p2_found": _TOP.format("cited_id"),
    "p2_top_cited": _TOP.format("cited_id, n"),
}
