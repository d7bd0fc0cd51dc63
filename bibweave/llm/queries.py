"""Queries of the problems of this subpackage, each over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibweave.llm import corpus_encoding, entity_match, format_duplicates, history_dedup, leakage, subjects, survivorship, value_mapping
from bibweave.llm.works import featurise
from bibweave.session import cut_lineage, read_table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = format_duplicates.format_duplicates(read_table(spark, sf_dir, "papers"), "rec_id", "title")
    return found.select(F.col("first_id").alias("first_rec_id"), F.col("id").alias("rec_id"))


def p1_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = format_duplicates.collapsed(read_table(spark, sf_dir, "papers"), "rec_id", "title")
    return copies.select(F.col("first_id").alias("first_rec_id"), "copies")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    won = survivorship.winners(read_table(spark, sf_dir, "paper_groups"), read_table(spark, sf_dir, "papers"))
    return won.select("group_id", "field_name", "rec_id")


def p2_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivorship.survivors(read_table(spark, sf_dir, "paper_groups"), read_table(spark, sf_dir, "papers"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = value_mapping.map_values(read_table(spark, sf_dir, "papers"), read_table(spark, sf_dir, "venue_list"), "rec_id", "venue", "venue_id", "venue_name", "acronym")
    return mapped.select(F.col("id").alias("rec_id"), F.col("ref_id").alias("venue_id"))


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity_match.match_sources(*(read_table(spark, sf_dir, t) for t in ("papers", "registry_records", "paper_groups")))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    papers, registry = (read_table(spark, sf_dir, t) for t in ("papers", "registry_records"))
    return entity_match.match_sources(papers, registry).select("rec_id", "bib_id")


def p4_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matched(spark, sf_dir).select("rec_id", "bib_id", "rule", "confidence")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    forest = history_dedup.HashForest(spark)
    ledger, candidates = (read_table(spark, sf_dir, t) for t in ("seen_ledger", "candidates"))
    forest.add(featurise(ledger, "seen_id", "title", "authors", "pub_date", F.col("doi"), F.col("arxiv_id")))
    made = featurise(candidates, "cand_id", "title", "authors", "published", F.col("doi"), F.col("arxiv_id"), F.coalesce("batch_no", F.lit(1 << 30)).alias("batch_no"))
    arrived = cut_lineage(made)
    sizes = sorted(arrived.groupBy("batch_no").count().collect())  # a row a batch
    for several in history_dedup.together(sizes):
        forest.add(arrived.where(F.col("batch_no").isin(several)).drop("batch_no"))
    found = forest.first_ids().where("first_id < id").select("first_id", F.col("id").alias("cand_id"))
    return found.join(arrived.select(F.col("id").alias("cand_id")), "cand_id", "left_semi").select("first_id", "cand_id")


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = corpus_encoding.encode(read_table(spark, sf_dir, "documents"), "doc_id", "text")
    return encoded.select(F.col("id").alias("doc_id"), "ids")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked_passages(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "eval_items"), "doc_id", "text", "item_id", "text")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = subjects.subjects_of(read_table(spark, sf_dir, "documents"), "doc_id", "text", read_table(spark, sf_dir, "subject_examples"), "subject", "text")
    return found.select("doc_id", "subject")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_copies, p2_found, p2_survivors, p3_found, p4_found, p4_confidence, p5_found, p6_ids, p7_found, p8_found)}


def oracle_sql() -> dict[str, str]:
    """None: Unicode folding, tokenizers, alignments and models have no counterpart in SQL; tests/llm holds brute-force versions."""
    return {}
