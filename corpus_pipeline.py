"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a table, which is written as
Parquet and read again as the next stage's ``docs``: a lost executor repeats
tasks of one stage only. All but the last stage return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridsight.llm import packing, quality_classifier, quality_rules, scratch, simhash


def by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the adaptive quality rules.

    Null and empty texts fail the base rules and go; ties with a fence stay; repeated
    rows are judged alike; null languages and sources are groups of their own.
    """
    return quality_rules.keep_good(docs)


def by_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the rule ensemble scores at one half or more; it learns from all labelled documents, not from ``docs``.

    Null and empty texts are scored like any other; a score of one half stays; repeated
    rows are scored alike; without labels of both kinds the smoothed share decides for all.
    """
    model = quality_classifier.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_classifier.keep_good(docs, model)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id.

    Null, empty and blank texts are one group; a null id stays only where its group has
    no other; of repeated ids and rows one stays.
    """
    return simhash.keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths, each a sequence.

    A null or empty text is its closing id alone; repeated rows get pieces each.
    """
    return packing.pack(docs)


STAGES = [("quality_rules", by_rules), ("quality_classifier", by_classifier), ("simhash_dedup", without_copies), ("packing", packed)]

#: Fingerprints, boosted trees and tokenizers have no DuckDB form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage on what the one before kept; an empty table of documents gives no pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return docs
