"""The corpus pipeline: quality rules, n-gram Jaccard join, substring dedup, benchmark decontamination, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows the stage before
kept; all but the last return the columns of `documents`.  The last returns the
training sequences' pieces with their token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stridelake.llm import decontaminate, ngram_join, packing, quality_rules, substring_dedup
from stridelake.llm.base import materialize, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return quality_rules.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the least id) of each component of similar documents."""
    return ngram_join.deduplicate(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words and more that a smaller id has."""
    return substring_dedup.deduplicate(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaked."""
    return decontaminate.filter_documents(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences, with ids."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("benchmark_decontamination", benchmark_leaks),
    ("packing", packed),
]

#: SQL can express neither the iterated estimates nor the packing; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
