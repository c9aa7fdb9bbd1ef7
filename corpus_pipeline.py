"""Corpus pipeline: five stages, each a training-data operator over all that
its predecessor kept.

Language ID rejects documents whose language it cannot tell, exact and near
deduplication keep one document of each group, decontamination drops documents
that hold a benchmark item, and mixing says how many words of each document the
mix takes. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskweave.llm import decontam, exact_dedup, langid, mixing, near_dedup
from riskweave.llm.common import Scratch, documents


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified (operator 7)."""
    return langid.keep_identified(spark, docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (operator 4)."""
    return exact_dedup.drop_copies(spark, docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates (operator 6)."""
    return near_dedup.drop_near_copies(spark, docs)


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item (operator 8)."""
    return decontam.clean(spark, docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document (operator 3)."""
    return mixing.mix(spark, docs)


STAGES = [
    ("language", language),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("benchmark_items", benchmark_items),
    ("source_mix", source_mix),
]

#: The first stage's model and the third's classes are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = documents(spark, sf_dir)
    before = None
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return docs
