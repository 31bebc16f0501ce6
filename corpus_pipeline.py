"""The corpus pipeline: quality, near-duplicates, benchmark passages, source mix, shards.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next stage's docs.  All but the last return the columns of documents.

* quality: documents that the rule ensemble predicts to be of label 0 go.
* near_duplicates: of documents that links of Jaccard 0.8 or more over five-word shingles join, the one with the smallest
  doc_id stays.  SimHash and MinHash keys propose the links, the shingle sets confirm them.
* decontamination: documents that hold a benchmark item, or a long part of one, go.
* mixing: each source is taken to its target weight; a document taken twice is there twice.
* sharding: 24 shards of near equal bytes, each in the order of the key, with shard and slot.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leadmill.llm import decontam, mixing, neardup, quality, sharding
from leadmill.llm.common import removed, scratch, scratch_removed, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.first_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixture(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.sharded(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing_sources", mixing_sources),
    ("sharding", shards),
]

#: Near-duplicates, the fitted classifier and the knapsack have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage.  What a stage wrote for itself, and what it read from the one before, goes once its rows are written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        with scratch_removed(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            removed(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
