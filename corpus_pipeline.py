"""A training corpus from raw documents: each stage applies one operator to all that the stage before it kept.

``run(spark, sf_dir)`` writes every stage's result to the shared folder and reads it back as the next one's
documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideline.llm import decontamination, mixing, near_dedup, sharding, toxicity
from tideline.plans.staging import staged
from tideline.session import Tables

#: near-duplicates by shingles of five words, from a similarity of 80 percent
SHINGLE, SIMILARITY = 5, 80
SHARDS = 24


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go. It is fitted on the labelled documents of this input."""
    return toxicity.without_toxic(docs, toxicity.train(docs, Tables(spark, sf_dir).labels))


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return near_dedup.one_of_each_group(docs, SHINGLE, SIMILARITY)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, exact or edited, go."""
    return decontamination.without_items(docs, Tables(spark, sf_dir).benchmark)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out, so that sources have their target weights."""
    return mixing.repeated(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row of the mix."""
    return sharding.sharded(docs, SHARDS)


STAGES = [("toxicity", toxic_out), ("near-duplicates", near_duplicates_out), ("decontamination", benchmark_out),
          ("mixing", mixed), ("sharding", sharded)]
#: a fitted classifier decides the first stage, which SQL cannot express; the tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
