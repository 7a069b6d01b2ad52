"""The registered queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import Tables
from . import (chat_format, collocations, decontamination, hard_negatives, license_scan, mixing, near_dedup, quality_classifier, quality_rules, sharding,
               token_files, toxicity, url_filter)
from .fit import in_fold_zero
from .oracles import ORACLES  # noqa: F401

QUERIES = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        return fn
    return register


@query("op1_host_quality_rules")
def op1(t: Tables) -> DataFrame:
    return quality_rules.judged(t.documents)


@query("op2_url_language_ratio")
def op2(t: Tables) -> DataFrame:
    return url_filter.judged(t.pages).select("page_id", "host", "path", "rule", "verdict")


@query("op3_benchmark_decontamination")
def op3(t: Tables) -> DataFrame:
    return decontamination.contaminated(t.documents, t.benchmark)


def _scored(rows: DataFrame, limit: float) -> DataFrame:
    return rows.select("doc_id", in_fold_zero().alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"))


@query("op4_toxicity_ftrl")
def op4(t: Tables) -> DataFrame:
    return _scored(toxicity.score(t.documents, toxicity.train(t.documents, t.labels.where(~in_fold_zero()))), 0.5)


@query("op5_source_mixing")
def op5(t: Tables) -> DataFrame:
    return mixing.mixed(t.documents).drop("copies")


@query("op6_license_scan")
def op6(t: Tables) -> DataFrame:
    return license_scan.found(t.documents)


@query("op7_quality_embeddings")
def op7(t: Tables) -> DataFrame:
    return _scored(quality_classifier.score(t.documents, quality_classifier.train(t.documents, t.labels.where(~in_fold_zero()))), 0.3)


@query("op8_bottom_k_near_duplicates")
def op8(t: Tables) -> DataFrame:
    return near_dedup.near_duplicates(t.documents)


@query("op9_chat_format")
def op9(t: Tables) -> DataFrame:
    spark = t.spark
    # the fixed conversation of the contract
    tricky = spark.createDataFrame([(-7, i, role, r"\### Assistant: </turn> ok") for i, role in enumerate(("user", "assistant"))],
                                   "conv_id long, turn long, role string, text string")
    turns = t.conversations.select("conv_id", "turn", "role", "text").unionByName(tricky)
    return chat_format.digests(chat_format.formatted(turns))


@query("op10_feistel_shards")
def op10(t: Tables) -> DataFrame:
    return sharding.sharded(t.documents)


@query("op11_phrase_collocations")
def op11(t: Tables) -> DataFrame:
    return collocations.mined(t.documents)


@query("op12_cover_tree_negatives")
def op12(t: Tables) -> DataFrame:
    return hard_negatives.hard_negatives(t.embeddings)


@query("op13_token_planes")
def op13(t: Tables) -> DataFrame:
    return token_files.read_documents(token_files.write_tokens(t.documents))
