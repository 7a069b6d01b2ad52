"""Fitting small classifiers on a bounded sample of labelled documents."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

#: labelled documents a model is fitted on at most: the bound of everything that meets in one task
SAMPLE = 10_000
FOLDS = 5


def in_fold_zero(doc_id: str = "doc_id") -> Column:
    """The held-out fold: crc32 of the id as text, modulo FOLDS, is 0. Null ids are not held out."""
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "utf-8")) % FOLDS == 0, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, label: str, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, text, y, turn) of at most about ``sample`` documents, chosen and ordered by a hash of the
    id. Labels other than 0 and 1 are left out; an id with both counts as 1. The choice is made among the
    labels, before any text is read, so the join broadcasts no more than ``sample`` small rows."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    chosen = (rows.where("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.max("y").alias("y"))
              .withColumn("turn", F.xxhash64(F.lit(label), "doc_id")).orderBy("turn", "doc_id").limit(sample))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id")


def fitted(sample: DataFrame, features: Callable, schema: str, fit: Callable) -> dict[str, np.ndarray]:
    """Features are extracted where the documents are; their short form meets in one task, which fits the
    model and returns (name, index, value) rows: the model, whose size its parameters bound."""
    held = sample.select("text", "y", "turn").mapInArrow(features, schema)
    rows = held.repartition(1).sortWithinPartitions(*held.columns).mapInArrow(fit, "name string, at int, value float")
    table = rows.toPandas()
    return {name: (part["at"].to_numpy(), part["value"].to_numpy(np.float32)) for name, part in table.groupby("name")}
