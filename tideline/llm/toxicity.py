"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct words, word pairs and pairs around one word (lower-cased runs of letters and
digits) of the whole text, hashed into 2**BITS places. FTRL keeps a learning rate per coordinate, and its L1 term leaves few
weights other than 0; those travel to the executors as an index and a value each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .fit import SAMPLE, fitted, labelled
from .text import BASE, mix, not_letters, pieces, word_hashes

BITS = 20
ALPHA, BETA, L1, L2 = 1.0, 1.0, 10.0, 0.1
EPOCHS = 5


def _ids(p) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) of every occurrence."""
    words, document = word_hashes(p), p.document()
    found = [(document, mix(words + np.uint64(1)))]
    for step in (1, 2):
        near = document[:-step] == document[step:]
        pair = mix(words[:-step] * np.uint64(BASE) + words[step:] + np.uint64(step + 1))
        found.append((document[:-step][near], pair[near]))
    return (np.concatenate([d for d, _ in found]),
            (np.concatenate([f for _, f in found]) >> np.uint64(64 - BITS)).astype(np.int64))


def _features(batches):
    for batch in batches:
        y, turn = batch.column("y"), batch.column("turn")
        for p in pieces(batch.column("text"), lower=True, gaps=not_letters()):
            document, ids = _ids(p)
            both = np.unique((document.astype(np.int64) << BITS) | ids)
            ends = np.searchsorted(both, np.arange(len(p) + 1) << BITS).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array((both & ((1 << BITS) - 1)).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([turn.slice(p.first, len(p)), y.slice(p.first, len(p)), lists],
                                             names=["turn", "y", "ids"])


def _rate(n: np.ndarray) -> np.ndarray:
    return (BETA + np.sqrt(n)) / ALPHA


def _ftrl(batches):
    rows = []
    for batch in batches:
        ids, y = batch.column("ids"), batch.column("y").to_numpy(zero_copy_only=False)
        ends, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
        rows += [(flat[a:b], t) for a, b, t in zip(ends[:-1], ends[1:], y)]
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    bias = 1 << BITS

    def weights(at):
        w = -(z[at] - np.sign(z[at]) * L1) / (_rate(n[at]) + L2)
        w[np.abs(z[at]) <= L1] = 0
        return w

    for _ in range(EPOCHS):
        for ids, y in rows:
            at = np.append(ids, bias)
            w = weights(at)
            w[-1] = -z[bias] / (_rate(n[bias]) + L2)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    w = weights(np.arange(bias))
    at = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays([
        pa.array(["weight"] * len(at) + ["bias"]), pa.array(np.append(at, 0).astype(np.int32)),
        pa.array(np.append(w[at], -z[bias] / (_rate(n[bias]) + L2)).astype(np.float32))], names=["name", "at", "value"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """Sparse weights from (doc_id, toxic) rows of ``labels``. Without usable labels all weights are 0."""
    return fitted(labelled(docs, labels, "toxic", sample), _features, "turn long, y int, ids array<int>", _ftrl)


def _scorer(model):
    at, value = model.get("weight", (np.zeros(0, int), np.zeros(0, np.float32)))
    bias = float(model["bias"][1][0]) if "bias" in model else 0.0

    def score(column) -> np.ndarray:
        dense = np.zeros(1 << BITS, np.float32)
        dense[at] = value
        out = [np.zeros(0)]
        for p in pieces(column, lower=True, gaps=not_letters()):
            document, ids = _ids(p)
            hit = np.flatnonzero(dense[ids])
            both = np.unique((document[hit].astype(np.int64) << BITS) | ids[hit])
            total = np.bincount(both >> BITS, dense[both & ((1 << BITS) - 1)], len(p)) + bias
            out.append(1 / (1 + np.exp(-np.clip(total, -35, 35))))
        return np.concatenate(out)
    return score


def score(docs: DataFrame, model) -> DataFrame:
    """(doc_id, score) of every row: the probability that the text is toxic.

    Null and empty texts have no features and get the score of the bias alone. Repeated rows are scored
    each; other columns are ignored; an empty table gives no rows."""
    run = _scorer(model)

    def scored(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(run(batch.column("text")))], names=["doc_id", "score"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        scored, "doc_id long, score double")


def without_toxic(docs: DataFrame, model, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a score below ``limit``, unchanged."""
    run = _scorer(model)

    def kept(batches):
        for batch in batches:
            yield batch.filter(pa.array(run(batch.column("text")) < limit))
    return docs.mapInArrow(kept, docs.schema)
