"""Quality classifier: supervised subword embeddings.

Every word and every run of 3 or 4 characters inside a word (marked where it touches a word's end) has a
learned vector at a hashed place. Their mean over the whole text goes through a softmax. Training is plain
stochastic gradient descent in numpy. As the output is linear in the mean, a trained vector serves scoring
as one number, its share in the difference of the two outputs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .fit import SAMPLE, fitted, labelled
from .text import mix, pieces, word_hashes

BUCKETS = 1 << 17
DIM = 16
GRAMS = (3, 4)
RATE = 1.0
EPOCHS, STEPS = 6, 30_000  # at least so many passes and steps


def _subwords(p) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vocabulary index of each word, borders, buckets): the buckets of each distinct word of a piece."""
    hashes = word_hashes(p)
    vocabulary, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    starts, stops = p.starts[first], p.stops[first]
    heads = np.flatnonzero((p.data & 0xC0) != 0x80)          # first byte of each character
    a, b = np.searchsorted(heads, starts), np.searchsorted(heads, stops)
    heads = np.append(heads, len(p.data))
    owner, held = [np.arange(len(first))], [mix(vocabulary)]
    for n in GRAMS:
        count = np.maximum(b - a - n + 1, 0)
        word = np.repeat(np.arange(len(first)), count)
        at = a[word] + np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count)
        touch = (at == a[word]).astype(np.uint64) + 2 * (at + n == b[word]).astype(np.uint64)
        owner.append(word)
        held.append(mix(word_hashes(p, heads[at], heads[at + n]) + np.uint64(16 * n) + touch))
    owner, held = np.concatenate(owner), np.concatenate(held)
    order = np.argsort(owner, kind="stable")
    borders = np.searchsorted(owner[order], np.arange(len(first) + 1))
    return which, borders, (held[order] & np.uint64(BUCKETS - 1)).astype(np.int64)


def _features(batches):
    for batch in batches:
        y, turn = batch.column("y"), batch.column("turn")
        for p in pieces(batch.column("text")):
            which, borders, buckets = _subwords(p)
            sizes = np.diff(borders)
            ids, counts, ends = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], [0]
            for a, b in zip(p.borders[:-1], p.borders[1:]):
                words, times = np.unique(which[a:b], return_counts=True)
                size = sizes[words]
                at = np.arange(size.sum()) + np.repeat(borders[words] - (np.cumsum(size) - size), size)
                own, back = np.unique(buckets[at], return_inverse=True)
                ids.append(own.astype(np.int32))
                counts.append(np.bincount(back, np.repeat(times, size), len(own)).astype(np.int32))
                ends.append(ends[-1] + len(own))
            ends = pa.array(np.array(ends, np.int32))
            yield pa.RecordBatch.from_arrays([
                turn.slice(p.first, len(p)), y.slice(p.first, len(p)),
                pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids))),
                pa.ListArray.from_arrays(ends, pa.array(np.concatenate(counts)))], names=["turn", "y", "ids", "counts"])


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def _sgd(batches):
    rows = []
    for batch in batches:
        y = batch.column("y").to_numpy(zero_copy_only=False)
        ends, ids = batch.column("ids").offsets.to_numpy(), batch.column("ids").values.to_numpy()
        counts = batch.column("counts").values.to_numpy()
        rows += [(ids[a:b], (counts[a:b] / max(1, counts[a:b].sum())).astype(np.float32), t)
                 for a, b, t in zip(ends[:-1], ends[1:], y)]
    draw = np.random.default_rng(7)
    vectors = draw.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    epochs = max(EPOCHS, -(-STEPS // max(1, len(rows))))
    step = 0
    for _ in range(epochs):
        for i in draw.permutation(len(rows)):
            ids, share, y = rows[i]
            rate = RATE * (1 - step / (epochs * len(rows)))
            step += 1
            held = vectors[ids]
            mean = share @ held
            wrong = _softmax(out @ mean + bias).astype(np.float32)
            wrong[y] -= 1
            vectors[ids] = held - (rate * len(ids) ** 0.5) * share[:, None] * (wrong @ out)
            out -= rate * np.outer(wrong, mean)
            bias -= 0.1 * rate * wrong
    each = vectors @ (out[1] - out[0])
    yield pa.RecordBatch.from_arrays([
        pa.array(["bucket"] * BUCKETS + ["bias"]), pa.array(np.append(np.arange(BUCKETS), 0).astype(np.int32)),
        pa.array(np.append(each, bias[1] - bias[0]).astype(np.float32))], names=["name", "at", "value"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """A number per bucket from (doc_id, quality) rows of ``labels``, fitted on ``sample`` documents at most."""
    return fitted(labelled(docs, labels, "quality", sample), _features, "turn long, y int, ids array<int>, counts array<int>", _sgd)


def score(docs: DataFrame, model) -> DataFrame:
    """(doc_id, score) of every row: the softmax output for label 1.

    Null and empty texts have a mean of zero and get the score of the bias alone; with no usable label
    that is 0.5 for all. Repeated rows are scored each, other columns ignored; an empty table gives no rows."""
    at, value = model.get("bucket", (np.arange(BUCKETS), np.zeros(BUCKETS, np.float32)))
    numbers = np.zeros(BUCKETS, np.float32)
    numbers[at] = value
    bias = float(model["bias"][1][0]) if "bias" in model else 0.0

    def scored(batches):
        for batch in batches:
            out = [np.zeros(0)]
            for p in pieces(batch.column("text")):
                which, borders, buckets = _subwords(p)
                sums = np.append(0, np.cumsum(numbers[buckets], dtype=np.float64))[borders]
                document = p.document()
                total = np.bincount(document, np.diff(sums)[which], len(p))
                size = np.bincount(document, np.diff(borders)[which], len(p))
                out.append(1 / (1 + np.exp(-np.clip(total / np.maximum(size, 1) + bias, -35, 35))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(out))], names=["doc_id", "score"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        scored, "doc_id long, score double")
