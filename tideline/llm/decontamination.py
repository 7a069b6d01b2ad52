"""Benchmark decontamination: rare word pairs of the test items seed Smith-Waterman alignments.

Two passes over the texts, no shuffle of them. The first counts in how many documents each seed of the items
occurs. The second finds the seeds that are kept, aligns the words around them with the whole item, and scores the
alignment as a share of the item's perfect score.

No text that reaches the limit is missed. A seed is a pair of words at a distance of 1 or 2, in the item and in the
text. An alignment with m matched words and e edits scores 2m - e; if that is at least ``limit`` of the perfect 2n
of an item of n words, e <= 2m - 2 * limit * n, and at least limit * n - 1 pairs of neighbouring matched words have
one edit or none between them: they are seeds, each from another place of the item. So the places with the
most frequent seeds can be left out, one fewer than that, and one of the others still meets the text.
Words that cannot reach the limit even if all words of the item among them matched are not aligned.

Items are taken in blocks of BLOCK, so what the executors hold does not grow with the benchmark; a
larger benchmark takes more passes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .text import BASE, Piece, mix, not_letters, pieces, word_hashes

#: words that an item needs
LEAST = 3
STEPS = (1, 2)
BLOCK = 20_000
MATCH, MISMATCH, GAP = 2, -1, -1
LIMIT = 0.5
BATCH_CELLS = 1 << 21
BATCH_WORDS = 1 << 20


def _pairs(words: np.ndarray, step: int) -> np.ndarray:
    """The hash of each word and the one ``step`` words on; the same for every step."""
    return mix(words[:-step] * np.uint64(BASE) + words[step:])


def _named(items: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(words + mix(items.astype(np.uint64) + np.uint64(1)))


class Items:
    """The words of a block of test items, and its seeds as (item, place) lists."""

    def __init__(self, ids: list[int], texts: list[str | None], limit: float):
        self.ids = np.array(ids, np.int64)
        self.limit = limit
        self.words: list[np.ndarray] = []
        for p in pieces(pa.array(texts, pa.string()), lower=True, gaps=not_letters()):
            hashes = word_hashes(p)
            self.words += [hashes[a:b] for a, b in zip(p.borders[:-1], p.borders[1:])]
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        #: the scores to reach
        self.least = limit * MATCH * self.lengths
        found = [(k, np.arange(len(w) - step), _pairs(w, step)) for k, w in enumerate(self.words) if len(w) >= LEAST for step in STEPS]
        self.item = np.repeat(np.array([k for k, _, _ in found], np.int64), [len(g) for _, _, g in found])
        self.place = np.concatenate([*[at for _, at, _ in found], np.zeros(0, np.int64)])
        self.gram = np.concatenate([*[g for _, _, g in found], np.zeros(0, np.uint64)])
        of = np.repeat(np.arange(len(self.words)), self.lengths)
        self.named = np.unique(_named(of, np.concatenate([*self.words, np.zeros(0, np.uint64)])))

    def keep_rarest(self, grams: np.ndarray, n: np.ndarray) -> None:
        """Leaves out the places of each item with the most frequent seeds, as many as is safe."""
        order = np.argsort(grams)
        grams, n = np.append(grams[order], np.uint64(0)), np.append(n[order], 0)
        where = np.searchsorted(grams[:-1], self.gram)
        often = np.where(grams[where] == self.gram, n[where], 0)
        first = np.append(0, np.cumsum(self.lengths))
        at = first[self.item] + self.place
        total = np.bincount(at, often, first[-1])
        item, place = np.repeat(np.arange(len(self.words)), self.lengths), np.arange(first[-1])
        # the last place begins no pair
        inner = place < first[item + 1] - 1
        item, place = item[inner], place[inner]
        order = np.lexsort((place, -total[place], item))
        rank = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        left_out = np.zeros(first[-1], bool)
        left_out[place[order[rank < (np.ceil(self.limit * self.lengths - 1e-9) - 2)[item[order]]]]] = True
        kept = np.flatnonzero(~left_out[at])
        kept = kept[np.argsort(self.gram[kept], kind="stable")]
        self.gram, self.item, self.place = self.gram[kept], self.item[kept], self.place[kept]

    def can_reach(self, item: np.ndarray, lo: np.ndarray, hi: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Whether some of the words lo to hi could score enough if every word of the item matched."""
        out = np.zeros(len(item), bool)
        ends = np.cumsum(hi - lo)
        a = 0
        while a < len(item):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BATCH_WORDS, "right")))
            size = (hi - lo)[a:b]
            begin = np.cumsum(size) - size
            region = np.repeat(np.arange(b - a), size)
            at = np.arange(size.sum()) + np.repeat(lo[a:b] - begin, size)
            named = _named(item[a:b][region], hashes[at])
            held = self.named[np.minimum(np.searchsorted(self.named, named), len(self.named) - 1)] == named
            worth = np.where(held, MATCH, MISMATCH).astype(np.int64)
            after = np.cumsum(worth)
            # of each stretch of words the score is a difference of two sums; the lowest sum so far, by region
            far = (MATCH - MISMATCH) * (len(at) + 1) * region
            lowest = np.minimum.accumulate(after - worth - far) + far
            out[a:b] = np.maximum.reduceat(after - lowest, begin) >= self.least[item[a:b]] - 1e-9
            a = b
        return out


class Lookup:
    """Finds the words of a text at which one of some seeds begins."""

    def __init__(self, grams: np.ndarray):
        self.grams = np.unique(grams)
        bits = min(24, max(16, (16 * len(self.grams)).bit_length()))
        self.shift = np.uint64(64 - bits)
        self.maybe = np.zeros(1 << bits, bool)
        self.maybe[(self.grams >> self.shift).astype(np.int64)] = True

    def __call__(self, p: Piece, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, seed) of each occurrence."""
        document = p.document()
        found = [(np.zeros(0, np.int64),) * 2]
        for step in STEPS:
            g = _pairs(hashes, step)
            at = np.flatnonzero(self.maybe[(g >> self.shift).astype(np.int64)] & (document[:-step] == document[step:]))
            g = g[at]
            where = np.minimum(np.searchsorted(self.grams, g), max(0, len(self.grams) - 1))
            hit = self.grams[where] == g if len(self.grams) else np.zeros(0, bool)
            found.append((at[hit], where[hit]))
        return tuple(np.concatenate(x) for x in zip(*found))


def _frequencies(items: Items):
    def run(batches):
        find = Lookup(items.gram)
        for batch in batches:
            counts = np.zeros(len(find.grams), np.int64)
            for p in pieces(batch.column("text"), lower=True, gaps=not_letters()):
                at, where = find(p, word_hashes(p))
                document = p.document()[at].astype(np.int64)
                own = np.unique(document * len(find.grams) + where) if len(at) else np.zeros(0, np.int64)
                counts += np.bincount(own % max(1, len(find.grams)), minlength=len(counts))
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(find.grams[seen].view(np.int64)), pa.array(counts[seen])], names=["gram", "n"])
    return run


def align(items: list[np.ndarray], texts: list[np.ndarray]) -> np.ndarray:
    """Smith-Waterman scores (linear gaps) of items against texts, word by word, all pairs of a batch at once."""
    rows, cols = max(map(len, items)), max(map(len, texts))
    a, b = np.zeros((len(items), rows), np.uint64), np.zeros((len(items), cols), np.uint64)
    in_a, in_b = np.zeros(a.shape, bool), np.zeros(b.shape, bool)
    for i, (x, y) in enumerate(zip(items, texts)):
        a[i, :len(x)], in_a[i, :len(x)] = x, True
        b[i, :len(y)], in_b[i, :len(y)] = y, True
    slope = -GAP * np.arange(cols + 1, dtype=np.int32)
    row = np.zeros((len(items), cols + 1), np.int32)
    best = np.zeros(len(items), np.int32)
    for j in range(rows):
        same = (b == a[:, j:j + 1]) & in_b & in_a[:, j:j + 1]
        new = np.maximum(row + GAP, 0)
        np.maximum(new[:, 1:], row[:, :-1] + np.where(same, MATCH, MISMATCH).astype(np.int32), out=new[:, 1:])
        row = np.maximum.accumulate(new + slope, axis=1) - slope  # gaps along the text
        best = np.maximum(best, row.max(axis=1))
    return best


def _regions(hit_document, hit_item, start, items: Items):
    """Merged stretches (document, item, from, to) of words around the places where seeds put an item."""
    lengths = items.lengths
    # as many words can be put in or left out before the limit is missed
    slack = np.floor(MATCH * lengths - items.least + 1e-9).astype(np.int64)[hit_item]
    lo, hi = start - slack, start + lengths[hit_item] + slack
    order = np.lexsort((lo, hit_item, hit_document))
    d, i, lo, hi = hit_document[order], hit_item[order], lo[order], hi[order]
    # seeds of one item less than its length apart belong together; longer chains are cut there
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (i[1:] != i[:-1]) | (lo[1:] - lo[:-1] > slack[order][1:])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(d)) - 1
    return d[first], i[first], lo[first], hi[last], np.diff(np.append(first, len(d)))


def _hits(column: pa.Array, items: Items, find: Lookup, begins: np.ndarray):
    """(row, item, score, seeds) arrays of the best alignment of each document and item that share a seed."""
    lengths = items.lengths
    out = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0), np.zeros(0, np.int64))]
    for p in pieces(column, lower=True, gaps=not_letters()):
        hashes = word_hashes(p)
        at, where = find(p, hashes)
        if not len(at):
            continue
        times = begins[where + 1] - begins[where]
        entry = np.arange(times.sum()) + np.repeat(begins[where] - (np.cumsum(times) - times), times)
        at = np.repeat(at, times)
        document = p.document()[at]
        d, i, lo, hi, seeds = _regions(document, items.item[entry], at - items.place[entry], items)
        lo, hi = np.maximum(lo, p.borders[d]), np.minimum(hi, p.borders[d + 1])
        able = items.can_reach(i, lo, hi, hashes)
        d, i, lo, hi, seeds = d[able], i[able], lo[able], hi[able], seeds[able]
        score = np.zeros(len(d))
        order = np.argsort(lengths[i] * (hi - lo), kind="stable")
        k = 0
        while k < len(order):
            size = max(1, BATCH_CELLS // int(max(1, (hi - lo)[order[k:k + 256]].max()) * 8))
            part = order[k:k + min(256, size)]
            score[part] = align([items.words[x] for x in i[part]], [hashes[x:y] for x, y in zip(lo[part], hi[part])]) / (MATCH * lengths[i[part]])
            k += len(part)
        out.append((d + p.first, i, score, seeds))
    row, item, score, seeds = (np.concatenate(x) for x in zip(*out))
    order = np.lexsort((-score, item, row))
    row, item, score, seeds = row[order], item[order], score[order], seeds[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1])
    return row[new], item[new], score[new], seeds[new]


def _blocks(docs: DataFrame, benchmark: DataFrame, limit: float):
    """Items with their seeds chosen, a block at a time."""
    texts = docs.select(F.col("text").cast("string").alias("text"))
    held = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    blocks = max(1, -(-held.count() // BLOCK))
    for k in range(blocks):
        mine = held.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        items = Items([r["item_id"] if r["item_id"] is not None else -1 for r in mine], [r["text"] for r in mine], limit)
        counted = texts.mapInArrow(_frequencies(items), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        table = counted.toPandas()  # at most the block's own seeds
        items.keep_rarest(table["gram"].to_numpy(np.int64).view(np.uint64), table["n"].to_numpy(np.int64))
        yield items


def _finder(items: Items):
    begins = np.append(np.flatnonzero(np.append(True, items.gram[1:] != items.gram[:-1])) if len(items.gram) else [], len(items.gram)).astype(np.int64)
    find = Lookup(items.gram)
    return lambda column: _hits(column, items, find, begins)


def contaminated(docs: DataFrame, benchmark: DataFrame, limit: float = LIMIT) -> DataFrame:
    """(doc_id, item_id, score, seeds): documents that hold a test item, exact or edited, with an alignment
    score of at least ``limit`` of the item's own. Clean documents give no row.

    Null and empty texts hold nothing; items of fewer than LEAST words have no seed and match nothing. Items
    with a null id count as -1. Repeated rows are judged each. Other columns are ignored."""
    found = None
    for items in _blocks(docs, benchmark, limit):
        def run(batches, items=items):
            hits = _finder(items)
            for batch in batches:
                row, item, score, seeds = hits(batch.column("text"))
                keep = score >= limit
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(row[keep])), pa.array(items.ids[item[keep]]),
                     pa.array(np.round(score[keep], 6)), pa.array(seeds[keep])], names=["doc_id", "item_id", "score", "seeds"])
        part = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
            run, "doc_id long, item_id long, score double, seeds long")
        found = part if found is None else found.unionByName(part)
    return found


def without_items(docs: DataFrame, benchmark: DataFrame, limit: float = LIMIT) -> DataFrame:
    """The rows of ``docs`` that hold no test item, unchanged."""
    for items in _blocks(docs, benchmark, limit):
        def run(batches, items=items):
            hits = _finder(items)
            for batch in batches:
                row, _, score, _ = hits(batch.column("text"))
                clean = np.ones(batch.num_rows, bool)
                clean[row[score >= limit]] = False
                yield batch.filter(pa.array(clean))
        docs = docs.mapInArrow(run, docs.schema)
    return docs
