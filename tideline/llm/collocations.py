"""Phrase mining with counting quotient filters.

1. Words are counted per language. Those with ``least`` occurrences get numbers; no phrase holds any other word. Texts
   are written once as runs of word numbers, broken where a piece ends or a word has no number. Tasks find numbers by
   a 64-bit hash of language and word in a sorted array, a bounded block of the vocabulary at a time; words that share a
   hash with another word are told apart by their bytes.
2. Phrases of two to five words, one length after the other. A window of word numbers is packed into one to three
   integers and permuted by an invertible function of exactly that many bits. The first bits of the result name a bucket, the
   next ones a quotient, and all that is left is kept as the remainder: a filter lists how many remainders each
   quotient has, the remainders and their counts, so nothing is lost and the phrase can be computed back.
3. A task merges its windows into a sorted filter of bounded size and sends it bucket by bucket. The filters of
   a bucket from all tasks are merged by their sorted entries; counts of at least ``least`` leave it as phrases. The number of
   buckets grows with the number of windows, so a bucket stays small.
4. A phrase is only as frequent as its parts: from length three on a window is counted if both windows within it may
   be frequent, asked of a bit table of bounded size. A full table counts more windows than needed, never fewer.

The phrases left are at most a hundredth of the words; cuts, scores and rests are ordinary joins on them.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..plans.staging import staged
from .rows import numbered
from .text import mix, pieces, word_hashes

LEAST, LONGEST, FIRST = 100, 5, 2000
#: vocabulary hashes that a task holds at once (8 bytes each)
VOCABULARY = 4_000_000
#: entries of a task's filter before it is sent, windows gathered before they are merged into it
HELD, GATHERED = 1 << 19, 1 << 20
#: windows per bucket, about; bits of the table of frequent shorter phrases, at most
BUCKET, TABLE_BITS = 1 << 20, 1 << 28
#: numbers written in one row, about: readers decode some thousands of rows at once
ROW = 1 << 10
#: numbers whose windows a task makes at once
STEP = 1 << 17
#: Rows of many KB: a page is closed by its bytes from the first row on, not after 100 rows at least. Readers and writers keep
#: buffers outside the heap as large as the largest page.
PAGES = {"parquet.page.size.row.check.min": "1"}
BREAKS = b".,;:!?\n\x0b\x0c\r"
ODD = 0x9E3779B97F4A7C15


# ---- words ----------------------------------------------------------------------------------------------------

def _gaps() -> tuple[np.ndarray, np.ndarray]:
    breaks = np.zeros(256, bool)
    breaks[list(BREAKS)] = True
    gaps = breaks.copy()
    gaps[[32, 9]] = True
    return gaps, breaks


def _tokens(batch: pa.RecordBatch, hash_bits: int):
    """(piece of text, hash of each word with its language, document and number of the run each word stands in)."""
    gaps, breaks = _gaps()
    langs = batch.column("lang").to_pylist()
    seed = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in set(langs)}
    seeds = np.array([seed[x] for x in langs], np.uint64)
    for p in pieces(batch.column("text"), lower=True, gaps=gaps):
        document = p.document()
        hashes = mix(word_hashes(p) ^ seeds[p.first + document]) >> np.uint64(64 - hash_bits)
        yield p, hashes.view(np.int64), document, np.searchsorted(np.flatnonzero(breaks[p.data]), p.starts) + document


def _bytes_of(p, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some words one after the other, and where each ends."""
    begin, size = p.starts[which], p.stops[which] - p.starts[which]
    ends = np.cumsum(size)
    return p.data[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin - (ends - size), size)], ends


def _strings(p, which: np.ndarray) -> pa.Array:
    data, ends = _bytes_of(p, which)
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(which), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())).cast(pa.string())


def _distinct(p, hashes: np.ndarray, langs: list[str], document: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place and the number of occurrences of each different word. Equal hashes are taken for equal words only after
    their bytes have been compared."""
    _, first, which, counts = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    size = p.stops - p.starts
    if (size == size[first][which]).all():
        mine, _ = _bytes_of(p, np.arange(len(hashes)))
        theirs, _ = _bytes_of(p, first[which])
        if (mine == theirs).all() and (len(set(langs)) < 2 or all(langs[a] == langs[b] for a, b in set(zip(document.tolist(), document[first][which].tolist())))):
            return first, counts
    seen: dict[tuple, list[int]] = {}
    for i, word in enumerate(_strings(p, np.arange(len(hashes))).to_pylist()):
        seen.setdefault((langs[document[i]], word), [i, 0])[1] += 1
    return tuple(np.array(x, np.int64) for x in zip(*seen.values()))


def _words(hash_bits: int):
    def run(batches):
        for batch in batches:
            langs = batch.column("lang")
            for p, hashes, document, _ in _tokens(batch, hash_bits):
                if not len(hashes):
                    continue
                own = langs.slice(p.first, len(p)).to_pylist()
                first, counts = _distinct(p, hashes, own, document)
                yield pa.RecordBatch.from_arrays(
                    [langs.take(pa.array(p.first + document[first])), pa.array(hashes[first]), _strings(p, first), pa.array(counts)],
                    names=["lang", "h", "word", "c"])
    return run


# ---- texts as runs of numbers ---------------------------------------------------------------------------------

def _rows_of(codes: np.ndarray, hashes: np.ndarray | None):
    """Rows of about ROW numbers, cut at breaks (0)."""
    if len(codes):
        dull = np.r_[True, codes[:-1] == 0] & (codes == 0)  # a break after a break
        codes, hashes = codes[~dull], None if hashes is None else hashes[~dull]
    breaks = np.flatnonzero(codes == 0)
    at, parts = 0, []
    while at < len(codes):
        i = int(np.searchsorted(breaks, at + ROW))
        stop = int(breaks[i]) + 1 if i < len(breaks) else len(codes)
        parts.append((at, stop))
        at = stop
    offsets = pa.array(np.array([0] + [b for _, b in parts], np.int32))
    columns = [pa.ListArray.from_arrays(offsets, pa.array(codes))]
    if hashes is not None:
        columns.append(pa.ListArray.from_arrays(offsets, pa.array(hashes)))
    return pa.RecordBatch.from_arrays(columns, names=["codes", "hashes"][:len(columns)])


def _looked_up(codes: np.ndarray, hashes: np.ndarray, held: np.ndarray, before: int) -> np.ndarray:
    """Numbers (from 1) of the words still without one (-1), from a block of sorted hashes."""
    open_ = np.flatnonzero(codes == -1)
    at = np.searchsorted(held, hashes[open_])
    hit = (at < len(held)) & (held[np.minimum(at, len(held) - 1)] == hashes[open_])
    codes[open_[hit]] = at[hit] + before + 1
    return codes


def _coded(docs: DataFrame, vocabulary: DataFrame, n_words: int, shared: dict, hash_bits: int, block: int) -> DataFrame:
    """Runs of word numbers from 1, with 0 for a break. ``shared`` has the numbers of words whose hash is not their own alone."""
    spark = docs.sparkSession
    single = n_words <= block
    table = None
    for before in range(0, n_words, block):
        last = before + block >= n_words
        held = vocabulary.where((F.col("id") >= before) & (F.col("id") < before + block)).orderBy("id").select("h").toArrow()["h"].to_numpy()
        sent = spark.sparkContext.broadcast((held, shared))

        def from_text(batches, before=before, sent=sent):
            held, shared = sent.value
            weak = np.array(sorted({h for h, _, _ in shared}), np.int64)
            for batch in batches:
                langs = batch.column("lang").to_pylist()
                for p, hashes, document, run in _tokens(batch, hash_bits):
                    codes = np.full(len(hashes), -1, np.int64)
                    for i in np.flatnonzero(np.isin(hashes, weak)).tolist() if len(weak) else ():
                        codes[i] = shared.get((int(hashes[i]), langs[p.first + document[i]], p.data[p.starts[i]:p.stops[i]].tobytes().decode()), 0)
                    codes = _looked_up(codes, hashes, held, before)
                    if single:
                        codes[codes == -1] = 0
                    ends = np.flatnonzero(run[1:] != run[:-1]) + 1
                    yield _rows_of(np.insert(np.append(codes, 0), ends, 0), None if single else np.insert(np.append(hashes, 0), ends, 0))

        def again(batches, before=before, last=last, sent=sent):
            held, _ = sent.value
            for batch in batches:
                codes, hashes = (np.array(batch.column(c).flatten()) for c in ("codes", "hashes"))
                codes = _looked_up(codes, hashes, held, before)
                if last:
                    codes[codes == -1] = 0
                yield _rows_of(codes, None if last else hashes)

        schema = "codes array<long>" if last else "codes array<long>, hashes array<long>"
        table = staged(docs.mapInArrow(from_text, schema) if table is None else table.mapInArrow(again, schema), "runs", PAGES)
    return table


# ---- the filter -----------------------------------------------------------------------------------------------

class Layout:
    """How a window of ``length`` words of ``bits`` bits is packed into integers, and their permutation."""

    def __init__(self, length: int, bits: int):
        per = 64 // bits
        self.length, self.bits = length, bits
        self.parts = [range(i, min(i + per, length)) for i in range(0, length, per)]
        self.widths = [len(p) * bits for p in self.parts]

    def pack(self, columns: list[np.ndarray]) -> list[np.ndarray]:
        out = []
        for part in self.parts:
            lane = np.zeros(len(columns[0]), np.uint64)
            for i in part:
                lane = (lane << np.uint64(self.bits)) | columns[i].astype(np.uint64)
            out.append(lane)
        return out

    def unpack(self, lanes: list[np.ndarray]) -> list[np.ndarray]:
        out = []
        for part, lane in zip(self.parts, lanes):
            for k, _ in enumerate(part):
                out.append((lane >> np.uint64(self.bits * (len(part) - 1 - k))) & np.uint64((1 << self.bits) - 1))
        return out

    def _spread(self, lanes, back: bool):
        out = []
        for lane, width in zip(lanes, self.widths):
            mask, half, odd = np.uint64((1 << width) - 1), np.uint64((width + 1) // 2), pow(ODD, -1, 1 << 64) if back else ODD
            for _ in range(2):
                if back:
                    lane = ((lane ^ (lane >> half)) * np.uint64(odd)) & mask
                else:
                    lane = (lane * np.uint64(odd)) & mask
                    lane = lane ^ (lane >> half)
            out.append(lane)
        return out

    def _cross(self, lanes, order):
        lanes = list(lanes)
        for i in order:
            others = reduce(lambda a, b: mix(a + np.uint64(ODD)) ^ b, [x for j, x in enumerate(lanes) if j != i])
            lanes[i] = lanes[i] ^ (mix(others + np.uint64(i)) & np.uint64((1 << self.widths[i]) - 1))
        return lanes

    def permute(self, lanes: list[np.ndarray]) -> list[np.ndarray]:
        lanes = self._spread(lanes, False)
        return self._spread(self._cross(lanes, range(len(lanes))), False) if len(lanes) > 1 else lanes

    def invert(self, lanes: list[np.ndarray]) -> list[np.ndarray]:
        if len(lanes) > 1:
            lanes = self._cross(self._spread(lanes, True), range(len(lanes) - 1, -1, -1))
        return self._spread(lanes, True)


def summed(lanes: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Entries in order, equal ones added up. The list of lanes is taken over, so that each goes as soon as it is in order."""
    if not len(counts):
        return lanes, counts
    order = np.argsort(lanes[0], kind="stable") if len(lanes) == 1 else np.lexsort(lanes[::-1])
    for i in range(len(lanes)):
        lanes[i] = lanes[i][order]
    counts = counts[order]
    del order
    begins = np.flatnonzero(np.r_[True, np.logical_or.reduce([x[1:] != x[:-1] for x in lanes])])
    for i in range(len(lanes)):
        lanes[i] = lanes[i][begins]
    return lanes, np.add.reduceat(counts, begins)


def _shifted(x: np.ndarray, by: int) -> np.ndarray:
    return x >> np.uint64(by) if by < 64 else np.zeros_like(x)


def _short(x: np.ndarray, width: int) -> bytes:
    """The low bytes that ``width`` bits need."""
    return np.ascontiguousarray(x, "<u8").view(np.uint8).reshape(-1, 8)[:, :(width + 7) // 8].tobytes()


def to_filter(lanes: list[np.ndarray], counts: np.ndarray, widths: list[int], bucket_bits: int) -> bytes:
    """One bucket's sorted entries: per quotient the number of its remainders, the remainders, the counts."""
    n = len(counts)
    quotient_bits = min(max(n.bit_length() - 1, 0), widths[0] - bucket_bits, 24)
    rest = widths[0] - bucket_bits - quotient_bits
    runs = np.bincount((_shifted(lanes[0], rest) & np.uint64((1 << quotient_bits) - 1)).astype(np.int64), minlength=1 << quotient_bits)
    wide = "<u1" if runs.max() < 256 else "<u4"
    small = np.minimum(counts - 1, 255).astype("<u1")
    head = np.array([n, quotient_bits, int(wide[2]), int((small == 255).sum())], "<u4").tobytes()
    return b"".join([head, runs.astype(wide).tobytes(), _short(lanes[0] & np.uint64((1 << rest) - 1), rest),
                     *[_short(x, w) for x, w in zip(lanes[1:], widths[1:])], small.tobytes(), counts[small == 255].astype("<u8").tobytes()])


def from_filter(data: bytes, bucket: int, widths: list[int], bucket_bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    n, quotient_bits, wide, more = np.frombuffer(data, "<u4", 4).tolist()
    at = 16
    def take(kind, many):
        nonlocal at
        out = np.frombuffer(data, kind, many, at)
        at += out.nbytes
        return out
    def remainders(width):
        held = np.zeros((n, 8), np.uint8)
        size = (width + 7) // 8
        held[:, :size] = take("u1", n * size).reshape(n, size)
        return held.view("<u8").ravel()
    rest = widths[0] - bucket_bits - quotient_bits
    runs = take(f"<u{wide}", 1 << quotient_bits)
    quotient = np.repeat(np.arange(1 << quotient_bits, dtype=np.uint64), runs)
    first = remainders(rest)
    above = (np.uint64(bucket) << np.uint64(quotient_bits)) | quotient
    lanes = [(above << np.uint64(rest) if rest < 64 else 0) | first, *[remainders(w) for w in widths[1:]]]
    counts = take("<u1", n).astype(np.int64) + 1
    counts[counts == 256] = take("<u8", more).astype(np.int64)
    return lanes, counts


def _places(columns: list[np.ndarray], table_bits: int) -> np.ndarray:
    """The bit of a phrase in the table of frequent ones."""
    out = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        out = mix(out * np.uint64(ODD) + c.astype(np.uint64))
    return out & np.uint64(table_bits - 1)


def _counted(runs: DataFrame, layout: Layout, bucket_bits: int, table, table_bits: int, held: int, gathered: int) -> DataFrame:
    """(bucket, filter): each task's windows. ``table`` tells which windows one word shorter may be frequent."""
    length, widths = layout.length, layout.widths

    def send(lanes, counts):
        buckets = _shifted(lanes[0], widths[0] - bucket_bits)
        begins = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]])
        stops = np.append(begins[1:], len(counts))
        rows = [to_filter([x[a:b] for x in lanes], counts[a:b], widths, bucket_bits) for a, b in zip(begins, stops)]
        return pa.RecordBatch.from_arrays([pa.array(buckets[begins].astype(np.int64)), pa.array(rows, pa.binary())], names=["bucket", "filter"])

    def run(batches):
        allowed = None if table is None else table.value
        entries = [np.zeros(0, np.uint64) for _ in widths], np.zeros(0, np.int64)
        waiting, many = [], 0

        def merged():
            nonlocal entries, waiting, many
            lanes = [np.concatenate([entries[0][i], *[w[i] for w in waiting]]) for i in range(len(widths))]
            counts = np.concatenate([entries[1], np.ones(many, np.int64)])
            entries, waiting, many = None, [], 0
            return summed(lanes, counts)

        for batch in batches:
            column = batch.column("codes")
            # rows end with a break or where no window may go on
            whole = np.insert(np.asarray(column.flatten()), np.cumsum(np.asarray(column.value_lengths()))[:-1], 0)
            for first in range(0, len(whole) - length + 1, STEP):
                codes = whole[first:first + STEP + length - 1]
                good = codes > 0
                if allowed is not None:
                    # windows one word shorter that may be frequent
                    ok = np.logical_and.reduce([good[i:len(good) - length + 2 + i] for i in range(length - 1)])
                    at = np.flatnonzero(ok)
                    place = _places([codes[at + i] for i in range(length - 1)], table_bits)
                    ok[at] = (allowed[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) > 0
                    start = np.flatnonzero(ok[:-1] & ok[1:])
                else:
                    start = np.flatnonzero(good[:-1] & good[1:])
                if not len(start):
                    continue
                waiting.append(layout.permute(layout.pack([codes[start + i] for i in range(length)])))
                many += len(start)
                if many >= gathered:
                    entries = merged()
                    if len(entries[1]) >= held:
                        yield send(*entries)
                        entries = [np.zeros(0, np.uint64) for _ in widths], np.zeros(0, np.int64)
        entries = merged()
        if len(entries[1]):
            yield send(*entries)

    return runs.mapInArrow(run, "bucket long, filter binary")


def _merged(filters: DataFrame, layout: Layout, bucket_bits: int, least: int) -> DataFrame:
    """(ids, f): phrases whose counts in all filters of their bucket come to ``least``."""
    widths = layout.widths

    def merge(key, table):
        parts = [from_filter(f.as_buffer(), key[0].as_py(), widths, bucket_bits) for f in table.column("filter")]
        lanes, counts = [np.concatenate([p[0][i] for p in parts]) for i in range(len(widths))], np.concatenate([p[1] for p in parts])
        del parts
        lanes, counts = summed(lanes, counts)
        often = counts >= least
        words = layout.unpack(layout.invert([x[often] for x in lanes]))
        ids = np.stack(words, axis=1).astype(np.int64).ravel() - 1
        n = int(often.sum())
        return pa.table({"ids": pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * layout.length), pa.array(ids)), "f": pa.array(counts[often])})

    # a given number of partitions, so that small filters are not joined into one task
    spread = filters.repartition(max(1, min(1 << bucket_bits, 2048)), "bucket")
    return spread.groupBy("bucket").applyInArrow(merge, "ids array<long>, f long")


def _table(phrases: DataFrame, n: int, most_bits: int) -> tuple[np.ndarray, int]:
    """A bit table of some phrases: 16 bits a phrase, at most ``most_bits``."""
    table_bits = min(most_bits, 1 << max(10, (16 * n - 1).bit_length()))

    def run(batches):
        for batch in batches:
            ids = batch.column("ids")
            if batch.num_rows:
                words = np.asarray(ids.flatten()).reshape(batch.num_rows, -1) + 1
                place = np.unique(_places(list(words.T), table_bits))
                yield pa.RecordBatch.from_arrays([pa.array((place >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (place & np.uint64(63))).view(np.int64))],
                                                 names=["at", "bit"])

    words = phrases.select("ids").mapInArrow(run, "at long, bit long").groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow()
    table = np.zeros(max(1, table_bits >> 6), np.uint64)
    table[words["at"].to_numpy()] = words["bit"].to_numpy().view(np.uint64)
    return table, table_bits


# ---- phrases --------------------------------------------------------------------------------------------------

def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, block: int = VOCABULARY, bucket: int = BUCKET,
                     held: int = HELD, gathered: int = GATHERED, table_bits: int = TABLE_BITS, hash_bits: int = 64):
    """(vocabulary, phrases, totals): words with their number ``id``, language and count; phrases of one to ``longest`` words as
    lists of numbers ``ids`` with their count ``f``; the number of words per language."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words = staged(rows.mapInArrow(_words(hash_bits), "lang string, h long, word string, c long").groupBy("lang", "h", "word").agg(F.sum("c").alias("c")), "words")
    totals = words.groupBy("lang").agg(F.sum("c").alias("n"))
    vocabulary, n_words = numbered(words.where(F.col("c") >= least), ["h", "lang", "word"], "id")
    vocabulary = staged(vocabulary, "vocabulary")
    phrases = [vocabulary.select(F.array("id").alias("ids"), F.col("c").alias("f"))]
    if n_words:
        # hashes that several words have, one of them frequent: with 64 bits there are next to none
        shared = words.groupBy("h").agg(F.count(F.lit(1)).alias("__many"), F.max("c").alias("__most")).where((F.col("__many") > 1) & (F.col("__most") >= least))
        known = words.join(shared.select("h"), "h", "left_semi").join(vocabulary.select("lang", "word", "id"), ["lang", "word"], "left")
        known = {(r.h, r.lang, r.word): r.id + 1 if r.id is not None else 0 for r in known.collect()}
        runs = _coded(rows, vocabulary, n_words, known, hash_bits, block)
        n_frequent = vocabulary.agg(F.sum("c")).first()[0]
        bits, table, size = max(n_words.bit_length(), 1), None, 0
        for length in range(2, longest + 1):
            layout = Layout(length, bits)
            bucket_bits = min(max(0, (n_frequent // bucket).bit_length()), layout.widths[0], 40)
            sent = None if table is None else spark.sparkContext.broadcast(table)
            filters = staged(_counted(runs, layout, bucket_bits, sent, size, held, gathered), "filters", PAGES)
            found = staged(_merged(filters, layout, bucket_bits, least), "phrases")
            n_found = found.count()
            if not n_found:
                break
            phrases.append(found)
            if length < longest:
                table, size = _table(found, n_found, table_bits)
    return vocabulary, reduce(DataFrame.unionByName, phrases), totals


def mined(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, first: int = FIRST, **sizes) -> DataFrame:
    """The first phrases per language: lang, rank, phrase, a, l, r, n, score.

    A null lang is ``und``, a null text empty. Texts are read whole whatever their length; repeated rows count again. Equal
    scores and counts go by the phrase, so ranks are certain. Other columns are ignored. A table without frequent words, or
    an empty one, gives no rows. Counts and scores are exact (decimals of 38 digits)."""
    vocabulary, phrases, totals = frequent_phrases(docs, least, longest, **sizes)
    phrases = staged(phrases, "all-phrases")
    long_ = phrases.where(F.size("ids") > 1)
    langs = vocabulary.select(F.col("id").alias("__first"), "lang").join(totals, "lang")
    cuts = (long_.join(langs, F.col("ids")[0] == F.col("__first")).select("lang", "n", "ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("cut"))
            .select("*", F.slice("ids", F.lit(1), F.col("cut")).alias("__left"), F.slice("ids", F.col("cut") + 1, F.size("ids") - F.col("cut")).alias("__right")))
    cuts = (cuts.join(phrases.select(F.col("ids").alias("__left"), F.col("f").alias("l")), "__left")
            .join(phrases.select(F.col("ids").alias("__right"), F.col("f").alias("r")), "__right"))
    wide = lambda c: f"cast({c} as decimal(19, 0))"
    score = F.expr(f"(1000bd * {wide('a')} * {wide('n')}) div ({wide('l')} * {wide('r')})")
    scored = cuts.groupBy("lang", "n", "ids", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("__best"))
    # phrases within a longer one that is as frequent (it cannot be more frequent)
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.size("ids") - 1), lambda k: F.transform(
        F.sequence(F.lit(1), F.size("ids") - k + 1), lambda at: F.slice("ids", at, k))))
    within = long_.where(F.size("ids") > 2).select(F.explode(inner).alias("ids"), "f").groupBy("ids").agg(F.max("f").alias("__longer"))
    left = (scored.join(within, "ids", "left").where(F.col("__longer").isNull() | (F.col("__longer") < F.col("a")))
            .select("lang", "n", "ids", "a", "__best.score", "__best.l", "__best.r"))
    spelled = (left.select("ids", F.posexplode("ids").alias("__at", "id")).join(vocabulary.select("id", "word"), "id")
               .groupBy("ids").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("__at", "word"))), lambda x: x["word"]), " ").alias("phrase")))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    return (left.join(spelled, "ids").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
