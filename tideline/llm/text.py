"""Words and hashed shingles of whole Arrow batches of text, in numpy.

A batch is worked through in pieces of about ``PIECE`` bytes cut at document ends, so the memory of a
task is bounded by its longest document, not by its batch. A word is a run of bytes other than 0x20
and 0x09-0x0D; UTF-8 never uses those bytes inside a character. Null texts count as empty.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 18
BASE = 0x9E3779B97F4A7C55  # odd, so it has an inverse modulo 2**64
_powers: dict[str, np.ndarray] = {}


@dataclass
class Piece:
    """Some documents of a batch: their bytes, and the words in them."""
    first: int           # row of the first document in the batch
    data: np.ndarray     # bytes
    ends: np.ndarray     # document borders in data, one more than documents
    starts: np.ndarray   # first byte of each word
    stops: np.ndarray    # byte after each word
    borders: np.ndarray  # document borders among the words

    def __len__(self) -> int:
        return len(self.ends) - 1

    def n_words(self) -> np.ndarray:
        return np.diff(self.borders)

    def document(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self)), self.n_words())


def is_space() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[32, 9, 10, 11, 12, 13]] = True
    return table


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def not_letters() -> np.ndarray:
    """Separators of plain words: all ASCII but letters and digits."""
    table = np.ones(256, bool)
    table[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
    table[128:] = False
    return table


def cut(data: np.ndarray, ends: np.ndarray, first: int, gaps: np.ndarray) -> Piece:
    space = gaps[data]
    before = np.ones(len(data), bool)
    before[1:] = space[:-1]
    after = np.ones(len(data), bool)
    after[:-1] = space[1:]
    before[ends[:-1][ends[:-1] < len(data)]] = True
    after[ends[1:][ends[1:] > 0] - 1] = True
    starts = np.flatnonzero(~space & before)
    return Piece(first, data, ends, starts, np.flatnonzero(~space & after) + 1, np.searchsorted(starts, ends))


def pieces(column: pa.Array, lower: bool = False, gaps: np.ndarray | None = None):
    """The documents of a string column, a few megabytes at a time. ``gaps``: which bytes part words."""
    gaps = is_space() if gaps is None else gaps
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return
    borders = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(borders, borders[a] + PIECE, "right")) - 1)
        own = data[borders[a]:borders[b]]
        yield cut(lower_table()[own] if lower else own, borders[a:b + 1] - borders[a], a, gaps)
        a = b


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below n. Those for a usual piece are kept for the life of the
    worker; those of a longer document are made for it and go with it."""
    def made(size: int) -> dict[str, np.ndarray]:
        out = {}
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[:1] = 1
            out[name] = np.multiply.accumulate(steps)
        return out

    kept = PIECE + (PIECE >> 1)
    if n > kept:
        own = made(n)
        return own["up"], own["down"]
    if not _powers:
        _powers.update(made(kept))
    return _powers["up"][:n], _powers["down"][:n]


def word_hashes(p: Piece, starts: np.ndarray | None = None, stops: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each word (or of other byte ranges): equal bytes, equal hash."""
    starts, stops = (p.starts, p.stops) if starts is None else (starts, stops)
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    up, down = powers(len(p.data) + 1)
    sums = np.zeros(len(p.data) + 1, np.uint64)
    np.cumsum((p.data + np.uint64(1)) * up[:-1], out=sums[1:])
    return mix((sums[stops] - sums[starts]) * down[starts])


def chain(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` values that begin at each place (the last places are left out)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = mix(hashes[:n] + np.uint64(size))
    for j in range(1, size):
        out = mix(out * np.uint64(BASE) + hashes[j:n + j])
    return out


def windows(p: Piece, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every run of ``size`` words that lies in one document."""
    all_ = chain(hashes, size)
    document = p.document()
    at = np.flatnonzero(document[:len(all_)] == document[size - 1:]) if len(all_) else np.zeros(0, np.int64)
    return at, all_[at]


def shingle_sets(p: Piece, hashes: np.ndarray, size: int):
    """Per document its sorted distinct shingle hashes (signed). A document of fewer than ``size``
    words has its whole word sequence as its only shingle; one without words has none."""
    all_ = chain(hashes, size).view(np.int64)
    for a, b in zip(p.borders[:-1], p.borders[1:]):
        if b - a >= size:
            yield np.unique(all_[a:b - size + 1])
        elif b > a:
            yield chain(hashes[a:b], int(b - a)).view(np.int64)
        else:
            yield np.zeros(0, np.int64)
