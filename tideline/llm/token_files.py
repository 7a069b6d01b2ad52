"""Token ids in binary files of compressed planes.

A file holds the ids of consecutive documents. They are cut into blocks of ``BLOCK`` ids, whatever the document; a
block is transposed into planes (the 8 bits or the single bits of equal weight of all its ids), and every plane is
compressed with zstandard on its own. High planes are nearly constant and shrink to almost nothing. Layout::

    MAGIC | planes of block 0 | planes of block 1 | ... | index | length of the index (8 bytes) | MAGIC

The index is a JSON header and five compressed little-endian arrays: ids per block, bytes of each plane of each block,
and per document its id, whether that is null, and its number of ids. A reader finds the block of any id from the
index and reads only that block (``FileReader.ids``).

Documents are laid out in ascending doc_id (null first; equal ids by a hash of the text) by a range exchange, so a
partition writes consecutive documents and only one number per file is needed to place it among all ids. A file
is written under a name of its own by each attempt of a task and counts only if the task's row reached the
written list of files, so a lost executor or a repeated task leaves at most a file that nobody reads.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.staging import staged
from ..session import fresh_dir

#: fixed value: opens and closes a file
MAGIC = b"TIDEPLN1"
BLOCK = 1 << 16
#: ids after which a task begins a new file
FILE_IDS = 1 << 25
#: characters worked on at once, and words a worker remembers
SLICE, WORDS = 1 << 20, 400_000
BEFORE_WORD = re.compile(r" (?=\S)")


# ---- ids of texts ---------------------------------------------------------------------------------------------

class Encoder:
    """Ids of whole texts by a file of the tokenizers library, without special tokens.

    A byte-level tokenizer with the usual pattern parts a text before every space that a visible character
    follows, whatever stands around it. Such tokenizers are therefore asked once for each different word of a batch,
    many words in one call, and a long text is worked on in slices. Others are given whole texts."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        before = parts.get("pre_tokenizer") or {}
        self.by_words = (parts.get("normalizer") is None and parts.get("post_processor") is None and parts.get("truncation") is None
                         and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
                         and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] for t in parts.get("added_tokens", [])))
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)  # ids whose token begins with a space
        self.opens[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True
        self.known: dict[str, int] = {}
        self.flat, self.starts = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64)
        self.used = 0

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _remember(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        first, n = len(self.known), len(words)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while first + n + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.flat[self.used:self.used + len(ids)] = ids
        self.starts[first + 1:first + n + 1] = self.used + np.cumsum(counts)
        self.used += len(ids)
        self.known.update(zip(words, range(first, first + n)))

    def _learn(self, words: list[str]) -> None:
        """Ids of words that follow a space."""
        joint = [w for w in words if " " not in w]
        lone = [w for w in words if " " in w]
        for at in range(0, len(joint), 20_000):
            some = joint[at:at + 20_000]
            lines = [" " + " ".join(some[i:i + 200]) for i in range(0, len(some), 200)]
            ids = np.array(list(itertools.chain.from_iterable(self._plain(lines))), np.uint32)
            begins = np.flatnonzero(self.opens[ids])
            if len(begins) == len(some):
                self._remember(some, ids, np.diff(np.append(begins, len(ids))))
            else:
                lone += some
        if lone:
            each = self._plain([" " + w for w in lone])
            self._remember(lone, np.array(list(itertools.chain.from_iterable(each)), np.uint32), np.array([len(e) for e in each]))

    def _slices(self, text: str):
        at = 0
        while len(text) - at > SLICE:
            cut = BEFORE_WORD.search(text, at + SLICE)
            if cut is None:
                break
            yield text[at:cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def _group(self, texts: list[str]) -> list[np.ndarray]:
        parts = [BEFORE_WORD.split(text) for text in texts]
        first = self._plain([p[0] for p in parts])
        words = list(itertools.chain.from_iterable(p[1:] for p in parts))
        kept, filled = len(self.known), self.used
        new = list(set(words).difference(self.known))
        self._learn(new)
        which = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        begin, size = self.starts[which], self.starts[which + 1] - self.starts[which]
        stops = np.cumsum(size)
        ids = self.flat[np.arange(int(stops[-1]) if len(stops) else 0) + np.repeat(begin - (stops - size), size)]
        borders = np.concatenate([[0], stops])[np.concatenate([[0], np.cumsum([len(p) - 1 for p in parts])])]
        if len(self.known) > WORDS:  # the words of this group are forgotten again, the earlier ones stay
            for word in new:
                del self.known[word]
            self.used = filled
        return [np.concatenate([np.array(f, np.uint32), ids[a:b]]) for f, a, b in zip(first, borders[:-1], borders[1:])]

    def __call__(self, texts: list[str]):
        """One array of ids per text, in order."""
        if not self.by_words:
            for text in texts:
                yield np.array(self._plain([text])[0], np.uint32)
            return
        group, size = [], 0
        for text in texts:
            if len(text) > SLICE:
                yield from self._group(group) if group else ()
                group, size = [], 0
                yield np.concatenate([self._group([part])[0] for part in self._slices(text)])
                continue
            group.append(text)
            size += len(text)
            if size > SLICE:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group) if group else ()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a file, kept for the life of the worker. A bare name is one of the public tokenizers."""
    if path not in _encoders:
        if "/" not in path:
            import public_tokenizers
            _encoders[path] = Encoder(public_tokenizers.path(path))
        else:
            _encoders[path] = Encoder(path)
    return _encoders[path]


# ---- planes ---------------------------------------------------------------------------------------------------

def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The byte planes (4, least first) or bit planes (32, least first) of a block."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [raw[:, p].tobytes() for p in range(4)]
    single = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(single[:, p], bitorder="little").tobytes() for p in range(32)]


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    if not bits:
        return np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1).copy().view("<u4").ravel()
    single = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes], axis=1)
    return np.packbits(single, axis=1, bitorder="little").view("<u4").ravel()


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow file system of a path or address. A name without a scheme, or one of scheme file, is a mounted folder."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if path.startswith("s3a:"):
        path = "s3:" + path[4:]
    return pafs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (pafs.LocalFileSystem(), path)


class FileWriter:
    """Writes documents one after the other; blocks leave memory when they are full."""

    def __init__(self, path: str, bits: bool = False, level: int = 3):
        files, name = file_system(path)
        files.create_dir(os.path.dirname(name), recursive=True)
        self.out, self.bits = files.open_output_stream(name), bits
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.waiting, self.held, self.n_ids = [], 0, 0
        self.block_ids, self.plane_bytes = [], []
        self.doc_ids, self.doc_null, self.doc_counts = [], [], []
        self.out.write(MAGIC)

    def _block(self, ids: np.ndarray) -> None:
        planes = [self.zstd.compress(p) for p in to_planes(ids, self.bits)]
        self.out.write(b"".join(planes))
        self.block_ids.append(len(ids))
        self.plane_bytes += [len(p) for p in planes]

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id or 0)
        self.doc_null.append(doc_id is None)
        self.doc_counts.append(len(ids))
        self.waiting.append(ids)
        self.held += len(ids)
        self.n_ids += len(ids)
        if self.held >= BLOCK:
            whole = np.concatenate(self.waiting)
            full = len(whole) // BLOCK * BLOCK
            for at in range(0, full, BLOCK):
                self._block(whole[at:at + BLOCK])
            self.waiting, self.held = [whole[full:]], len(whole) - full

    def close(self) -> None:
        if self.held:
            self._block(np.concatenate(self.waiting))
        arrays = [np.array(x, k) for x, k in ((self.block_ids, "<i8"), (self.plane_bytes, "<i8"), (self.doc_ids, "<i8"),
                                              (self.doc_null, "u1"), (self.doc_counts, "<i8"))]
        packed = [self.zstd.compress(a.tobytes()) for a in arrays]
        head = json.dumps({"bits": self.bits, "block": BLOCK, "ids": self.n_ids, "arrays": [len(p) for p in packed]}).encode()
        index = len(head).to_bytes(8, "little") + head + b"".join(packed)
        self.out.write(index + len(index).to_bytes(8, "little") + MAGIC)
        self.out.close()


class FileReader:
    """Random access to a file: the index first, then only the blocks that are asked for."""

    def __init__(self, path: str):
        files, name = file_system(path)
        self.file = files.open_input_file(name)
        end = self.file.size()
        self.file.seek(end - 16)
        tail = self.file.read(16)
        if tail[8:] != MAGIC:
            raise ValueError(f"{path} is not a finished file of token planes")
        size = int.from_bytes(tail[:8], "little")
        self.file.seek(end - 16 - size)
        index = self.file.read(size)
        at = 8 + int.from_bytes(index[:8], "little")
        self.head = json.loads(index[8:at])
        arrays, unpack = [], zstandard.ZstdDecompressor()
        for n, kind in zip(self.head["arrays"], ("<i8", "<i8", "<i8", "u1", "<i8")):
            arrays.append(np.frombuffer(unpack.decompress(index[at:at + n]), kind))
            at += n
        self.bits, self.unpack = self.head["bits"], unpack
        block_ids, plane_bytes, self.doc_ids, self.doc_null, self.doc_counts = arrays
        self.plane_bytes = plane_bytes.reshape(len(block_ids), 32 if self.bits else 4)
        self.first_id = np.concatenate([[0], np.cumsum(block_ids)])
        self.place = len(MAGIC) + np.concatenate([[0], np.cumsum(self.plane_bytes.sum(axis=1))]).astype(np.int64)
        self._last = (-1, None)

    def block(self, number: int) -> np.ndarray:
        if self._last[0] != number:
            self.file.seek(int(self.place[number]))
            data = self.file.read(int(self.place[number + 1] - self.place[number]))
            stops = np.cumsum(self.plane_bytes[number])
            planes = [self.unpack.decompress(data[b - n:b]) for b, n in zip(stops, self.plane_bytes[number])]
            self._last = (number, from_planes(planes, int(self.first_id[number + 1] - self.first_id[number]), self.bits))
        return self._last[1]

    def ids(self, start: int, stop: int):
        """The ids from ``start`` to before ``stop``, block by block."""
        number = int(np.searchsorted(self.first_id, start, side="right")) - 1
        while start < stop:
            first, end = int(self.first_id[number]), int(self.first_id[number + 1])
            yield self.block(number)[start - first:min(stop, end) - first]
            start, number = min(stop, end), number + 1

    def documents(self):
        """(doc_id, first place in the file, number of ids, checksum) of every document."""
        at = 0
        for doc_id, null, n in zip(self.doc_ids.tolist(), self.doc_null.tolist(), self.doc_counts.tolist()):
            crc = 0
            for part in self.ids(at, at + n):
                crc = zlib.crc32(part.tobytes(), crc)
            yield None if null else doc_id, at, n, crc
            at += n


# ---- Spark jobs -----------------------------------------------------------------------------------------------

def _writer(folder: str, tokenizer: str, end_id: int | None, bits: bool, file_ids: int):
    names = ["part", "seq", "name", "n_ids", "n_docs"]
    closing = np.array([] if end_id is None else [end_id], np.uint32)

    def run(batches):
        from pyspark import TaskContext
        part, seq, open_file, name = TaskContext.get().partitionId(), 0, None, None
        encode, done = encoder(tokenizer), []
        for batch in batches:
            texts = batch.column("text").fill_null("").to_pylist()
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(texts)):
                if open_file is None:
                    name = f"part-{part:06d}-{seq:04d}-{uuid.uuid4().hex}.planes"
                    open_file = FileWriter(f"{folder}/{name}", bits)
                open_file.add(doc_id, np.concatenate([ids, closing]))
                if open_file.n_ids >= file_ids:
                    open_file.close()
                    done.append((part, seq, name, open_file.n_ids, len(open_file.doc_ids)))
                    open_file, seq = None, seq + 1
        if open_file is not None:
            open_file.close()
            done.append((part, seq, name, open_file.n_ids, len(open_file.doc_ids)))
        columns = list(zip(*done)) if done else [()] * 5
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)
    return run


def write_tokens(docs: DataFrame, folder: str | None = None, tokenizer: str = "byte_bpe_50k.json", end_id: int | None = 0,
                 bits: bool = False, file_ids: int = FILE_IDS) -> DataFrame:
    """Write the ids of all texts of ``docs`` (doc_id, text) into files of one folder, in ascending doc_id.

    Returns the list of files, written in the shared folder: folder, name, start (ids of all files before it), n_ids,
    n_docs. Null texts count as empty; every document ends with ``end_id`` unless that is None. Rows with a null doc_id
    come first, rows that repeat a doc_id are all written (equal texts side by side). Texts of any length are
    encoded whole, a slice at a time. Other columns are ignored. An empty table writes no file."""
    spark = docs.sparkSession
    folder = folder or fresh_dir(spark, "tokens")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # copies of one row may make up much of a table: the random number lets them share partitions' borders
    order = ["doc_id", F.xxhash64("text"), F.rand(5)]
    placed = rows.withColumn("__r", order[2]).withColumn("__h", order[1])
    placed = placed.repartitionByRange("doc_id", "__h", "__r").sortWithinPartitions("doc_id", "__h").select("doc_id", "text")
    files = staged(placed.mapInArrow(_writer(folder, tokenizer, end_id, bits, file_ids),
                                     "part long, seq long, name string, n_ids long, n_docs long"), "token-files")
    total, starts = 0, []
    # one row per file of up to FILE_IDS ids
    for row in sorted(files.select("part", "seq", "n_ids").collect()):
        starts.append((row.part, row.seq, total))
        total += row.n_ids
    placed = spark.createDataFrame(starts, "part long, seq long, start long")
    return (files.join(F.broadcast(placed), ["part", "seq"])
            .select(F.lit(folder).alias("folder"), "name", "start", "n_ids", "n_docs"))


def read_documents(files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of every document, read from the files."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                reader = FileReader(f"{row['folder']}/{row['name']}")
                found = reader.documents()
                while some := list(itertools.islice(found, 10_000)):
                    ids, at, n, crc = zip(*some)
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([row["start"] + a for a in at], pa.int64()),
                                                      pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                                                     names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # files are few and heavy: a given number of partitions, so that they are not joined into one again
    return files.repartition(max(1, files.count()), "name").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_ids(spark: SparkSession, files: DataFrame, start: int, stop: int) -> np.ndarray:
    """The ids from ``start`` to before ``stop`` of the whole sequence, from the blocks that hold them only."""
    some = files.where((F.col("start") < stop) & (F.col("start") + F.col("n_ids") > start)).orderBy("start").collect()
    parts = [part for f in some for part in FileReader(f"{f.folder}/{f.name}").ids(max(start - f.start, 0), min(stop - f.start, f.n_ids))]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)
