"""Token files: whole texts by the library, exact round trips, random access, odd rows."""

import random
import zlib

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from tideline.llm import token_files
from tideline.llm.queries import QUERIES
from tideline.session import fresh_dir


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def plain(tokenizer, texts):
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_encoder_equals_whole_texts(tokenizer, monkeypatch):
    """Words asked for once, slices of long texts and forgotten words change no id."""
    monkeypatch.setattr(token_files, "SLICE", 300)
    monkeypatch.setattr(token_files, "WORDS", 50)
    draw = random.Random(3)
    bits = ["a", "the", " ", "  ", "   ", "\n", "\t", " \n ", "'s", "don't", " ", " ", "é", "日本", "😀", "<|endoftext|>", "1234", "...", "_x",
            "\x1c", "\x1f", "\x85", "　", "\x00", "Ġ", "word", " word", "\r\n", "​", "\x0b"]
    texts = ["", " ", "  ", "x", "x" * 1000, " ".join(["w"] * 900)] + ["".join(draw.choices(bits, k=draw.randint(1, 400))) for _ in range(400)]
    encode = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert encode.by_words
    assert [x.tolist() for x in encode(texts)] == plain(tokenizer, texts)
    assert [x.tolist() for x in encode(texts[::-1])] == plain(tokenizer, texts)[::-1]
    # a tokenizer with other rules is given whole texts
    other = public_tokenizers.path("word_bpe_49k.json")
    encode = token_files.Encoder(other)
    assert not encode.by_words
    assert [x.tolist() for x in encode(texts[:50])] == plain(Tokenizer.from_file(other), texts[:50])


@pytest.mark.parametrize("bits", [False, True])
def test_planes_and_files(tmp_path, bits, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 1000)
    draw = np.random.default_rng(1)
    docs = [(i if i % 5 else None, draw.integers(0, 2 ** (32 if i % 2 else 15), n, dtype=np.uint32)) for i, n in enumerate([0, 1, 999, 1000, 1001, 5000, 0, 3])]
    for _, ids in docs:
        assert (token_files.from_planes(token_files.to_planes(ids, bits), len(ids), bits) == ids).all()
    path = f"{tmp_path}/deep/a.planes"
    writer = token_files.FileWriter(path, bits)
    for doc_id, ids in docs:
        writer.add(doc_id, ids)
    writer.close()
    reader = token_files.FileReader(path)
    whole = np.concatenate([ids for _, ids in docs])
    assert [(d, n, crc) for d, _, n, crc in reader.documents()] == [(d, len(x), zlib.crc32(x.tobytes())) for d, x in docs]
    for start, stop in ((0, 0), (0, 1), (998, 2003), (7000, len(whole)), (0, len(whole))):
        assert np.concatenate([np.zeros(0, np.uint32), *reader.ids(start, stop)]).tolist() == whole[start:stop].tolist()
    empty = token_files.FileWriter(f"{tmp_path}/empty.planes", bits)
    empty.close()
    assert list(token_files.FileReader(f"{tmp_path}/empty.planes").documents()) == []
    with open(f"{tmp_path}/cut.planes", "wb") as file:
        file.write(open(path, "rb").read()[:-9])
    with pytest.raises(ValueError):
        token_files.FileReader(f"{tmp_path}/cut.planes")


def expected(tokenizer, rows):
    at, out = 0, []
    for doc_id, text in rows:
        ids = np.array(plain(tokenizer, [text or ""])[0] + [0], "<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_query_against_brute_force(spark, data, tokenizer):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in QUERIES["op13_token_planes"](spark, data).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == expected(tokenizer, sorted((r.doc_id, r.text) for r in docs))


def test_odd_rows(spark, odd, tokenizer):
    """Null ids first, repeated ids all written, null and blank texts end with the end id only; many small files."""
    files = token_files.write_tokens(odd, file_ids=1000)
    got = sorted((tuple(r) for r in token_files.read_documents(files).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, 1, 2, 3, 4, 5, 6, 7, 7, 8]
    assert [a[1] for a in got] == [0, *np.cumsum([a[2] for a in got])[:-1]]
    texts = {r.doc_id: r.text for r in odd.where("doc_id is not null").collect()}
    assert all((n, crc) == expected(tokenizer, [(i, texts[i])])[0][2:] for i, _, n, crc in got if i is not None)
    assert got[2][2:] == (1, zlib.crc32(bytes(4)))
    # any stretch of the sequence, across files
    long_text = next(r for r in got if r[0] == 6)
    ids = plain(tokenizer, [texts[6]])[0] + [0]
    assert token_files.read_ids(spark, files, long_text[1], long_text[1] + long_text[2]).tolist() == ids
    assert token_files.read_ids(spark, files, long_text[1] - 3, long_text[1] + 2)[-2:].tolist() == ids[:2]
    # without an end id, an empty text has no ids
    none = token_files.read_documents(token_files.write_tokens(odd.where("doc_id = 2"), end_id=None, bits=True)).collect()
    assert [tuple(r) for r in none] == [(2, 0, 0, 0)]


def test_empty_table_and_given_folder(spark, odd):
    folder = fresh_dir(spark, "given")
    files = token_files.write_tokens(odd.where("false"), folder)
    assert files.collect() == [] and token_files.read_documents(files).collect() == []
    assert token_files.write_tokens(odd, folder).select("folder").distinct().collect() == [(folder,)]
