"""Quotient filters keep every bit; phrases equal plain counting, also with shared hashes and many small filters."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tideline.llm import collocations as col

SCHEMA = "doc_id long, text string, lang string"


@pytest.mark.parametrize("length, bits", [(2, 1), (2, 15), (3, 21), (4, 16), (5, 13), (5, 16), (5, 25), (5, 40), (3, 64), (2, 32)])
def test_layout_and_filter_round_trip(length, bits):
    draw = np.random.default_rng(length * 100 + bits)
    layout = col.Layout(length, bits)
    columns = [draw.integers(0, 2 ** min(bits, 62), 3000).astype(np.uint64) for _ in range(length)]
    lanes = layout.permute(layout.pack(columns))
    assert all(int(x.max()).bit_length() <= w for x, w in zip(lanes, layout.widths))
    assert all((a == b).all() for a, b in zip(layout.unpack(layout.invert(lanes)), columns))
    # no two windows become one, and sums are exact
    counts = draw.integers(1, 1000, 3000) * (draw.integers(0, 50, 3000) == 0) * 10**9 + draw.integers(1, 600, 3000)
    expected = Counter()
    for key, c in zip(zip(*[x.tolist() for x in columns]), counts.tolist()):
        expected[key] += c
    lanes, counts = col.summed(lanes, counts)
    assert len(counts) == len(expected)
    for bucket_bits in {0, min(3, layout.widths[0]), min(9, layout.widths[0])}:
        got = Counter()
        buckets = col._shifted(lanes[0], layout.widths[0] - bucket_bits)
        for bucket in np.unique(buckets).tolist():
            here = buckets == bucket
            data = col.to_filter([x[here] for x in lanes], counts[here], layout.widths, bucket_bits)
            back, n = col.from_filter(data, bucket, layout.widths, bucket_bits)
            assert all((a == x[here]).all() for a, x in zip(back, lanes)) and (n == counts[here]).all()
            for key, c in zip(zip(*[x.tolist() for x in layout.unpack(layout.invert(back))]), n.tolist()):
                got[key] += c
        assert got == expected


def test_filters_are_smaller_than_their_entries():
    draw = np.random.default_rng(5)
    layout = col.Layout(5, 16)
    lanes, counts = col.summed(layout.permute(layout.pack([draw.integers(0, 60000, 200_000) for _ in range(5)])), np.ones(200_000, np.int64))
    assert len(col.to_filter(lanes, counts, layout.widths, 0)) < 12 * len(counts)  # 10 bytes of a window and 8 of a count


def plain(rows, least, longest, first):
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        text = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            w = re.findall("[^ \t]+", piece)
            totals[lang] += len(w)
            for k in range(1, longest + 1):
                counts.update((lang, *w[i:i + k]) for i in range(len(w) - k + 1))
    out = {}
    often = {k: f for k, f in counts.items() if f >= least}
    for (lang, *w), a in often.items():
        if len(w) < 2:
            continue
        if any(f >= a and key[0] == lang and len(key) - 1 > len(w) and any(list(key[1 + i:1 + i + len(w)]) == w for i in range(len(key) - len(w)))
               for key, f in often.items()):
            continue
        n = totals[lang]
        score, _, l, r = min((1000 * a * n // (counts[(lang, *w[:k])] * counts[(lang, *w[k:])]), k, counts[(lang, *w[:k])], counts[(lang, *w[k:])]) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r, n))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n, -s) for lang, found in out.items() for i, (s, a, p, l, r, n) in enumerate(sorted(found)[:first]))


def texts(seed, n):
    draw = random.Random(seed)
    words = ["the", "of", "New", "York", "a", "a", "ünï", "x-y", "(z)", "日本", "q" * 40, "12"]
    fixed = ["new york city hall is", "a a a a a a", "of the x-y", "Ünï ünï"]
    rows = []
    for i in range(n):
        parts = [draw.choice(fixed) if draw.random() < 0.4 else " ".join(draw.choices(words, k=draw.randint(1, 6))) for _ in range(draw.randint(0, 6))]
        rows.append((i, draw.choice([" ", ", ", "\n", ". ", "\t", "  "]).join(parts), draw.choice(["en", "de", None, "und", ""])))
    return rows


@pytest.mark.parametrize("sizes", [{}, dict(block=3, bucket=50, held=20, gathered=30, table_bits=64), dict(hash_bits=2, block=5), dict(hash_bits=1, bucket=200)])
def test_against_plain_counting(spark, sizes):
    rows = texts(11, 300)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in col.mined(df, least=8, first=40, **sizes).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    expected = plain(rows, 8, 5, 40)
    assert len(expected) > 60 and got == expected


def test_odd_rows(spark, odd):
    """Nulls, blanks, repeated rows, a text of some megabytes, clashing columns, empty tables."""
    long_text = "alpha beta gamma " * 120_000 + "delta, " * 3
    rows = [(i, t, lang) for i, t, lang in [(1, long_text, "en"), (2, None, None), (None, "", ""), (3, " \t.,", "en"), (4, "x y", None), (4, "x y", None), (None, "X Y", "und")]]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as n", "2 as a", "'q' as phrase", "3 as h", "4 as ids", "5 as score", "6 as word")
    got = sorted(tuple(r) for r in col.mined(df, least=3).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert [g for g in got if g[0] == "und"] == [("und", 1, "x y", 3, 3, 3, 6, 2000)]
    n = 360_003
    assert {g[2]: g[3] for g in got if g[0] == "en"} == {"alpha beta gamma alpha beta": 119_999, "beta gamma alpha beta gamma": 119_999, "gamma alpha beta gamma alpha": 119_998,
                                                        "alpha beta gamma": 120_000} and all(g[6] == n for g in got if g[0] == "en")
    assert all(r.a >= 2 for r in col.mined(odd, least=2).collect())
    assert col.mined(odd.where("false")).collect() == [] and col.mined(odd, least=10**9).collect() == []


def _page_values(spark, df):
    """Values of the largest page of each column of a table that was written."""
    jvm, most = spark._jvm, {}
    for file in df.inputFiles():
        opened = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(file), spark._jsc.hadoopConfiguration())
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(opened)
        columns = list(reader.getFooter().getFileMetaData().getSchema().getColumns())
        while (group := reader.readNextRowGroup()) is not None:
            for column in columns:
                pages = group.getPageReader(column)
                while (page := pages.readPage()) is not None:
                    path = column.getPath()[0]
                    most[path] = max(most.get(path, (0, 0)), (page.getValueCount(), page.getUncompressedSize()))
        reader.close()
    return most


def test_pages_and_rows_are_bounded(spark, monkeypatch):
    """Neither a row, nor a page, nor what a reader decodes at once grows with the text of a task."""
    draw = random.Random(3)
    words = [f"w{i}" for i in range(2000)]
    text = ". ".join(" ".join(draw.choices(words, k=10)) for _ in range(80_000))
    kept = {}

    def staged(df, label, *more):
        kept[label] = plain_staged(df, label, *more)
        return kept[label]

    plain_staged = col.staged
    monkeypatch.setattr(col, "staged", staged)
    df = spark.createDataFrame([(i, text, "en") for i in range(2)], SCHEMA).coalesce(1)
    # filters as of many words: sent with 4,096 entries, in rows of some tens of KB
    vocabulary, phrases, _ = col.frequent_phrases(df, least=1, longest=2, bucket=1 << 30, held=1 << 12, gathered=1 << 14)
    assert vocabulary.count() == 2000 and phrases.where("size(ids) = 2").selectExpr("sum(f)").first()[0] == 2 * 80_000 * 9
    assert kept["runs"].selectExpr("max(size(codes))").first()[0] < 2 * col.ROW and 4096 * col.ROW * 8 <= 32 << 20
    pages = _page_values(spark, kept["runs"])
    assert pages["codes"][0] < 600_000 and pages["codes"][1] < 2 << 20
    pages = _page_values(spark, kept["filters"])
    assert kept["filters"].selectExpr("sum(length(filter))").first()[0] > 3 << 20 and pages["filter"][1] < 2 << 20


@pytest.mark.parametrize("length", [2, 4])
def test_windows_are_made_in_steps(length):
    """A batch of many numbers is counted whole, in memory that does not follow it."""
    import tracemalloc

    import pyarrow as pa

    class Runs:
        def mapInArrow(self, run, schema):
            return run

    class Table:
        value = np.full(16, 2**64 - 1, np.uint64)

    draw = np.random.default_rng(1)
    codes = draw.integers(0, 4000, 3_000_000)
    layout = col.Layout(length, 12)
    run = col._counted(Runs(), layout, 3, None if length == 2 else Table, 1024, 1 << 15, 1 << 16)
    offsets = np.r_[np.arange(0, len(codes), 1_000_003), len(codes)]
    codes[offsets[1:] - 1] = 0
    batch = pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(codes))], names=["codes"])
    windows, got = Counter(), Counter()
    packed = sum(codes[i:len(codes) - length + 1 + i] << 12 * (length - 1 - i) for i in range(length))
    windows.update(packed[np.logical_and.reduce([codes[i:len(codes) - length + 1 + i] > 0 for i in range(length)])].tolist())
    rows, most = [], 0
    tracemalloc.start()
    for sent in run([batch]):
        rows += sent.to_pylist()
        most = max(most, tracemalloc.get_traced_memory()[1])
    tracemalloc.stop()
    held = sum(len(r["filter"]) for r in rows)
    for r in rows:
        lanes, n = col.from_filter(r["filter"], r["bucket"], layout.widths, 3)
        for key, c in zip(layout.invert(lanes)[0].tolist(), n.tolist()):
            got[key] += c
    assert got == windows
    assert most < held + 3 * codes.nbytes, (most, held)
