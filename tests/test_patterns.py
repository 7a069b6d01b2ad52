"""Row patterns over long runs: linear work, links instead of one task per clump, cells that lead into each other."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tideline.operators import patterns
from tideline.operators.patterns import Measure, match_rows


def greedy(letters, size, skip_to=None):
    """Non-overlapping runs of exactly ``size`` equal symbols, as (first, last) places."""
    out, i = [], 0
    while i + size <= len(letters):
        if all(x == "A" for x in letters[i:i + size]):
            out.append((i, i + size - 1))
            i = i + size if skip_to is None else i + skip_to
        else:
            i += 1
    return out


def series(spark, letters, key="a"):
    return spark.createDataFrame([(key, i, x) for i, x in enumerate(letters)], "k string, id long, s string").withColumn("t", F.timestamp_seconds("id"))


def symbols(*names):
    return {n: F.col("s") == n for n in names}


def places(df, *more):
    return sorted(tuple(r) for r in df.select("match_number", "start_id", "end_id", *more).collect())


@pytest.mark.parametrize("limit, cell", [(10**6, None), (10, None), (10, "60 seconds")])
def test_overlapping_matches_in_one_clump(spark, limit, cell):
    """A run over many cells: every start of a cell may be led to, all matches touch, and few stay."""
    draw = random.Random(5)
    letters = "A" * 331 + "B" + "".join(draw.choices("AAAAB", k=300)) + "AA"
    got = match_rows(series(spark, letters), ["k"], "t", "id", "A{3}", symbols("A", "B"), "5 seconds", cell=cell, rows_per_group=limit)
    assert places(got) == [(n + 1, a, b) for n, (a, b) in enumerate(greedy(letters, 3))]


def test_resuming_at_a_symbol_inside_a_large_clump(spark):
    """The next match begins at the last C of the one before."""
    letters = "AC" * 60 + "B" + "ACAC"
    got = match_rows(series(spark, letters), ["k"], "t", "id", "(A | C) A? C", symbols("A", "B", "C"), "4 seconds", skip="to last C", rows_per_group=8)
    expected, i = [], 0
    while i < len(letters):
        tail = letters[i:i + 3]
        size = 3 if tail in ("CAC", "AAC") else 2 if tail[:2] in ("AC", "CC") else 0
        if size:
            expected.append((i, i + size - 1))
            i += size - 1
        else:
            i += 1
    assert places(got) == [(n + 1, a, b) for n, (a, b) in enumerate(expected)] and len(expected) > 50


def test_a_long_run_is_linear(spark, monkeypatch):
    """One match of 20,000 rows: one start is tried, and ids are written once."""
    written = {}

    def counting(df, label, real=patterns.staged):
        out = real(df, label)
        written[label] = out.count()
        return out

    monkeypatch.setattr(patterns, "staged", counting)
    n = 20_000
    df = series(spark, ["A"] * n)
    started = time.time()
    got = match_rows(df, ["k"], "t", "id", "A+", symbols("A"), "1 day", measures={"last": Measure("last", "id")}).collect()
    took = time.time() - started
    assert [(r.start_id, r.end_id, r.n_rows, len(r.row_ids), r.last) for r in got] == [(0, n - 1, n, n, n - 1.0)]
    assert written["places"] == 1 and written["matches"] == 1 and took < 30


def test_several_keys_and_null_keys(spark):
    letters = {"a": "AAAAAAAA", "b": "AABAA", None: "AAAA"}
    df = None
    for key, text in letters.items():
        part = series(spark, text, "x").withColumn("k", F.lit(key).cast("string"))
        df = part if df is None else df.unionByName(part)
    for limit in (10**6, 2):
        got = match_rows(df, ["k"], "t", "id", "A A", symbols("A", "B"), "3 seconds", rows_per_group=limit)
        found = {key: sorted((r.start_id, r.end_id) for r in got.collect() if r.k == key) for key in letters}
        assert found == {key: greedy(text, 2) for key, text in letters.items()}


def run(spark, letters, pattern, names="ABC", within="1 hour", **options):
    return match_rows(series(spark, letters), ["k"], "t", "id", pattern, symbols(*names), within, **options)


def test_anchors(spark):
    """^ and $ are the first and the last row of the key, also where other rows lie between cells and parts."""
    assert places(run(spark, "AABAA", "^ A+")) == [(1, 0, 1)]
    assert places(run(spark, "AABAA", "A+ $")) == [(1, 3, 4)]
    assert places(run(spark, "xAABAAx", "^ A+ | A+ $")) == []
    assert places(run(spark, "AAA", "^ A+ $", within="1 second")) == []
    assert places(run(spark, "AAAAAA", "(^ A) | (A A $)", within="2 seconds", rows_per_group=2)) == [(1, 0, 0), (2, 4, 5)]


def test_permute_and_subset(spark):
    got = run(spark, "ABCxCBAxACBxAAB", "PERMUTE (A, B, C)", measures={"n": Measure("count", None, "AB"), "first": Measure("first", "id", "BC")},
              subsets={"AB": ["A", "B"], "BC": ["B", "C"]})
    assert places(got, "n", "first") == [(1, 0, 2, 2.0, 1.0), (2, 4, 6, 2.0, 4.0), (3, 8, 10, 2.0, 9.0)]
    assert places(run(spark, "AABBA", "PERMUTE (A+, B{2})")) == [(1, 0, 3)]
    # the next match begins at the last row that either symbol took
    again = run(spark, "ABCBC", "A? B C", skip="to last BC", subsets={"BC": ["B", "C"]})
    assert places(again) == [(1, 0, 2), (2, 3, 4)]
    with pytest.raises(ValueError):
        run(spark, "A", "A", subsets={"S": ["Z"]})


def test_rows_left_out(spark):
    got = run(spark, "ABBCAC", "A {- B* -} C", measures={"b": Measure("count", None, "B"), "rows": Measure("count")})
    assert places(got, "n_rows", "row_ids", "classifiers", "b", "rows") == [(1, 0, 3, 4, [0, 3], ["A", "C"], 2.0, 4.0), (2, 4, 5, 2, [4, 5], ["A", "C"], 0.0, 2.0)]
    assert [(r.row_id, r.classifier) for r in patterns.all_rows(got, ["k"]).orderBy("row_id").collect()] == [(0, "A"), (3, "C"), (4, "A"), (5, "C")]
    for bad in ("A {- B", "A -} B", "{- A {- B -} -}"):
        with pytest.raises(ValueError):
            run(spark, "A", bad)


def test_more_symbols_than_bits_of_a_long(spark):
    names = [f"S{i}" for i in range(150)]
    df = spark.range(150).select(F.lit("a").alias("k"), "id", F.concat(F.lit("S"), "id").alias("s"), F.timestamp_seconds("id").alias("t"))
    got = match_rows(df, ["k"], "t", "id", " ".join(names) + " $", symbols(*names), "1 hour")
    assert places(got, "n_rows") == [(1, 0, 149, 150)]
    assert got.first().classifiers == names
