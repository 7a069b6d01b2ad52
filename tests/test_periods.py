"""Period joins by a tree over cells: every pair once, few rows per period whatever its length."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tideline.operators.joins import period_join, period_predicate, tree_nodes


def periods(seed, n, names):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        start = rng.choice([rng.randrange(-3000, 3000), rng.randrange(-40, 40) * 60, None if rng.random() < 0.1 else 0])
        length = rng.choice([0, 1, 59, 60, 61, 3600, 100_000, 3_000_000])
        out.append((i, rng.choice(["x", "y", None]), start, None if start is None else start + length))
    return out, f"{names[0]} int, k string, {names[1]} long, {names[2]} long"


@pytest.fixture(scope="module")
def tables(spark):
    seconds = lambda df, cols: df.select(*[F.timestamp_seconds(c).alias(c) if c in cols else c for c in df.columns])
    left, right = periods(1, 70, ("i", "a", "b")), periods(2, 60, ("j", "c", "d"))
    return left[0], right[0], seconds(spark.createDataFrame(*left), "ab"), seconds(spark.createDataFrame(*right), "cd")


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("predicate", ["overlaps", "contains"])
@pytest.mark.parametrize("cell", ["1 minute", "1 second", "1 day"])
def test_against_all_pairs(tables, keys, predicate, cell):
    left, right, df, other = tables
    test = {"overlaps": lambda a, b, c, d: a < d and c < b, "contains": lambda a, b, c, d: a <= c and d <= b}[predicate]
    expected = [(i, j) for i, k, a, b in left for j, m, c, d in right if a is not None and c is not None and a < b and c < d
                and (not keys or k is not None and k == m) and test(a, b, c, d)]
    other = other if keys else other.withColumnRenamed("k", "m")
    got = period_join(df, other, keys, ("a", "b"), ("c", "d"), predicate, cell)
    assert rows(got, "i", "j") == sorted(expected, key=repr) and len(expected) > 20


def test_a_period_of_any_length_has_few_rows(spark):
    """Ten years of hours: 87,600 cells in at most 34 nodes, which together are exactly those cells."""
    df = spark.createDataFrame([(0, 87_599), (1, 87_600), (-50_000, 37_600), (5, 5), (-1, 0), (-8, -1)], "f long, l long")
    got = df.select("f", "l", F.explode(tree_nodes(F.col("f"), F.col("l"), 17)).alias("n")).select("f", "l", "n.*").collect()
    for f, l in {(r.f, r.l) for r in got}:
        nodes = [r for r in got if (r.f, r.l) == (f, l)]
        cells = sorted(c for r in nodes for c in range(r.number << r.level, (r.number + 1) << r.level))
        assert cells == list(range(f, l + 1)) and len(nodes) <= 2 * max(1, (l - f + 1).bit_length())


def test_empty_sides(tables):
    _, _, df, other = tables
    assert period_join(df.where("false"), other, ["k"], ("a", "b"), ("c", "d")).count() == 0
    assert period_join(df, other.where("false"), ["k"], ("a", "b"), ("c", "d"), "contains").count() == 0
    assert period_predicate("precedes", "a", "b", "c", "d") is not None
