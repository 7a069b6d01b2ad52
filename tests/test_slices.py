"""Sliced computations against plain loops, with hot keys, ties and nulls."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tideline.operators.joins import interval_join
from tideline.operators.ranking import ranks
from tideline.operators.windows import sessions
from tideline.plans.skew import salted_join
from tideline.plans.slices import Order, Running, running, shifted, split, trailing_range, trailing_sums

LIMITS = [15, 10_000]


def sample(seed, n=90):
    rng = random.Random(seed)
    # key 1 holds about two thirds of the rows; keys, times and values may be missing
    return [(i, rng.choice([1, 1, 1, 1, 2, 3, None]), rng.choice([None, *range(40)]), rng.choice([None, *range(9)])) for i in range(n)]


@pytest.fixture(scope="module", params=[1])
def table(request, spark):
    data = sample(request.param)
    return data, spark.createDataFrame(data, "id int, k int, t int, v int")


def ordered(data, keys=True):
    groups = {}
    for row in data:
        groups.setdefault(row[1] if keys else 0, []).append(row)
    return [sorted(g, key=lambda r: (r[2] is not None, r[2] or 0, r[0])) for g in groups.values()]


def naive_running(data, keys=True):
    out = []
    for group in ordered(data, keys):
        seen = []
        for row in group:
            before = [r[3] for r in seen if r[3] is not None]
            seen.append(row)
            upto = [r[3] for r in seen if r[3] is not None]
            less = [r for r in group if (r[2] is not None, r[2] or 0) < (row[2] is not None, row[2] or 0)]
            out.append((row[0], len(seen), sum(upto) if upto else None, sum(before) if before else None,
                        min(upto, default=None), max(upto, default=None), upto[-1] if upto else None,
                        len(less) + 1, len({r[2] for r in less}) + 1, len(group), sum(r[3] or 0 for r in group)))
    return sorted(out, key=repr)


def specs():
    return [Running("n", "count"), Running("s", "sum", F.col("v")), Running("before", "sum", F.col("v"), exclusive=True),
            Running("lo", "min", F.col("v")), Running("hi", "max", F.col("v")), Running("last", "last", F.col("v")),
            Running("all", "total_count"), Running("total", "total_sum", F.col("v"))]


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("keys", [["k"], []])
def test_running(table, limit, keys):
    data, df = table
    order = Order("t", ("id",))
    got = running(df, keys, order, specs(), rows_per_group=limit)
    ranks = running(got, keys, Order("t"), [Running("rank", "rank"), Running("dense", "dense_rank")], rows_per_group=limit)
    assert rows(ranks, "id", "n", "s", "before", "lo", "hi", "last", "rank", "dense", "all", "total") == naive_running(data, bool(keys))


def test_peers_across_slices(spark):
    """Runs of equal order values longer than a slice, NULLs among them."""
    values = [None] * 40 + [1] * 3 + [2] * 90 + [3, 4, 4, 5] + [6] * 50
    df = spark.createDataFrame([(i, 1, v) for i, v in enumerate(values)] + [(1000, 2, 7)], "id int, k int, t int")
    wanted = [Running("rank", "rank"), Running("dense", "dense_rank"), Running("upto", "upto")]
    for descending in (False, True):
        plain, cut = (running(df, ["k"], Order("t", descending=descending), wanted, rows_per_group=n) for n in (10_000, 15))
        assert rows(cut) == rows(plain) and cut.dtypes == plain.dtypes


@pytest.mark.parametrize("times", [
    [1] + [10 ** 15 + i for i in range(2999)],            # one wrong clock
    [5] * 2500 + list(range(500)),                        # a burst
    [None] * 3000,
    [2 ** (i % 60) for i in range(3000)]])                # a heavy tail
def test_slices_hold_about_equal_rows(spark, times):
    df = spark.createDataFrame(list(enumerate(times)), "id long, t long").withColumn("k", F.lit(1))
    parts = split(df, ["k"], Order("t"), 100)
    sizes = [r["count"] for r in parts.df.groupBy("__slice").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 400 and len(sizes) >= 15


def test_both_plans_have_the_same_types_and_nulls(table):
    _, df = table
    df = df.withColumn("d", F.col("v").cast("decimal(18,2)")).where("v IS NULL OR k = 2 OR k = 1")
    order = Order("t", ("id",))
    wanted = [*specs(), Running("dec", "sum", F.col("d")), Running("rank", "rank"), Running("dense", "dense_rank"), Running("upto", "upto")]
    for fn in (lambda n: running(df, ["k"], order, wanted, rows_per_group=n),
               lambda n: trailing_sums(df, ["k"], order, {"s": F.col("v"), "dec": F.col("d")}, 1, rows_per_group=n),
               lambda n: shifted(df, ["k"], order, {"a": ("v", 1), "b": ("d", -3)}, rows_per_group=n)):
        small, cut = fn(10_000), fn(12)
        assert small.dtypes == cut.dtypes and rows(small) == rows(cut)


def test_sliced_plan_is_short(table):
    _, df = table
    plan = ranks(df, ["k"], Order("t", ("id",)), 3, rows_per_group=15)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 4 and plan.count("Exchange hash") <= 6


def test_split_finds_hot_groups(table):
    _, df = table
    assert not split(df, ["k"], Order("t"), 10_000).sliced
    parts = split(df, ["k"], Order("t"), 20)
    assert parts.sliced
    assert parts.df.where("k = 1").select("__slice").distinct().count() > 2
    assert parts.df.where("k = 3").select("__slice").distinct().count() == 1


@pytest.mark.parametrize("limit", LIMITS)
def test_shifted(table, limit):
    data, df = table
    expected = []
    for group in ordered(data):
        for i, row in enumerate(group):
            expected.append((row[0], group[i - 2][3] if i >= 2 else None, group[i + 1][3] if i + 1 < len(group) else None))
    got = shifted(df, ["k"], Order("t", ("id",)), {"before": ("v", -2), "after": ("v", 1)}, rows_per_group=limit)
    assert rows(got, "id", "before", "after") == sorted(expected, key=repr)


@pytest.mark.parametrize("limit", LIMITS)
def test_trailing_sums(table, limit):
    data, df = table
    expected = []
    for group in ordered(data):
        for i, row in enumerate(group):
            frame = group[max(0, i - 3):i + 1]
            expected.append((row[0], sum(r[3] or 0 for r in frame), len(frame)))
    got = trailing_sums(df, ["k"], Order("t", ("id",)), {"s": F.coalesce("v", F.lit(0))}, 3, rows_per_group=limit)
    assert rows(got, "id", "s", "__frame_rows") == sorted(expected, key=repr)


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("span", [5])
def test_trailing_range(table, limit, span):
    data, df = table
    known = [r for r in data if r[2] is not None]
    expected = [(r[0], sum(1 for o in known if o[1] == r[1] and r[2] - span <= o[2] <= r[2])) for r in known]
    got = trailing_range(df.where("t IS NOT NULL"), ["k"], Order("t"), {"n": ("count", None)}, span, rows_per_group=limit)
    assert rows(got, "id", "n") == sorted(expected, key=repr)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("limit", [4])
def test_salted_join(table, spark, how, limit):
    _, df = table
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (9, "z")], "k int, name string")
    got, plain = salted_join(df, dim, ["k"], how, rows_per_group=limit), df.join(dim, "k", how)
    assert set(got.columns) == set(plain.columns)
    assert rows(got, *plain.columns) == rows(plain)


def test_sessions_without_a_key_are_cut(spark):
    df = spark.range(400).select(F.timestamp_seconds(F.col("id") * 7 + F.floor(F.col("id") / 9) * 60).alias("ts"), F.col("id").alias("v"))
    plain, cut = (sessions(df, [], "ts", "20 seconds", {"total": F.sum("v")}, rows_per_group=n) for n in (10_000, 20))
    assert rows(cut) == rows(plain) and len(rows(plain)) == 45


def test_interval_join_left_keeps_lonely_rows(spark):
    left = spark.createDataFrame([(1, "a", 10), (2, "a", 1000), (3, None, 10), (4, "a", None)], "id int, k string, t long").withColumn("t", F.timestamp_seconds("t"))
    right = spark.createDataFrame([("a", 11, 1), ("a", 12, 2), ("a", 14, 3)], "k string, u long, v int").withColumn("u", F.timestamp_seconds("u"))
    got = interval_join(left, right, ["k"], "t", "u", 0, "2 seconds", "left", ["id"])
    assert rows(got, "id", "v") == sorted([(1, 1), (1, 2), (2, None), (3, None), (4, None)], key=repr)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


def frame_values():
    return {"n": ("count", None), "known": ("count", F.col("v")), "s": ("sum", F.col("v")), "dec": ("sum", F.col("d")), "lo": ("min", F.col("v")),
            "hi": ("max", F.col("x")), "mean": ("avg", F.col("v")), "word": ("max", F.col("w"))}


@pytest.mark.parametrize("span", [0, 3, 25, 10_000])
@pytest.mark.parametrize("descending", [False, True])
def test_range_frames_over_many_blocks(spark, span, descending):
    """Short and full spans, runs of peers longer than a block, NULL places and keys, keys that are not hot."""
    rng = random.Random(span)
    data = [(i, rng.choice([1] * 20 + [2, 3, None, None, None]), rng.choice([None, 7, 7, *range(0, 400, 3)]), rng.choice([None, *range(9)])) for i in range(700)]
    df = (spark.createDataFrame(data, "id int, k int, t int, v int").withColumn("d", F.col("v").cast("decimal(18,2)"))
          .withColumn("x", F.col("v") / 4).withColumn("w", F.concat(F.lit("w"), "v")))
    order = Order("t", descending=descending)
    plain = trailing_range(df, ["k"], order, frame_values(), span)
    cut = trailing_range(df, ["k"], order, frame_values(), span, rows_per_group=40, block=8)
    assert cut.dtypes == plain.dtypes and rows(cut) == rows(plain)
    keyless = trailing_range(df, [], order, frame_values(), span, rows_per_group=40, block=8)
    assert rows(keyless) == rows(trailing_range(df, [], order, frame_values(), span))


def test_full_span_frame_copies_a_row_three_times(spark, monkeypatch):
    """Whatever the span: itself, where its frame begins, and where it ends. Blocks between are read from few nodes."""
    from tideline.plans import slices
    written = {}

    def counting(df, label, real=slices.staged):
        out = real(df, label)
        written[label] = out.count()
        return out

    monkeypatch.setattr(slices, "staged", counting)
    df = spark.range(5000).select("id", F.lit(1).alias("k"), F.col("id").alias("t"))
    got = trailing_range(df, ["k"], Order("t"), {"n": ("count", None), "lo": ("min", F.col("t"))}, 10**9, rows_per_group=200, block=16)
    assert got.where("n <> t + 1 OR lo <> 0").count() == 0 and got.count() == 5000
    assert written["frames"] == 3 * 5000


def test_slices_do_not_gather_samples(spark):
    """No array of cuts, and rows that are all alike still fill many slices."""
    df = spark.range(4000).select(F.lit(1).alias("k"), F.lit(7).alias("t"), F.lit("x").alias("v"))
    parts = split(df, ["k"], Order("t", ("v",)), 200)
    sizes = [r["count"] for r in parts.df.groupBy("__slice").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 600
    plan = parts.df._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "Join" not in plan
