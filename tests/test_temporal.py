import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tideline.operators import joins, temporal, windows
from tideline.operators.incremental import incremental_window

T0 = dt.datetime(2024, 1, 1)
sec = lambda n: T0 + dt.timedelta(seconds=n)


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


@pytest.mark.parametrize("how,expected", [("left", 37), ("inner", 11)])
def test_retry_join_gives_up_after_the_last_probe(spark, how, expected):
    # facts at 2n seconds, dimension rows at 4n seconds, delay 5 s, 3 retries: matched up to n = 10
    facts = frame(spark, [(f"{n}-{n}", sec(2 * n)) for n in range(37)], "k string, t timestamp_ntz")
    dim = frame(spark, [(f"{n}-{n}", sec(4 * n), str(n)) for n in range(37)], "k string, a timestamp_ntz, v string")
    got = temporal.retry_lookup_join(facts, dim, "k", "t", "a", {"v": "v"}, "5 seconds", 3, how).collect()
    assert len(got) == expected
    assert sorted(int(r["v"]) for r in got if r["v"]) == list(range(11))
    assert {r["attempt"] for r in got if r["v"] == "10"} == {4} and {r["attempt"] for r in got if r["v"] == "0"} == {0}


@pytest.mark.parametrize("limit", [3, 10_000])
def test_retry_join_reads_the_version_in_force_at_the_probe(spark, limit):
    facts = frame(spark, [(1, "a", sec(0)), (2, "a", sec(100)), (3, None, sec(0)), (4, "b", sec(0))], "id int, k string, t timestamp_ntz")
    dim = frame(spark, [("a", sec(3), 1), ("a", sec(4), 2), ("a", sec(9), 3), ("b", sec(21), 9)], "k string, a timestamp_ntz, v int")
    got = temporal.retry_lookup_join(facts, dim, "k", "t", "a", {"v": "v"}, "5 seconds", 3, rows_per_group=limit)
    assert rows(got, "id", "attempt", "v") == sorted([(1, 1, 2), (2, 0, 3), (3, None, None), (4, None, None)], key=repr)


@pytest.mark.parametrize("limit", [4, 10_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_asof_join_against_a_loop(spark, limit, seed):
    rng = random.Random(seed)
    left = [(i, rng.choice([1, 1, 1, 2, None]), sec(rng.randrange(100))) for i in range(80)]
    right = [(i, rng.choice([1, 1, 1, 2, None]), sec(rng.randrange(100)), rng.choice([None, 5, 6])) for i in range(60)]
    ldf = frame(spark, left, "id int, k int, t timestamp_ntz")
    rdf = frame(spark, right, "rid int, k int, rt timestamp_ntz, v int")
    expected, keyless = [], []
    for i, k, t in left:
        mine = [r for r in right if k is not None and r[1] == k and r[2] <= t]
        best = max(mine, key=lambda r: (r[2], r[0]), default=(None,) * 4)
        expected.append((i, best[0], best[3]))
        best = max([r for r in right if r[2] <= t], key=lambda r: (r[2], r[0]), default=(None,) * 4)
        keyless.append((i, best[0] if best[1] is not None and best[1] == k else None))
    got = temporal.asof_join(ldf, rdf, ["k"], "t", "rt", {"rid": "rid", "v": "v"}, tie="rid", rows_per_group=limit)
    assert rows(got, "id", "rid", "v") == sorted(expected, key=repr)
    inner = temporal.asof_join(ldf, rdf, ["k"], "t", "rt", {"rid": "rid"}, "inner", tie="rid", rows_per_group=limit)
    assert rows(inner, "id", "rid") == sorted([e[:2] for e in expected if e[1] is not None], key=repr)
    latest = temporal.latest_row_join(ldf, rdf.where("k IS NOT NULL OR k IS NULL").withColumnRenamed("k", "rk"), "t", "rt",
                                      {"rid": "rid", "rk": "rk"}, F.col("k") == F.col("rk"), tie="rid", rows_per_group=limit)
    assert rows(latest, "id", "rid") == sorted(keyless, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("size,step", [(60, 10), (60, 25)])
def test_incremental_window_against_a_loop(spark, seed, size, step):
    rng = random.Random(seed)
    data = [(rng.choice(["a", "b"]), sec(rng.randrange(200)), rng.randrange(5), rng.randrange(100)) for _ in range(60)]
    df = frame(spark, data, "k string, t timestamp_ntz, u int, v int")
    expected = []
    for k in "ab":
        for start in range(0, 240, size):
            mine = [r for r in data if r[0] == k and sec(start) <= r[1] < sec(start + size)]
            fires = [min(start + i * step, start + size) for i in range(1, -(-size // step) + 1)]
            for fire in fires:
                seen = [r for r in mine if r[1] < sec(fire)]
                if seen:
                    expected.append((k, sec(start), sec(fire), len(seen), min(r[3] for r in seen), len({r[2] for r in seen})))
    got = incremental_window(df, "t", f"{size} seconds", f"{step} seconds", ["k"], sums={"n": F.count(F.lit(1))},
                             minimums={"lo": F.min("v")}, distinct={"d": "u"})
    assert rows(got, "k", "window_start", "fire_time", "n", "lo", "d") == sorted(expected, key=repr)


def test_sessions_touching_at_the_gap_are_one(spark):
    df = frame(spark, [("a", sec(0)), ("a", sec(10)), ("a", sec(21)), ("b", sec(5)), (None, sec(3)), ("a", sec(20))], "k string, t timestamp_ntz")
    got = windows.sessions(df, ["k"], "t", "10 seconds")
    assert rows(got, "k", "session_start", "session_end", "n") == sorted([
        ("a", sec(0), sec(31), 4), ("b", sec(5), sec(15), 1), (None, sec(3), sec(13), 1)], key=repr)
    split = frame(spark, [("a", sec(0)), ("a", sec(11))], "k string, t timestamp_ntz")
    assert windows.sessions(split, ["k"], "t", "10 seconds").count() == 2


def test_interval_join_bounds_are_inclusive(spark):
    left = frame(spark, [(1, "a", sec(0)), (2, "a", sec(50)), (3, None, sec(0))], "id int, k string, t timestamp_ntz")
    right = frame(spark, [("a", sec(0), 1), ("a", sec(10), 2), ("a", sec(11), 3), (None, sec(1), 4)], "k string, p timestamp_ntz, v int")
    got = joins.interval_join(left, right, ["k"], "t", "p", 0, "10 seconds", "left", ["id"])
    assert rows(got, "id", "v") == sorted([(1, 1), (1, 2), (2, None), (3, None)], key=repr)


@pytest.mark.parametrize("predicate", ["overlaps", "contains", "equals", "immediately_precedes", "immediately_succeeds"])
def test_period_join_against_a_loop(spark, predicate):
    rng = random.Random(7)
    period = lambda: (lambda a, n: (sec(a), sec(a + n)))(rng.randrange(50), rng.randrange(1, 30))
    left = [(i, rng.choice([1, 2]), *period()) for i in range(40)]
    right = [(i, rng.choice([1, 2]), *period()) for i in range(40)]
    test = {"overlaps": lambda a, b, c, d: a < d and c < b, "contains": lambda a, b, c, d: a <= c and d <= b,
            "equals": lambda a, b, c, d: a == c and b == d, "immediately_precedes": lambda a, b, c, d: b == c,
            "immediately_succeeds": lambda a, b, c, d: a == d}[predicate]
    expected = [(x[0], y[0]) for x in left for y in right if x[1] == y[1] and test(x[2], x[3], y[2], y[3])]
    got = joins.period_join(frame(spark, left, "id int, k int, a timestamp_ntz, b timestamp_ntz"),
                            frame(spark, right, "rid int, k int, c timestamp_ntz, d timestamp_ntz"),
                            ["k"], ("a", "b"), ("c", "d"), predicate, "7 seconds")
    assert rows(got, "id", "rid") == sorted(expected, key=repr)


def test_null_rules_of_subqueries(spark):
    left = frame(spark, [(1,), (2,), (None,)], "a int")
    some = frame(spark, [(1,), (5,)], "b int")
    holey = frame(spark, [(1,), (None,)], "b int")
    empty = some.where("false")
    assert rows(joins.not_in(left, some, "a", "b")) == [(2,)]
    assert rows(joins.not_in(left, holey, "a", "b")) == []
    assert len(rows(joins.not_in(left, empty, "a", "b"))) == 3
    assert rows(joins.compare_all(left, "a", "<=", some, "b")) == [(1,)]
    assert rows(joins.compare_all(left, "a", "<", holey, "b")) == []
    assert len(rows(joins.compare_all(left, "a", "<", empty, "b"))) == 3
    assert rows(joins.compare_any(left, "a", "<", holey, "b")) == []
    assert rows(joins.compare_any(left, "a", "<", some, "b")) == [(1,), (2,)]
    assert rows(joins.compare_any(left, "a", "=", some, "b")) == [(1,)]
    assert rows(joins.compare_any(left, "a", ">", empty, "b")) == []


def test_broadcast_join_beyond_its_limit_shuffles(spark, data):
    facts = spark.read.parquet(f"{data}/supplier.parquet").select("s_suppkey", F.col("s_nationkey").alias("k"))
    dim = spark.read.parquet(f"{data}/nation.parquet").withColumnRenamed("n_nationkey", "k")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    small = joins.broadcast_lookup_join(facts, dim, ["k"])
    large = joins.broadcast_lookup_join(facts, dim, ["k"], max_bytes=0)
    assert "BroadcastHashJoin" in plan(small) and "ShuffledHashJoin" in plan(large)
    assert rows(small) == rows(large)


def test_first_control_value_wins(spark):
    data = frame(spark, [(1, "x"), (2, "y")], "id int, k string")
    control = frame(spark, [("x", "late", sec(5)), ("x", "first", sec(1))], "k string, v string, t timestamp_ntz")
    assert rows(joins.first_value_enrich(data, control, "k", "v", "t"), "id", "match") == [(1, "first"), (2, "No match")]
