"""Streams fed in time slices against their batch twins, restarts, routing, retention."""

import datetime as dt
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tideline.functions import multisets
from tideline.operators import temporal
from tideline.operators.incremental import incremental_window
from tideline.reports.aggregates import path_inputs
from tideline.operators.paths import purchase_paths
from tideline.sources import sinks, topics
from tideline.sources.delimited import TAXI_TRIP, USER_BEHAVIOR, stream_delimited
from tideline.streaming import operators as streams
from tideline.streaming.runner import append_to_table, drain, each_batch, latest_update, run_with_restarts, stream_parquet

END = dt.datetime(2030, 1, 1)


@pytest.fixture(scope="module")
def sliced(spark, data, tmp_path_factory):
    """The events in three time slices, one file each, and a closing row that moves the watermark past all."""
    folder = str(tmp_path_factory.mktemp("slices"))
    events = spark.read.parquet(f"{data}/events.parquet")
    for i in range(3):
        events.where(f"dayofmonth(ts) BETWEEN {i * 10 + 1} AND {i * 10 + 10}").coalesce(1).write.parquet(f"{folder}/{i}")
    tail = spark.createDataFrame([(-1, END, -1, "closing", 0.0, '{"k": 0}')], events.schema)
    tail.coalesce(1).write.parquet(f"{folder}/9")
    return folder, events


def stream(spark, folder, delay="1 hour"):
    return stream_parquet(spark, f"{folder}/*/*.parquet", "ts", delay, files_per_batch=1)


def test_window_twins(spark, sliced):
    folder, events = sliced
    got = append_to_table(streams.windowed_counts(stream(spark, folder), "ts", "1 day", ["event_type"]), "t")
    batch = events.groupBy(F.window(F.col("ts").cast("timestamp"), "1 day").alias("w"), "event_type").count().select("w.start", "event_type", "count")
    assert rows(got, "window_start", "event_type", "n") == rows(batch)


def test_retry_join_twin_over_slices(spark, sliced):
    folder, events = sliced
    src = stream(spark, folder, "1 hour")
    got = append_to_table(streams.versioned_lookup(
        src.where("event_type IN ('click', 'closing')"), src.where("event_type IN ('signup', 'closing')"), "user_id", "ts", "event_id", "ts", "event_id",
        F.lit(""), F.col("value"), delay="6 hours", probes=4, salts=3), "r")
    batch = temporal.retry_lookup_join(
        events.where("event_type = 'click'").select("event_id", "user_id", "ts"),
        events.where("event_type = 'signup'").select("user_id", F.col("ts").alias("a"), "value", F.col("event_id").alias("v")),
        "user_id", "ts", "a", {"value": "value"}, "6 hours", 3, tie="v")
    mine = got.where("id >= 0").select(F.col("id").alias("event_id"), "attempt", F.col("version").cast("double").alias("value"))
    assert rows(mine) == rows(batch.select("event_id", F.col("attempt").cast("int").alias("attempt"), "value"))


def test_incremental_twin_over_slices(spark, sliced):
    folder, events = sliced
    got = append_to_table(streams.incremental_window(stream(spark, folder), "ts", "1 day", "5 hours", "event_type", "value"), "i")
    batch = incremental_window(events, "ts", "1 day", "5 hours", ["event_type"], sums={"n": F.count(F.lit(1))})
    mine = got.where("event_type <> 'closing'").select("event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                                                       F.col("fire_time").cast("timestamp_ntz").alias("fire_time"), "n")
    assert rows(mine) == rows(batch, "event_type", "window_start", "fire_time", "n")


def test_purchase_path_twin_over_slices(spark, sliced):
    folder, events = sliced
    user_events, config = path_inputs(events)
    src, _ = path_inputs(stream_parquet(spark, f"{folder}/*/*.parquet", "ts", None, 1))
    got = streams.purchase_paths(src.where("event_type <> 'closing'").withWatermark("ts", "1 hour"), lambda: config)
    names = ["user_id", "channel", "purchase_time", "purchase_path_length"]
    mine, batch = rows(got, *names), rows(purchase_paths(user_events, config), *names)
    # the closing row has no user event type of its own, it counts as a purchase of user -1 and stays below the limit
    assert [r for r in mine if r[0] >= 0] == batch


def test_count_windows_over_slices(spark, sliced):
    folder, events = sliced
    got = append_to_table(streams.count_windows(stream(spark, folder), "user_id", "event_id", "value", 7), "c")
    sizes = {r["user_id"]: r["count"] // 7 for r in events.groupBy("user_id").count().collect()}
    assert {r["user_id"]: r["count"] for r in got.groupBy("user_id").count().collect()} == {u: n for u, n in sizes.items() if n}


@pytest.mark.parametrize("size, slide", [(20, 5), (7, 3), (4, 6), (1, 1)])
def test_sliding_count_windows_over_slices(spark, sliced, size, slide):
    """Windows reach over micro-batches; sizes that the slide does not divide, and slides longer than the window."""
    folder, events = sliced
    got = append_to_table(streams.sliding_count_windows(stream(spark, folder), "user_id", "event_id", "value", size, slide), "s")
    values = {}
    # the order of arrival: slice by slice, inside a slice by id
    for r in events.selectExpr("user_id", "CAST(round(value * 100) AS long) AS cents", "(dayofmonth(ts) - 1) div 10 AS part", "event_id").where(
            "part < 3").orderBy("part", "event_id").collect():
        values.setdefault(r.user_id, []).append(r.cents)
    expected = sorted((u, at, min(at, size), sum(v[max(0, at - size):at])) for u, v in values.items() for at in range(slide, len(v) + 1, slide))
    mine = sorted((r.user_id, r.arrivals, r.rows_in_window, round(r.total * 100)) for r in got.where("user_id >= 0").collect())
    assert mine == expected


def test_incremental_distinct_twin_over_slices(spark, sliced):
    folder, events = sliced
    got = streams.incremental_distinct(stream(spark, folder), "ts", "1 day", "5 hours", "event_type", "user_id", salts=3)
    batch = incremental_window(events, "ts", "1 day", "5 hours", ["event_type"], sums={"n": F.count(F.lit(1))}, distinct={"distinct": "user_id"})
    mine = got.where("event_type <> 'closing'").select("event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                                                       F.col("fire_time").cast("timestamp_ntz").alias("fire_time"), "n", "distinct")
    assert rows(mine) == rows(batch, "event_type", "window_start", "fire_time", "n", "distinct")


def test_incremental_distinct_moves_a_value_to_an_earlier_interval(spark, tmp_path):
    """A value seen at 04:30 first, then out of order at 01:10, counts from the first interval on; NULLs count as rows only."""
    t = lambda h, m: dt.datetime(2024, 5, 1, h, m)
    parts = [[("a", 7, t(4, 30)), ("a", 8, t(2, 0))], [("a", 7, t(1, 10)), ("a", None, t(3, 30))], [("a", 9, END)]]
    for i, part in enumerate(parts):
        path = f"{tmp_path}/{i}"
        spark.createDataFrame(part, "k string, v long, ts timestamp_ntz").coalesce(1).write.parquet(path)
        for f in (tmp_path / str(i)).glob("*.parquet"):
            os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    src = stream_parquet(spark, f"{tmp_path}/*/*.parquet", "ts", "6 hours", files_per_batch=1)
    got = streams.incremental_distinct(src, "ts", "6 hours", "2 hours", "k", "v", salts=2).where("year(window_start) = 2024")
    assert [r[1:] for r in rows(got, "fire_time", "n", "distinct")] == [(1, 1), (3, 2), (4, 2)]


def test_early_results_converge(spark, sliced):
    folder, events = sliced
    running = streams.early_results(stream(spark, folder), "ts", "30 days", ["event_type"], [F.count(F.lit(1)).alias("n")])
    updates = each_batch(running, "e", lambda batch, _: batch, mode="update")
    assert updates.select("batch").distinct().count() > 2
    final = latest_update(updates, ["window_start", "event_type"]).groupBy("event_type").agg(F.sum("n").alias("n"))
    assert rows(final.where("event_type <> 'closing'")) == rows(events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")))


def test_restart_resumes_exactly_once(spark, sliced, tmp_path):
    folder, events = sliced
    target, failures = str(tmp_path / "out"), []

    def start():
        def write(batch, number):
            if number == 2 and not failures:
                failures.append(number)
                raise RuntimeError("lost on purpose")
            batch.write.mode("overwrite").parquet(f"{target}/batch={number}")
        agg = streams.windowed_counts(stream(spark, folder), "ts", "1 day", ["event_type"])
        return (agg.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "cp"))
                .trigger(availableNow=True).start())

    assert run_with_restarts(start, attempts=3, pause_seconds=0.1) == 1 and failures == [2]
    got = spark.read.parquet(target)
    assert rows(got.groupBy("event_type").agg(F.sum("n").alias("n"))) == rows(events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")))


def test_routed_stream_and_statement_files(spark, sliced, tmp_path):
    folder, events = sliced
    src = stream(spark, folder).select("event_id", "event_type")
    streams.route_stream(src, str(tmp_path / "r"), {"view": F.expr("event_type = 'view'")})
    got = spark.read.parquet(str(tmp_path / "r" / "data")).groupBy("tag").count()
    assert dict(rows(got))["view"] == events.where("event_type = 'view'").count()
    streams.statement_sink(src, str(tmp_path / "s"), "event_type", 10)
    sizes = spark.read.parquet(str(tmp_path / "s" / "data")).groupBy(F.col("_metadata.file_path")).count()
    assert sizes.agg(F.max("count")).first()[0] <= 10


def test_dimension_is_read_again_after_its_time_to_live(spark):
    clock, reads = [0.0], []

    def read():
        reads.append(len(reads))
        return spark.createDataFrame([(1, len(reads))], "k int, v int")

    table = streams.RefreshedTable(read, 10, lambda: clock[0])
    assert rows(table()) == [(1, 1)]
    clock[0] = 9
    assert rows(table()) == [(1, 1)]
    clock[0] = 10
    assert rows(table()) == [(1, 2)] and len(reads) == 2


def test_first_seen_with_retention(spark, sliced, tmp_path):
    folder, events = sliced
    got = streams.first_seen(stream_parquet(spark, f"{folder}/*/*.parquet", "ts", None, 1), ["event_type"], 3_600_000)
    query = (got.writeStream.format("parquet").option("path", str(tmp_path / "d")).option("checkpointLocation", str(tmp_path / "c"))
             .trigger(processingTime="1 second").start())
    # with processing-time state the query keeps running empty batches, so wait for the rows instead
    try:
        for _ in range(240):
            if sum(p.numInputRows for p in query.recentProgress) > events.count():
                break
            time.sleep(0.5)
    finally:
        query.stop()
    kinds = rows(spark.read.parquet(str(tmp_path / "d")).select("event_type"))
    assert kinds == sorted([("closing",), ("click",), ("error",), ("purchase",), ("signup",), ("view",)])


def test_processing_time_windows(spark, sliced):
    folder, events = sliced
    stamped = stream_parquet(spark, f"{folder}/*/*.parquet", "ts", None, 1).withColumn("arrived", F.current_timestamp())
    got = each_batch(streams.early_results(stamped, "arrived", "1 hour", [], [F.count(F.lit(1)).alias("n")]), "p", lambda b, _: b, "update")
    assert latest_update(got, ["window_start"]).agg(F.sum("n")).first()[0] == events.count() + 1


def test_text_sources(spark, tmp_path):
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "a.csv").write_text("1,2,3,pv,1511658000\n4,5,6,buy,1511658001\n")
    got = append_to_table(stream_delimited(spark, str(tmp_path / "csv"), USER_BEHAVIOR), "csv")
    assert rows(got) == [(1, 2, 3, "pv", 1511658000), (4, 5, 6, "buy", 1511658001)]
    assert len(spark.createDataFrame([], TAXI_TRIP).columns) == 11
    (tmp_path / "topic").mkdir()
    (tmp_path / "topic" / "a.txt").write_text('{"userId":"u","channel":"APP","eventType":"PURCHASE","eventTime":5,"data":{"productId":1,"price":2.5,"amount":3}}\n')
    got = append_to_table(topics.stream_topic(spark, topics.USER_EVENT, str(tmp_path / "topic")), "topic")
    assert rows(got.select("userId", "data.price")) == [("u", 2.5)]


def test_console_sink_and_range_source(spark, sliced, tmp_path, capfd):
    folder, _ = sliced
    drain(stream(spark, folder).select("event_id").writeStream.format("console"), str(tmp_path / "cp"))
    assert rows(spark.range(2, 5)) == [(2,), (3,), (4,)]


def test_insert_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    sinks.insert_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "v int, c string"), path, ["c"])
    sinks.insert_partitions(spark.createDataFrame([(3,)], "v int"), path, ["c"], static={"c": "a"}, overwrite=True)
    assert rows(spark.read.parquet(path).select("v", "c")) == [(2, "b"), (3, "a")]


def test_operators_run_until_stopped(spark, sliced, tmp_path):
    """A trigger of one second over three file slices, through a failure, by the public operators."""
    folder, events = sliced
    failures = []

    def lookup():
        if len(failures) == 0:
            failures.append(1)
            raise RuntimeError("lost on purpose")
        return spark.createDataFrame([("view", 1)], "event_type string, known int")

    target = str(tmp_path / "m")
    source = lambda: stream_parquet(spark, f"{folder}/*/*.parquet", "ts", None, 1).select("event_id", "event_type")
    query = None

    def begin():
        nonlocal query
        query = streams.mini_batch_lookup(source(), lookup, ["event_type"], folder=target, every="1 second")
        query.processAllAvailable()
        query.stop()
        return query

    assert run_with_restarts(begin, attempts=2, pause_seconds=0.1) == 1
    got = spark.read.parquet(f"{target}/data")
    assert got.count() == got.select("event_id").distinct().count() >= events.count()
    assert got.where("event_type = 'view' and known is null").isEmpty()
    sink = streams.statement_sink(source(), str(tmp_path / "s"), "event_type", 10, every="1 second")
    sink.processAllAvailable()
    assert sink.isActive
    sink.stop()
    assert spark.read.parquet(str(tmp_path / "s" / "data")).select("event_id").distinct().count() >= events.count()


def in_slices(spark, tmp_path, parts, schema):
    """A stream of one file per micro-batch."""
    for i, part in enumerate(parts):
        path = tmp_path / f"in{i}"
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(path))
        for f in path.glob("*.parquet"):
            os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    return stream_parquet(spark, f"{tmp_path}/in*/*.parquet", "ts", "1 hour", files_per_batch=1)


def random_events(kinds, n=600, users=40):
    rng = random.Random(11)
    made = [(i, dt.datetime(2024, 5, 1) + dt.timedelta(minutes=rng.randrange(3 * 24 * 60)),
             rng.choice([None, -3, 2 ** 53 + 1, *range(users)]), rng.choice(kinds)) for i in range(n)]
    parts = [[e for e in made if e[1].day == day] for day in (1, 2, 3)]
    return made, [*parts, [(-1, END, -1, kinds[0])]]


def counted(cls, folder):
    """``cls`` leaving a file per call of its timer."""
    class Counted(cls):
        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            import pathlib
            import uuid
            pathlib.Path(folder, uuid.uuid4().hex).touch()
            yield from super().handleExpiredTimer(key, timerValues, expiredTimerInfo)
    return Counted


def test_purchase_paths_by_state_groups(spark, tmp_path, monkeypatch):
    """A timer per group and micro-batch, not per user and reading of the batch; null users, ids beyond doubles, paths over slices."""
    (tmp_path / "calls").mkdir()
    monkeypatch.setattr(streams, "PathCollector", counted(streams.PathCollector, str(tmp_path / "calls")))
    made, parts = random_events(["VIEW_PRODUCT", "ADD_TO_CART", "PURCHASE"])
    src = in_slices(spark, tmp_path, parts, "event_id long, ts timestamp_ntz, user_id long, event_type string").withColumn("channel", F.lit("WEB"))
    config = spark.createDataFrame([], "channel string, ts timestamp_ntz, event_id long, history_purchase_times int, max_purchase_path_length int")
    got = streams.purchase_paths(src, lambda: config, groups=4).withColumn("counts", multisets.as_text("event_type_counts"))
    expected, open_ = [], {}
    for _, ts, user, kind in sorted(made, key=lambda e: (e[1], e[0])):
        path = open_.setdefault(user, [])
        path.append(kind)
        if kind == "PURCHASE":
            if len(path) > 3:
                expected.append((user, ts, len(path), ",".join(f"{k}:{path.count(k)}" for k in sorted(set(path)))))
            del open_[user]
    assert rows(got, "user_id", "purchase_time", "purchase_path_length", "counts") == sorted(expected, key=repr)
    assert 4 <= len(os.listdir(tmp_path / "calls")) <= 4 * 5


def test_retry_lookup_by_state_groups(spark, tmp_path, monkeypatch):
    """A timer per group and micro-batch, not per key; null keys meet, keys beyond doubles keep their digits."""
    (tmp_path / "calls").mkdir()
    monkeypatch.setattr(streams, "VersionedLookup", counted(streams.VersionedLookup, str(tmp_path / "calls")))
    made, parts = random_events(["fact", "version"])
    src = in_slices(spark, tmp_path, parts, "event_id long, ts timestamp_ntz, user_id long, event_type string")
    got = append_to_table(streams.versioned_lookup(
        src.where("event_type = 'fact'"), src.where("event_type = 'version'"), "user_id", "ts", "event_id", "ts", "event_id",
        F.lit("p"), F.col("event_id"), delay="6 hours", probes=2, salts=2, groups=4), "r")
    expected = []
    for rid, ts, user, kind in made:
        if kind == "fact":
            known = sorted((e[1], e[0]) for e in made if e[2] == user and e[3] == "version")
            tries = [(n, [v for v in known if v[0] <= ts + n * dt.timedelta(hours=6)]) for n in range(3)]
            hit = next(((n, v[-1][1]) for n, v in tries if v), (None, None))
            expected.append((user, rid, "p", None if hit[1] is None else str(hit[1]), hit[0]))
    assert rows(got.where("id >= 0"), "user_id", "id", "payload", "version", "attempt") == sorted(expected, key=repr)
    assert 8 <= len(os.listdir(tmp_path / "calls")) <= 8 * 5
