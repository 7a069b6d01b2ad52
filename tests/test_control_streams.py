"""Streams judged by shared state, over several micro-batches, against their batch twins; replays and restarts."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tideline.operators import incremental, joins, temporal, windows
from tideline.streaming import control
from tideline.streaming.runner import stream_parquet


@pytest.fixture(scope="module")
def arrived(spark, data, tmp_path_factory):
    """(folder, rows): events in the order they arrive, in four files that become four micro-batches."""
    folder = str(tmp_path_factory.mktemp("arrived"))
    k = F.get_json_object("props", "$.k").cast("int")
    events = (spark.read.parquet(f"{data}/events.parquet").select("event_id", "user_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"), k.alias("k"))
              .withColumn("arrival", F.unix_micros("ts") + F.coalesce(F.col("k").cast("long"), F.lit(0).cast("long")) * 60_000_000 * 20))
    cuts = events.approxQuantile("arrival", [0.25, 0.5, 0.75], 0.0)
    bounds = [-(2**62), *[int(c) for c in cuts], 2**62]
    for n, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
        part = events.where((F.col("arrival") >= lo) & (F.col("arrival") < hi)).coalesce(1)
        part.write.mode("append").parquet(folder)
        for name in os.listdir(folder):  # files are taken in the order of their times
            if name.startswith("part-") and not os.path.exists(f"{folder}/.seen-{name}"):
                os.utime(f"{folder}/{name}", (1_000_000 + n, 1_000_000 + n))
                open(f"{folder}/.seen-{name}", "w").close()
    return folder, spark.read.parquet(folder)


def stream(spark, folder):
    return stream_parquet(spark, folder, files_per_batch=1)


@pytest.mark.parametrize("limit", [10**6, 60])
def test_late_rows_over_batches(spark, arrived, limit, tmp_path):
    folder, table = arrived
    got = control.late_rows(stream(spark, folder), "arrival", "ts", "30 minutes", rows_per_group=limit)
    assert got.select("batch").distinct().count() == 4
    twin = windows.late_rows(table, "arrival", "ts", "30 minutes")
    assert rows(got, "event_id", "watermark", "is_late") == rows(twin, "event_id", "watermark", "is_late")
    assert twin.where("is_late").count() > 20


def test_late_rows_have_an_output_of_their_own(spark, arrived, tmp_path):
    folder, table = arrived
    control.late_side_output(stream(spark, folder), "arrival", "ts", "30 minutes", str(tmp_path))
    routed = spark.read.parquet(f"{tmp_path}/routed")
    twin = windows.late_rows(table, "arrival", "ts", "30 minutes")
    for tag, late in (("late", True), ("main", False)):
        assert rows(routed.where(F.col("tag") == tag), "event_id") == rows(twin.where(F.col("is_late") == late), "event_id")


def test_a_replayed_batch_gives_the_same_rows(spark, arrived, tmp_path):
    """A batch run again after a failure reads the mark before it, not its own."""
    folder, table = arrived
    judge = lambda df, before: windows.late_rows(df, "arrival", "ts", "30 minutes", before_us=before)
    work = control._marking(str(tmp_path), F.unix_micros("ts"), judge)
    half = int(table.approxQuantile("arrival", [0.5], 0.0)[0])
    first, second = table.where(F.col("arrival") < half), table.where(F.col("arrival") >= half)
    once = [rows(work(first, 0)), rows(work(second, 1))]
    again = [rows(work(second, 1)), rows(work(first, 0)), rows(work(second, 1))]
    assert again == [once[1], once[0], once[1]]
    assert sorted(once[0] + once[1], key=repr) == rows(windows.late_rows(table, "arrival", "ts", "30 minutes"))
    # a batch number that was left out
    newest = table.agg(F.max(F.unix_micros("ts"))).first()[0]
    assert control._mark_before(table, str(tmp_path), 5) == newest and control._mark_before(table, str(tmp_path), 0) is None
    # a batch without rows passes the mark on
    assert work(table.where("false"), 2).count() == 0 and control._mark_before(table, str(tmp_path), 3) == newest


def test_punctuated_watermark_over_batches(spark, arrived):
    folder, table = arrived
    marker = F.col("event_type") == "signup"
    got = control.punctuated_watermark(stream(spark, folder), "arrival", "ts", marker)
    assert rows(got, "event_id", "watermark") == rows(windows.punctuated_watermark(table, "arrival", "ts", marker), "event_id", "watermark")


def test_control_streams_over_batches(spark, arrived, tmp_path):
    """Control rows count for data of their batch and later ones: fed in the order of event times, that is the batch result."""
    _, table = arrived
    folder = str(tmp_path / "ordered")
    times = [None, *table.approxQuantile("arrival", [0.3, 0.6], 0.0), None]
    for n, (lo, hi) in enumerate(zip(times, times[1:])):
        part = table.where((F.unix_micros("ts") >= (lo or 0)) & (F.unix_micros("ts") < (hi or 2**62))).coalesce(1)
        part.write.mode("append").parquet(folder)
    df = stream(spark, folder)
    parts = lambda x: (x.where("event_type <> 'signup'"), x.where("event_type = 'signup'"))
    got = control.control_match(*parts(df), "ts", "k", "k", tie="event_id", folder=str(tmp_path / "out"))
    twin = temporal.control_match(*parts(table), "ts", "k", "k", tie="event_id")
    assert rows(got, "event_id", "k") == rows(twin, "event_id", "k") and twin.count() > 0
    # a restart finds nothing new and changes nothing
    again = control.control_match(*parts(stream(spark, folder)), "ts", "k", "k", tie="event_id", folder=str(tmp_path / "out"))
    assert rows(again, "event_id", "k") == rows(twin, "event_id", "k")
    ask, tell = df.where("event_type = 'purchase'").select("event_id", "user_id"), df.where("value > 200").select("user_id", "event_type", "ts")
    got = control.first_value_enrich(ask, tell, "user_id", "event_type", "ts")
    known = {r.event_id: r.match for r in joins.first_value_enrich(table.where("event_type = 'purchase'").select("event_id", "user_id"),
                                                                 table.where("value > 200").select("user_id", "event_type", "ts"), "user_id", "event_type", "ts").collect()}
    # a value announced in a later batch is not known yet
    assert all(r.match in (known[r.event_id], "No match") for r in got.collect()) and got.where("match <> 'No match'").count() > 0


def test_order_board_takes_back_older_totals(spark, arrived):
    folder, table = arrived
    updates = control.order_board(stream(spark, folder), "ts", "event_type", "value")
    assert updates.select("batch").distinct().count() >= 4
    last = control.last_boards(updates)
    board = incremental.order_board(table, "ts", "event_type", "value", "1 day", "1 day")
    columns = ["window_start", "total", "rank", "event_type", "category_total"]
    assert rows(last, *columns) == rows(board, *columns)
