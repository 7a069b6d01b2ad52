"""The batching sink flushes at its row count before the interval, and at the interval without more rows."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from tideline.streaming.operators import flushing_sink
from tideline.streaming.runner import stream_parquet


def feed(spark, folder, first, n, statement="insert a"):
    df = spark.range(first, first + n).select(F.lit(statement).alias("statement"), F.col("id"), F.timestamp_seconds("id").alias("at"), (F.col("id") / 8).cast("decimal(10,3)").alias("v"),
                                              F.when(F.col("id") % 2 == 0, "x").alias("note"))
    df.coalesce(1).write.mode("append").parquet(folder)


def flushes(spark, out):
    if not glob.glob(f"{out}/data/batch=*/statement=*"):
        return {}
    rows = spark.read.parquet(f"{out}/data").groupBy("statement", "flush").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("id")).alias("ids")).collect()
    return {(r.statement, r.flush): list(r.ids) for r in rows}


def wait_for(check, seconds=60):
    deadline = time.time() + seconds
    while time.time() < deadline:
        if check():
            return True
        time.sleep(0.5)
    return False


def test_flush_at_the_row_count_before_the_interval(spark, tmp_path):
    """Rows of several micro-batches fill a flush; an hour's interval has not passed."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for first, n in ((0, 4), (4, 5), (9, 14)):
        feed(spark, source, first, n)
    feed(spark, source, 100, 3, "insert b")
    query = flushing_sink(stream_parquet(spark, source, files_per_batch=1), out, "statement", 10, "1 hour")
    try:
        assert wait_for(lambda: len(flushes(spark, out)) >= 2)
        got = flushes(spark, out)
    finally:
        query.stop()
    assert set(got) == {("insert a", 0), ("insert a", 1)} and all(len(x) == 10 for x in got.values())
    assert len(set(got[("insert a", 0)] + got[("insert a", 1)])) == 20


def test_flush_at_the_interval_after_a_restart(spark, tmp_path):
    """Three rows wait when the query stops; the timer of the checkpoint flushes them later, with their values as they were."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    feed(spark, source, 0, 3)
    query = flushing_sink(stream_parquet(spark, source), out, "statement", 10, "12 seconds")
    assert wait_for(lambda: any(p["numInputRows"] for p in query.recentProgress))
    query.stop()
    assert flushes(spark, out) == {}
    query = flushing_sink(stream_parquet(spark, source), out, "statement", 10, "12 seconds")
    feed(spark, source, 50, 1, "insert b")  # a restarted stream runs its first batch when there is something to read
    try:
        assert wait_for(lambda: ("insert a", 0) in flushes(spark, out))
    finally:
        query.stop()
    assert flushes(spark, out)[("insert a", 0)] == [0, 1, 2]
    row = spark.read.parquet(f"{out}/data").where("id = 1").first()
    assert (row.at.second, float(row.v), row.note) == (1, 0.125, None)
