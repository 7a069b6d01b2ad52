"""Streams whose rows are judged by something all of them share: a watermark of their own, control rows, a board.

What is shared is a small versioned table beside the results, written per micro-batch under the batch's number. A batch
that is replayed after a failure reads the versions before its own and writes its own again, so results are the same.
Inside a batch the batch operators run, sliced where it is large; no row goes through one task's state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.utils import AnalysisException

from ..operators import joins, temporal, windows
from ..plans.durations import at
from ..plans.skew import ROWS_PER_GROUP
from ..plans.staging import staged
from ..session import fresh_dir
from ..sources.sinks import write_routed
from .runner import each_batch


def _mark_before(batch: DataFrame, folder: str, number: int) -> int | None:
    """The newest time of all batches before this one, in microseconds."""
    marks = batch.sparkSession.read.schema("mark long")
    try:
        rows = marks.parquet(f"{folder}/marks/batch={number - 1}").collect() if number > 0 else []
    except AnalysisException:  # a number was left out: look at all that are there
        rows = batch.sparkSession.read.schema("mark long, batch long").parquet(f"{folder}/marks").where(F.col("batch") < number).agg(F.max("mark").alias("mark")).collect()
    return rows[0]["mark"] if rows else None


def _marking(folder: str, newest: Column, judge: Callable[[DataFrame, int | None], DataFrame]) -> Callable[[DataFrame, int], DataFrame]:
    """Work of a micro-batch: judge its rows by the mark before them and leave the mark after them."""
    def work(batch: DataFrame, number: int) -> DataFrame:
        if number < 0:
            return judge(batch, None)
        # read once: the batch is judged and its newest time is kept
        rows, before = staged(batch, "arrived"), _mark_before(batch, folder, number)
        rows.agg(F.greatest(F.max(newest), F.lit(before).cast("long")).alias("mark")).write.mode("overwrite").parquet(f"{folder}/marks/batch={number}")
        return judge(rows, before)
    return work


def late_rows(df: DataFrame, arrival: str, time: str, delay: str, label: str = "late-rows", folder: str | None = None,
              every: str | None = None, rows_per_group: int = ROWS_PER_GROUP):
    """windows.late_rows of a stream: every row with the watermark in force before it in arrival order. The watermark is the
    stream's own, so rows that Spark's would drop are kept and told apart. Arrival numbers grow from batch to batch."""
    folder = folder or fresh_dir(df.sparkSession, label)
    judge = lambda rows, before: windows.late_rows(rows, arrival, time, delay, rows_per_group, before)
    return each_batch(df, label, _marking(folder, at(time), judge), folder=folder, every=every)


def late_side_output(df: DataFrame, arrival: str, time: str, delay: str, folder: str, every: str | None = None,
                     rows_per_group: int = ROWS_PER_GROUP):
    """Two-way writer: each batch once, its rows in time under ``routed/batch=N/tag=main`` and its late rows under ``tag=late``.
    Returns the rows judged (drained), or with ``every`` the running query."""
    def judge_and_route(rows: DataFrame, before: int | None) -> DataFrame:
        return windows.late_rows(rows, arrival, time, delay, rows_per_group, before)

    inner = _marking(folder, at(time), judge_and_route)

    def work(batch: DataFrame, number: int) -> DataFrame:
        judged = inner(batch, number)
        if number >= 0:
            judged = staged(judged, "judged")
            write_routed(judged, f"{folder}/routed/batch={number}", {"late": F.col("is_late"), "main": ~F.col("is_late")}, mode="overwrite")
        return judged

    return each_batch(df, "late-side", work, folder=folder, every=every)


def punctuated_watermark(df: DataFrame, arrival: str, time: str, is_marker: Column, label: str = "punctuated", folder: str | None = None,
                         every: str | None = None, rows_per_group: int = ROWS_PER_GROUP):
    """windows.punctuated_watermark of a stream: only marker rows move the watermark. Arrival numbers grow from batch to batch."""
    folder = folder or fresh_dir(df.sparkSession, label)
    judge = lambda rows, before: windows.punctuated_watermark(rows, arrival, time, is_marker, rows_per_group, before)
    return each_batch(df, label, _marking(folder, F.when(is_marker, at(time)), judge), folder=folder, every=every)


def _with_control(data: DataFrame, control: DataFrame, label: str, work: Callable[[DataFrame, DataFrame], DataFrame], folder: str | None, every: str | None):
    """Both inputs in one stream. A batch first adds its control rows to the versioned control table, then its data rows
    meet all control rows known by then: a control row counts for data of its own batch and of later ones."""
    folder = folder or fresh_dir(data.sparkSession, label)
    both = (data.select(F.struct(*data.columns).alias("__data"), F.lit(None).cast(control.schema).alias("__control"))
            .unionByName(control.select(F.lit(None).cast(data.schema).alias("__data"), F.struct(*control.columns).alias("__control"))))

    def run(batch: DataFrame, number: int) -> DataFrame:
        if number < 0:
            return work(batch.where("__data IS NOT NULL").select("__data.*"), batch.where("__control IS NOT NULL").select("__control.*"))
        rows = staged(batch, "arrived")
        rows.where("__control IS NOT NULL").select("__control.*").write.mode("overwrite").parquet(f"{folder}/control/batch={number}")
        known = batch.sparkSession.read.schema(control.schema.add("batch", "long")).parquet(f"{folder}/control").where(F.col("batch") <= number).drop("batch")
        return work(rows.where("__data IS NOT NULL").select("__data.*"), known)

    return each_batch(both, label, run, folder=folder, every=every)


def control_match(data: DataFrame, control: DataFrame, time: str, value: str, control_value: str, tie: str | None = None,
                  label: str = "control-match", folder: str | None = None, every: str | None = None, rows_per_group: int = ROWS_PER_GROUP):
    """temporal.control_match of two streams: data rows whose value is the control value in force at their time."""
    return _with_control(data, control, label, lambda rows, known: temporal.control_match(rows, known, time, value, control_value, tie, rows_per_group), folder, every)


def first_value_enrich(data: DataFrame, control: DataFrame, key: str, value: str, time: str, missing: str = "No match",
                       label: str = "first-value", folder: str | None = None, every: str | None = None):
    """joins.first_value_enrich of two streams: the first value that control rows announced for a row's key."""
    return _with_control(data, control, label, lambda rows, known: joins.first_value_enrich(rows, known, key, value, time, missing), folder, every)


def order_board(df: DataFrame, time: str, category: str, amount: str, size: str = "1 day", n: int = 3, label: str = "order-board",
                folder: str | None = None, every: str | None = None):
    """Board of a day window after every micro-batch: the total of all categories and the n largest category totals.

    The first level is a streaming aggregation in update mode, one total per window and category. The second keeps those
    updates per batch; a window that a batch touched is put together anew from the newest total of each of its categories,
    which takes back the older ones. The last update of a window (``last_boards``) is its batch board."""
    folder = folder or fresh_dir(df.sparkSession, label)
    totals = (df.groupBy(F.window(time, size).alias("__w"), category).agg(F.sum(F.col(amount).cast("decimal(18,4)")).alias("category_total"))
              .select(F.col("__w.start").alias("window_start"), category, "category_total"))

    def board(newest: DataFrame) -> DataFrame:
        rounded = newest.withColumn("category_total", F.round("category_total", 2))
        top = Window.partitionBy("window_start").orderBy(F.col("category_total").desc(), F.col(category))
        sums = rounded.groupBy(F.col("window_start").alias("__s")).agg(F.sum("category_total").alias("total"))
        return (rounded.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= n)
                .join(sums, F.col("window_start") == F.col("__s")).select("window_start", "total", "rank", category, "category_total"))

    def work(batch: DataFrame, number: int) -> DataFrame:
        if number < 0:
            return board(batch)
        batch.write.mode("overwrite").parquet(f"{folder}/totals/batch={number}")
        known = batch.sparkSession.read.schema(batch.schema.add("batch", "long")).parquet(f"{folder}/totals").where(F.col("batch") <= number)
        touched = known.where(F.col("batch") == number).select("window_start").distinct()
        newest = (known.join(touched, "window_start", "left_semi").groupBy("window_start", category)
                  .agg(F.max_by("category_total", "batch").alias("category_total")))
        return board(newest)

    return each_batch(totals, label, work, mode="update", folder=folder, every=every)


def last_boards(updates: DataFrame) -> DataFrame:
    """The last board of every window: the rows of the batch that touched it last."""
    newest = updates.groupBy(F.col("window_start").alias("__s")).agg(F.max("batch").alias("__b"))
    return updates.join(newest, (F.col("window_start") == F.col("__s")) & (F.col("batch") == F.col("__b"))).drop("__s", "__b", "batch")
