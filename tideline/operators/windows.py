"""Tumbling, hopping, session and count windows, lateness reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.durations import at, instant, micros
from ..plans.skew import ROWS_PER_GROUP
from ..plans.slices import Order, Running, Split, running, split, trailing_sums
from ..plans.staging import staged


def tumble(df: DataFrame, time: str, size: str, keys: list[str], aggs: list[Column],
           offset: str | None = None) -> DataFrame:
    """One row per key and window with window_start and window_end. Works on streams too."""
    window = F.window(time, size, size, offset) if offset else F.window(time, size)
    return _unpack(df.groupBy(window.alias("__w"), *keys).agg(*aggs), keys)


def hop(df: DataFrame, time: str, slide: str, size: str, keys: list[str], aggs: list[Column]) -> DataFrame:
    """Overlapping windows of ``size`` starting every ``slide`` (slide first, as in HOP)."""
    return _unpack(df.groupBy(F.window(time, size, slide).alias("__w"), *keys).agg(*aggs), keys)


def _unpack(df: DataFrame, keys: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c != "__w" and c not in keys]
    return df.select(F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"),
                     *keys, *rest)


def hop_from_panes(df: DataFrame, time: str, slide: str, size: str, keys: list[str],
                   sums: dict[str, Column]) -> DataFrame:
    """Hopping windows over additive values. Rows are first summed per slide-wide pane (combined
    before the shuffle) and only the pane rows are copied into their windows, so the copying no
    longer grows with the number of input rows. ``sums`` holds sum or count expressions."""
    slide_us, size_us = micros(slide), micros(size)
    if size_us % slide_us:
        raise ValueError("size must be a multiple of slide")
    kind = df.schema[time].dataType
    panes = (df.groupBy(*keys, F.floor(at(time) / slide_us).alias("__pane"))
             .agg(*[e.alias(n) for n, e in sums.items()]))
    per = size_us // slide_us
    starts = F.explode(F.sequence(F.col("__pane") - (per - 1), F.col("__pane"))).alias("__first")
    spread = panes.select(*keys, starts, *sums)
    total = spread.groupBy(*keys, "__first").agg(*[F.sum(n).alias(n) for n in sums])
    return total.select(instant(F.col("__first") * slide_us, kind).alias("window_start"),
                        instant(F.col("__first") * slide_us + size_us, kind).alias("window_end"),
                        *keys, *sums)


def window_times(df: DataFrame) -> DataFrame:
    """Add window_rowtime, the last millisecond that belongs to the window."""
    return df.withColumn("window_rowtime", F.col("window_end") - F.expr("INTERVAL '0.001' SECOND"))


def sessions(df: DataFrame, keys: list[str], time: str, gap: str, sums: dict[str, Column] | None = None,
             rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """Session windows per key: a new session starts when more than ``gap`` has passed.

    Rows less than a gap apart always share a session, so rows are first merged per gap-wide cell
    (combined before the shuffle). What remains per key is at most time span / gap rows, whatever
    the number of input rows. Adds session_start, session_end (last row + gap) and ``n``.
    """
    sums = sums or {}
    gap_us = micros(gap)
    kind = df.schema[time].dataType
    cells = (df.where(F.col(time).isNotNull())
             .groupBy(*keys, F.floor(at(time) / gap_us).alias("__cell"))
             .agg(F.min(at(time)).alias("__lo"), F.max(at(time)).alias("__hi"),
                  F.count(F.lit(1)).alias("n"), *[e.alias(n) for n, e in sums.items()]))
    if keys:
        w = Window.partitionBy(*keys).orderBy("__cell")
        opens = F.coalesce((F.col("__lo") - F.lag("__hi").over(w) > gap_us).cast("int"), F.lit(1))
        numbered = cells.withColumn("__open", opens).withColumn("__session", F.sum("__open").over(w))
    else:
        # all cells are one group: cut into slices where there are many
        cells, order = staged(cells, "cells"), Order("__cell")
        parts = split(cells, [], order, rows_per_group)
        before = running(parts.df if parts.sliced else cells, [], order, [Running("__before", "max", F.col("__hi"), exclusive=True)], parts=parts)
        opens = F.coalesce((F.col("__lo") - F.col("__before") > gap_us).cast("int"), F.lit(1))
        opened = before.withColumn("__open", opens)
        again = Split(opened, (), order, parts.slices)
        numbered = running(opened, [], order, [Running("__session", "sum", F.col("__open"))], parts=again)
    merged = numbered.groupBy(*keys, "__session").agg(
        F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"), F.sum("n").alias("n"),
        *[F.sum(n).alias(n) for n in sums])
    return merged.select(*keys, instant(F.col("__lo"), kind).alias("session_start"),
                         instant(F.col("__hi") + gap_us, kind).alias("session_end"), "n", *sums)


def count_windows(df: DataFrame, keys: list[str], order: Order, size: int, aggs: list[Column],
                  rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """Tumbling windows of ``size`` rows per key in arrival order. An unfilled window never fires."""
    numbered = running(df, keys, order, [Running("__rn", "count")], rows_per_group)
    return (numbered.groupBy(*keys, F.floor((F.col("__rn") - 1) / size).alias("window_no"))
            .agg(F.count(F.lit(1)).alias("__rows"), *aggs)
            .where(F.col("__rows") == size).drop("__rows"))


def sliding_count_windows(df: DataFrame, keys: list[str], order: Order, size: int, slide: int,
                          sums: dict[str, Column], rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """Every ``slide`` rows per key, sums over the last ``size`` rows (fewer at the beginning)."""
    numbered = running(df, keys, order, [Running("arrivals", "count")], rows_per_group)
    framed = trailing_sums(numbered, keys, order, sums, size - 1, rows_per_group, sizes_from=df)
    return (framed.where(F.col("arrivals") % slide == 0)
            .select(*keys, "arrivals", F.col("__frame_rows").alias("rows_in_window"), *sums))


def evict_to_newest(df: DataFrame, keys: list[str], time: str, size: str, keep: int, tie: str,
                    aggs: list[Column]) -> DataFrame:
    """Tumbling window whose function only sees the newest ``keep`` rows of each window. The rank
    limit is applied before the shuffle as well, so at most ``keep`` rows per task and window move."""
    placed = df.withColumn("__w", F.window(time, size))
    newest = Window.partitionBy("__w", *keys).orderBy(F.col(time).desc(), F.col(tie).desc())
    kept = placed.withColumn("__rank", F.row_number().over(newest)).where(F.col("__rank") <= keep)
    return _unpack(kept.groupBy("__w", *keys).agg(*aggs), keys)


def evict_older_than(df: DataFrame, keys: list[str], time: str, size: str, age: str,
                     aggs: list[Column]) -> DataFrame:
    """Tumbling window that forgets rows more than ``age`` before the newest row of the window."""
    placed = df.withColumn("__w", F.window(time, size))
    newest = placed.groupBy("__w", *keys).agg(F.max(time).alias("__newest"))
    cond = F.col("__w").eqNullSafe(F.col("__n_w"))
    named = newest.select(F.col("__w").alias("__n_w"), *[F.col(k).alias(f"__n_{k}") for k in keys], "__newest")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__n_{k}"))
    kept = placed.join(named, cond).where(at(time) >= at("__newest") - micros(age))
    return _unpack(kept.groupBy("__w", *keys).agg(*aggs), keys)


def late_rows(df: DataFrame, arrival: str, time: str, delay: str,
              rows_per_group: int = ROWS_PER_GROUP, before_us: int | None = None) -> DataFrame:
    """Rows in arrival order with the watermark in force before them (newest time so far - delay)
    and whether the row is late against it. ``before_us``: the newest time of rows that arrived before all of ``df``."""
    marked = running(df, [], Order(arrival), [Running("__max", "max", at(time), exclusive=True)], rows_per_group)
    mark = F.greatest("__max", F.lit(before_us).cast("long")) - micros(delay)
    kind = df.schema[time].dataType
    return (marked.withColumn("watermark", instant(mark, kind))
            .withColumn("is_late", F.coalesce(at(time) < mark, F.lit(False))).drop("__max"))


def punctuated_watermark(df: DataFrame, arrival: str, time: str, is_marker: Column,
                         rows_per_group: int = ROWS_PER_GROUP, before_us: int | None = None) -> DataFrame:
    """Watermark that only marker rows move, to the time they carry. ``before_us``: the mark before all of ``df``."""
    spec = Running("__mark", "max", F.when(is_marker, at(time)))
    kind = df.schema[time].dataType
    marked = running(df, [], Order(arrival), [spec], rows_per_group)
    return marked.withColumn("watermark", instant(F.greatest("__mark", F.lit(before_us).cast("long")), kind)).drop("__mark")


def lag_watermark_flag(df: DataFrame, time: str, ingest: str, lag: str) -> DataFrame:
    """Late flag for a watermark that trails the wall clock: time < ingest time - lag."""
    return df.withColumn("is_late", at(time) < at(ingest) - micros(lag))


def bundles(df: DataFrame, keys: list[str], time: str, order: Order, interval: str, max_rows: int,
            item: Column, rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """Rows gathered into arrays, cut by time slot and after ``max_rows`` rows; an array never holds
    more than ``max_rows`` items."""
    slot = df.withColumn("slot", F.floor(at(time) / micros(interval)))
    numbered = running(slot, [*keys, "slot"], order, [Running("__rn", "count")], rows_per_group)
    part = F.floor((F.col("__rn") - 1) / max_rows).alias("part")
    packed = numbered.groupBy(*keys, "slot", part).agg(
        F.sort_array(F.collect_list(F.struct(F.col("__rn").alias("at"), item.alias("item")))).alias("__items"))
    return packed.select(*keys, "slot", "part", F.transform("__items", lambda x: x["item"]).alias("items"))
