"""The incremental window: one window, many outputs of its growing result."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.durations import at, floor_to, instant, micros


def incremental_window(df: DataFrame, time: str, size: str, interval: str, keys: list[str],
                       sums: dict[str, Column] | None = None, minimums: dict[str, Column] | None = None,
                       maximums: dict[str, Column] | None = None,
                       distinct: dict[str, str] | None = None) -> DataFrame:
    """Tumbling windows of ``size`` that report every ``interval`` what they hold so far.

    A firing at time f covers the window's rows with time < f; the last one is at the window's end.
    A window fires from its first row on, also for intervals without new rows. Rows are aggregated per
    interval first (combined before the shuffle); a distinct value counts in the interval that saw it
    first. The running part then handles at most size / interval rows per key and window.
    """
    sums, minimums, maximums = sums or {}, minimums or {}, maximums or {}
    distinct = distinct or {}
    size_us, step_us = micros(size), micros(interval)
    kind = df.schema[time].dataType
    t = at(time)
    start = floor_to(t, size_us)
    placed = (df.withColumn("__start", start)
              .withColumn("__step", F.floor((t - F.col("__start")) / step_us)))
    spot = [*keys, "__start", "__step"]
    parts = [placed.groupBy(*spot).agg(
        F.count(F.lit(1)).alias("__rows"),
        *[e.alias(n) for n, e in {**sums, **minimums, **maximums}.items()])]
    for name, column in distinct.items():
        first = (placed.where(F.col(column).isNotNull()).groupBy(*keys, "__start", column)
                 .agg(F.min("__step").alias("__step")))
        parts.append(first.groupBy(*spot).agg(F.count(F.lit(1)).alias(name)))
    if len(parts) > 1:
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        steps = stacked.groupBy(*spot).agg(
            *[F.sum(n).alias(n) for n in [*sums, *distinct]],
            *[F.min(n).alias(n) for n in minimums], *[F.max(n).alias(n) for n in maximums])
    else:
        steps = parts[0]
    w = Window.partitionBy(*keys, "__start").orderBy("__step")
    grown = w.rowsBetween(Window.unboundedPreceding, 0)
    last = (size_us - 1) // step_us
    curve = steps.select(
        *spot, F.coalesce(F.lead("__step").over(w) - 1, F.lit(last)).alias("__until"),
        *[F.sum(n).over(grown).alias(n) for n in [*sums, *distinct]],
        *[F.min(n).over(grown).alias(n) for n in minimums],
        *[F.max(n).over(grown).alias(n) for n in maximums])
    fired = curve.withColumn("__at", F.explode(F.sequence("__step", "__until")))
    end = F.col("__start") + size_us
    fire = F.least(F.col("__start") + (F.col("__at") + 1) * step_us, end)
    return fired.select(instant(F.col("__start"), kind).alias("window_start"),
                        instant(fire, kind).alias("fire_time"), *keys,
                        *sums, *minimums, *maximums, *distinct)


def order_board(df: DataFrame, time: str, category: str, amount: str, size: str = "1 day",
                interval: str = "10 seconds", n: int = 3) -> DataFrame:
    """At every firing of a day window: total of all categories and the n largest category totals.
    Amounts are summed as decimals and rounded half up to two places."""
    totals = incremental_window(df, time, size, interval, [category],
                                sums={"category_total": F.sum(F.col(amount).cast("decimal(18,4)"))})
    rounded = totals.withColumn("category_total", F.round("category_total", 2))
    moment = Window.partitionBy("window_start", "fire_time")
    ranked = (rounded.groupBy("window_start", "fire_time").agg(F.sum("category_total").alias("total"))
              .withColumnRenamed("window_start", "__s").withColumnRenamed("fire_time", "__f"))
    top = (rounded.withColumn("rank", F.row_number().over(
               moment.orderBy(F.col("category_total").desc(), F.col(category)))).where(F.col("rank") <= n))
    return top.join(ranked, (F.col("window_start") == F.col("__s")) & (F.col("fire_time") == F.col("__f"))).select(
        "window_start", "fire_time", "total", "rank", category, "category_total")
