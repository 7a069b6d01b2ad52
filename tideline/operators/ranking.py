"""Top-N per window, ranking and frame functions over groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.skew import ROWS_PER_GROUP
from ..plans.slices import Order, Running, running, shifted, trailing_sums
from .windows import hop_from_panes


def top_n(df: DataFrame, groups: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first n rows per group. Spark applies the limit before the shuffle too, so a task sends at
    most n rows per group."""
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def hot_items(events: DataFrame, time: str, item: str, size: str, slide: str, n: int = 3) -> DataFrame:
    """The n most frequent items of every hopping window; equal counts rank by item."""
    counts = hop_from_panes(events, time, slide, size, [item], {"n": F.count(F.lit(1))})
    return top_n(counts, ["window_end"], [F.col("n").desc(), F.col(item).asc()], n)


def ranks(df: DataFrame, keys: list[str], order: Order, tiles: int | None = None,
          rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """row_number, rank, dense_rank, percent_rank, cume_dist and (with ``tiles``) ntile.

    The ties of ``order`` only settle row_number and ntile; the others compare the main column."""
    out = running(df, keys, order, [
        Running("row_number", "count"), Running("rank", "rank"), Running("dense_rank", "dense_rank"),
        Running("__upto", "upto"), Running("__n", "total_count")], rows_per_group)
    n = F.col("__n")
    out = (out.withColumn("percent_rank", F.when(n > 1, (F.col("rank") - 1) / (n - 1)).otherwise(F.lit(0.0)))
           .withColumn("cume_dist", F.col("__upto") / n))
    if tiles:
        small, extra, rn = F.floor(n / tiles), n % tiles, F.col("row_number")
        cut = extra * (small + 1)
        out = out.withColumn("ntile", F.when(rn <= cut, F.floor((rn - 1) / (small + 1)) + 1)
                             .otherwise(extra + F.floor((rn - 1 - cut) / F.greatest(small, F.lit(1))) + 1)
                             .cast("int"))
    return out.drop("__n", "__upto")


def neighbours(df, keys, order, values, rows_per_group=ROWS_PER_GROUP) -> DataFrame:
    """LAG and LEAD: see plans.slices.shifted."""
    return shifted(df, keys, order, values, rows_per_group)


def positional_values(df: DataFrame, keys: list[str], order: Order, column: str, nth: int,
                      rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """first_value, last_value (to the current row), last non-null value, nth_value, per key in order."""
    specs = [Running("__rn", "count"), Running("last_non_null", "last", F.col(column))]
    base = running(df, keys, order, specs, rows_per_group)
    picks = (base.where(F.col("__rn").isin(1, nth)).groupBy(*keys)
             .agg(F.max(F.when(F.col("__rn") == 1, F.col(column))).alias("first_value"),
                  F.max(F.when(F.col("__rn") == nth, F.col(column))).alias("__nth")))
    named = picks.select(*[F.col(k).alias(f"__p_{k}") for k in keys], "first_value", "__nth")
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__p_{k}"))
    return (base.join(named, cond, "left").drop(*[f"__p_{k}" for k in keys])
            .withColumn("last_value", F.col(column))
            .withColumn("nth_value", F.when(F.col("__rn") >= nth, F.col("__nth"))).drop("__rn", "__nth"))


def full_frames_only(df: DataFrame, keys: list[str], order: Order, sums: dict[str, Column], rows: int,
                     rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """Sums over the last ``rows`` + 1 rows, null while the frame is not yet full."""
    framed = trailing_sums(df, keys, order, sums, rows, rows_per_group)
    full = F.col("__frame_rows") == rows + 1
    return framed.select(*df.columns, *[F.when(full, F.col(n)).alias(n) for n in sums])


def running_distinct(df: DataFrame, keys: list[str], order: Order, value: str,
                     rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """distinct_so_far: COUNT(DISTINCT value) OVER (PARTITION BY keys ORDER BY order)."""
    seen = running(df, [*keys, value], order, [Running("__nth", "count")], rows_per_group)
    new = F.when((F.col("__nth") == 1) & F.col(value).isNotNull(), 1).otherwise(0)
    return running(seen, keys, order, [Running("distinct_so_far", "sum", new)], rows_per_group,
                   sizes_from=df).drop("__nth")
