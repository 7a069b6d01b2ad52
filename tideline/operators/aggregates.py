"""Grouped aggregates that combine before they shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.skew import ROWS_PER_GROUP
from ..plans.slices import Order, Running, running
from ..plans.staging import staged


def hourly_pv_uv(df: DataFrame, time: str, user: str) -> DataFrame:
    """Page views and distinct users per hour."""
    hour = F.date_format(time, "yyyy-MM-dd HH:00").alias("hour")
    return df.groupBy(hour).agg(F.count(F.lit(1)).alias("pv"), F.count_distinct(user).alias("uv"))


def split_distinct(df: DataFrame, keys: list[str], value: str, name: str, buckets: int = 1024) -> DataFrame:
    """COUNT(DISTINCT value) in two steps, so that one huge group is counted by many tasks: distinct
    values per (key, hash bucket), then the sum of the bucket counts."""
    bucket = F.pmod(F.xxhash64(value), F.lit(buckets)).alias("__bucket")
    part = df.groupBy(*keys, bucket).agg(F.count_distinct(value).alias("__n"))
    return part.groupBy(*keys).agg(F.sum("__n").alias(name))


def first_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key, as ROW_NUMBER() = 1 would pick it, by a combining aggregate."""
    row = F.min_by(F.struct(*df.columns), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(row).select("__row.*")


def latest_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    row = F.max_by(F.struct(*df.columns), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(row).select("__row.*")


def exact_percentiles(df: DataFrame, keys: list[str], value: str, fractions: dict[str, float],
                      rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """Interpolated percentiles per key without holding a group in memory: equal values are counted
    first, a running count places them, and only the few rows at the wanted places are kept."""
    counts = staged(df.where(F.col(value).isNotNull()).groupBy(*keys, value)
                    .agg(F.count(F.lit(1)).alias("__c")), "value-counts")
    placed = running(counts, keys, Order(value), [
        Running("__upto", "sum", F.col("__c")), Running("__n", "total_sum", F.col("__c"))], rows_per_group)
    holds = lambda place: (place >= F.col("__upto") - F.col("__c")) & (place < F.col("__upto"))
    spots = {}
    for name, p in fractions.items():
        exact = F.lit(p) * (F.col("__n") - 1)
        spots[name] = (F.floor(exact), F.ceil(exact), exact - F.floor(exact))
    wanted = None
    for low, high, _ in spots.values():
        hit = holds(low) | holds(high)
        wanted = hit if wanted is None else wanted | hit
    aggs = []
    for name, (low, high, part) in spots.items():
        aggs += [F.max(F.when(holds(low), F.col(value))).alias(f"__lo_{name}"),
                 F.max(F.when(holds(high), F.col(value))).alias(f"__hi_{name}"),
                 F.max(part).alias(f"__part_{name}")]
    picked = placed.where(wanted).groupBy(*keys).agg(*aggs)
    return picked.select(*keys, *[
        (F.col(f"__lo_{n}") + (F.col(f"__hi_{n}") - F.col(f"__lo_{n}")) * F.col(f"__part_{n}")).alias(n)
        for n in fractions])


# fixed values: the percentiles a metric summary reports
METRIC_PERCENTILES = {"p50": 0.5, "p75": 0.75, "p95": 0.95, "p98": 0.98, "p99": 0.99, "p999": 0.999}


def clean_metric_name(column: str | Column) -> Column:
    """Characters a metric name may not hold become underscores."""
    return F.regexp_replace(column, "[^a-zA-Z0-9:_]", "_")


def metric_summary(df: DataFrame, name: str, value: str, time: str,
                   rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """Histogram, counter and meter per metric: count, min, max, mean, stddev, percentiles, and the
    rate per second between the first and the last measurement."""
    named = df.withColumn("metric", clean_metric_name(name))
    seconds = (F.unix_micros(F.max(time).cast("timestamp")) - F.unix_micros(F.min(time).cast("timestamp"))) / 1e6
    basic = named.groupBy("metric").agg(
        F.count(value).alias("count"), F.min(value).alias("min"), F.max(value).alias("max"),
        F.avg(value).alias("mean"), F.stddev(value).alias("stddev"),
        (F.count(value) / seconds).alias("rate"))
    return basic.join(exact_percentiles(named, ["metric"], value, METRIC_PERCENTILES, rows_per_group), "metric")


def weighted_average(value: str, weight: str, sign: str | None = None) -> Column:
    """sum(value * weight) / sum(weight) in whole numbers, null for zero weight. ``sign`` is +1 for a
    row added and -1 for a row taken back."""
    factor = f" * {sign}" if sign else ""
    return F.expr(f"sum({value} * {weight}{factor}) div nullif(sum({weight}{factor}), 0)")


def distinct_after_retractions(df: DataFrame, keys: list[str], value: str, sign: str, name: str) -> DataFrame:
    """Number of values whose net multiplicity is positive."""
    net = df.groupBy(*keys, value).agg(F.sum(sign).alias("__net"))
    return net.groupBy(*keys).agg(F.count_if((F.col("__net") > 0) & F.col(value).isNotNull()).alias(name))


def both_present(first: str, second: str) -> Column:
    """Number of rows in which neither argument is null."""
    return F.count_if(F.col(first).isNotNull() & F.col(second).isNotNull())


def distinct_plus_sum(text: str, number: str) -> Column:
    """Distinct values of one column plus the sum of another."""
    return F.count_distinct(text) + F.coalesce(F.sum(number), F.lit(0))


def emit_max_twice(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Table aggregate with two rows per group: the maximum, twice."""
    top = df.groupBy(*keys).agg(F.max(value).alias("__m"))
    return top.select(*keys, F.explode(F.array("__m", "__m")).alias("max_value"))


def collect_multiset(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """COLLECT: value -> multiplicity per group. Counts come first, so an entry per distinct value
    is all that is gathered."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    return counts.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct(value, "__n"))).alias(name))


def fuse_multisets(df: DataFrame, keys: list[str], multiset: str, name: str) -> DataFrame:
    """FUSION: multiplicities of the group's multisets added up."""
    flat = df.select(*keys, F.explode(multiset).alias("__v", "__n"))
    return (flat.groupBy(*keys, "__v").agg(F.sum("__n").alias("__n")).groupBy(*keys)
            .agg(F.map_from_entries(F.collect_list(F.struct("__v", "__n"))).alias(name)))


def intersect_multisets(df: DataFrame, keys: list[str], multiset: str, name: str) -> DataFrame:
    """INTERSECTION: smallest multiplicity of the values every multiset of the group holds."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__sets"))
    flat = df.select(*keys, F.explode(multiset).alias("__v", "__n"))
    common = (flat.groupBy(*keys, "__v").agg(F.min("__n").alias("__n"), F.count(F.lit(1)).alias("__in"))
              .join(sizes, keys).where(F.col("__in") == F.col("__sets")))
    return common.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("__v", "__n"))).alias(name))
