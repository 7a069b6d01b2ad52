"""Joins against versioned tables: the row that was valid at the left row's time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.durations import at, instant, micros
from ..plans.skew import ROWS_PER_GROUP, salted_join
from ..plans.slices import Order, Running, running


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str,
              columns: dict[str, Column | str], how: str = "left", tie: str | None = None,
              rows_per_group: int = ROWS_PER_GROUP, left_sizes: DataFrame | None = None) -> DataFrame:
    """Attach ``columns`` of the latest right row with right_time <= left_time and equal keys.

    Both sides are laid on one time line and the last version is carried forward: one shuffle, no
    pairs. ``keys=[]`` takes the latest version over all keys. ``tie`` orders right rows of equal time.
    ``left_sizes``: a cheaper frame with the left keys and time, where ``left`` is costly to compute.
    """
    values = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()])
    lefts = left.select(*keys, F.col(left_time).alias("__t"), F.lit(1).alias("__side"),
                        F.lit(None).cast("long").alias("__tie"), F.struct(*left.columns).alias("__row"))
    rights = right.where(F.col(right_time).isNotNull())
    for k in keys:
        rights = rights.where(F.col(k).isNotNull())
    rights = rights.select(*keys, F.col(right_time).alias("__t"), F.lit(0).alias("__side"),
                           (F.col(tie).cast("long") if tie else F.lit(None).cast("long")).alias("__tie"),
                           values.alias("__version"))
    line = lefts.unionByName(rights, allowMissingColumns=True)
    sizes = (lefts if left_sizes is None else left_sizes.select(*keys, F.col(left_time).alias("__t"))).select(
        *keys, "__t").unionByName(rights.select(*keys, "__t"))
    seen = running(line, keys, Order("__t", ("__side", "__tie")),
                   [Running("__seen", "last", F.col("__version"))], rows_per_group, sizes_from=sizes)
    got = seen.where(F.col("__row").isNotNull())
    if how == "inner":
        got = got.where(F.col("__seen").isNotNull())
    elif how != "left":
        raise ValueError("an as-of join is left or inner")
    return got.select("__row.*", *[F.col("__seen")[n].alias(n) for n in columns])


def latest_row_join(left: DataFrame, right: DataFrame, left_time: str, right_time: str,
                    columns: dict[str, Column | str], condition: Column, how: str = "left",
                    tie: str | None = None, rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """As-of join without a key: take the latest right row of all, then test ``condition`` (over the
    left columns and the new ones). A failed test pads (left) or drops (inner) the row."""
    seen = asof_join(left, right, [], left_time, right_time, columns, "left", tie, rows_per_group)
    if how == "inner":
        return seen.where(condition)
    return seen.select(*left.columns, *[F.when(condition, F.col(n)).alias(n) for n in columns])


def control_match(data: DataFrame, control: DataFrame, time: str, value: str, control_value: str,
                  tie: str | None = None, rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """Rows whose value equals the control value in force at their time, each marked with 1."""
    return (latest_row_join(data, control, time, time, {"__control": control_value},
                            F.col(value) == F.col("__control"), "inner", tie, rows_per_group)
            .drop("__control").withColumn("matched", F.lit(1)))


def retry_lookup_join(facts: DataFrame, dim: DataFrame, key: str, fact_time: str, available_at: str,
                      columns: dict[str, Column | str], delay: str | int = "5 seconds", retries: int = 3,
                      how: str = "left", tie: str | None = None,
                      rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """Lookup join that keeps a missed row and probes again every ``delay``.

    A row is probed at its own time and then ``retries + 1`` more times; the first probe that finds
    its key returns the version in force at that moment. After the last probe a left join pads the
    row and an inner join drops it. Adds ``attempt`` (0 = at once), null for a row that gave up.
    """
    step, last = micros(delay), retries + 1
    first = (dim.where(F.col(key).isNotNull()).groupBy(key)
             .agg(F.min(available_at).alias("__first")))
    known = salted_join(facts, first, [key], "left", rows_per_group)
    wait = F.greatest(F.lit(0), F.ceil((at("__first") - at(fact_time)) / step)).cast("long")
    kind = facts.schema[fact_time].dataType
    probed = (known.withColumn("attempt", F.when(F.col("__first").isNotNull() & (wait <= last), wait))
              .withColumn("__probe", instant(at(fact_time) + F.coalesce("attempt", F.lit(last)) * step, kind))
              .drop("__first"))
    got = asof_join(probed, dim, [key], "__probe", available_at, columns, "left", tie, rows_per_group,
                    left_sizes=facts.select(key, F.col(fact_time).alias("__probe")))
    if how == "inner":
        got = got.where(F.col("attempt").isNotNull())
    elif how != "left":
        raise ValueError("a retry join is left or inner")
    return got.drop("__probe")
