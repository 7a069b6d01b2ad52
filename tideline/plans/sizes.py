"""Size checks that stand before every explicit broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's own size estimate of the optimised plan (an upper estimate for joins)."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only where the estimate proves the side small; otherwise leave the choice
    to the planner, which shuffles both sides."""
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df
