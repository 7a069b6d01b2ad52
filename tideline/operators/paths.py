"""Purchase-path analysis steered by a configuration stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..plans.skew import ROWS_PER_GROUP
from ..plans.slices import Order, Running, running
from .temporal import asof_join

# fixed values: the configuration in force for a channel that has none, and the purchase limit
DEFAULT_CONFIG = {"channel": "APP", "history_purchase_times": 0, "max_purchase_path_length": 3}
PURCHASE_LIMIT = 10


def purchase_paths(events: DataFrame, config: DataFrame, rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """Paths of user_id, channel, event_type, event_id, ts events up to and including each PURCHASE.

    ``config`` holds channel, ts, event_id, history_purchase_times, max_purchase_path_length; the
    latest version of the channel at the purchase decides whether the path is reported.
    """
    user_channel = ["user_id", "channel"]
    bought = F.when(F.col("event_type") == "PURCHASE", 1).otherwise(0)
    placed = running(events.select(*user_channel, "event_type", "ts", "event_id"), user_channel,
                     Order("ts", ("event_id",)), [Running("__path", "sum", bought, exclusive=True)], rows_per_group)
    path = [*user_channel, "__path"]
    placed = placed.withColumn("__path", F.coalesce("__path", F.lit(0)))
    by_type = placed.groupBy(*path, "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("event_type") == "PURCHASE", F.col("ts"))).alias("__ts"))
    paths = (by_type.groupBy(*path).agg(
                F.sum("n").alias("purchase_path_length"), F.max("__ts").alias("purchase_time"),
                F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("event_type_counts"))
             .where(F.col("purchase_time").isNotNull()))
    steered = asof_join(paths, config, ["channel"], "purchase_time", "ts",
                        {"__channel": "channel", "__times": "history_purchase_times",
                         "__longest": "max_purchase_path_length"}, tie="event_id", rows_per_group=rows_per_group,
                        left_sizes=events.where("event_type = 'PURCHASE'").select(
                            "channel", F.col("ts").alias("purchase_time")))
    times = F.coalesce("__times", F.lit(DEFAULT_CONFIG["history_purchase_times"]))
    longest = F.coalesce("__longest", F.lit(DEFAULT_CONFIG["max_purchase_path_length"]))
    return (steered.where((times < PURCHASE_LIMIT) & (F.col("purchase_path_length") > longest))
            .select("user_id", F.coalesce("__channel", F.lit(DEFAULT_CONFIG["channel"])).alias("channel"),
                    "purchase_time", "purchase_path_length", "event_type_counts"))
