"""Starting, draining and restarting streaming queries."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..session import fresh_dir


def stream_parquet(spark: SparkSession, path: str, time_column: str | None = None, delay: str | None = None,
                   files_per_batch: int | None = None) -> DataFrame:
    """Parquet files as a stream. The time column becomes a zoned timestamp, which watermarks need."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    # a path with a pattern may name one file as well as a folder of files
    pattern = path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]"
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    df = reader.parquet(pattern)
    if time_column:
        df = df.withColumn(time_column, F.col(time_column).cast("timestamp"))
        if delay is not None:
            df = df.withWatermark(time_column, delay)
    return df


def start(writer: DataStreamWriter, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Start a stream: a micro-batch every ``every`` until it is stopped, or without it all that is available now."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def drain(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process all that is available now and stop, however long it takes."""
    start(writer, checkpoint).awaitTermination()


def append_to_table(df: DataFrame, label: str, folder: str | None = None, every: str | None = None) -> DataFrame | StreamingQuery:
    """Write an append-mode stream into parquet under ``folder``/data (exactly once across restarts). Drains it
    and reads the table back, or with ``every`` returns the running query."""
    spark = df.sparkSession
    folder = folder or fresh_dir(spark, label)
    query = start(df.writeStream.outputMode("append").format("parquet").option("path", f"{folder}/data"), f"{folder}/checkpoint", every)
    if every:
        return query
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/data")


def each_batch(df: DataFrame, label: str, work: Callable[[DataFrame, int], DataFrame], mode: str = "append",
               folder: str | None = None, every: str | None = None, keep: bool = False) -> DataFrame | StreamingQuery:
    """Send a stream through ``work`` per micro-batch. A batch is written under its own number, so a batch that is
    replayed after a failure replaces its earlier attempt. Drains it and reads the result back, or with
    ``every`` returns the running query. ``keep`` computes a batch once for a ``work`` that reads it several times."""
    spark = df.sparkSession
    folder = folder or fresh_dir(spark, label)

    def write(batch: DataFrame, number: int) -> None:
        held = batch.persist() if keep else batch
        try:
            work(held, number).write.mode("overwrite").parquet(f"{folder}/data/batch={number}")
        finally:
            if keep:
                held.unpersist()

    query = start(df.writeStream.outputMode(mode).foreachBatch(write), f"{folder}/checkpoint", every)
    if every:
        return query
    query.awaitTermination()
    if not query.recentProgress:  # nothing was available, so no batch has left a schema
        return work(spark.createDataFrame([], df.schema), -1).withColumn("batch", F.lit(None).cast("int")).where("false")
    return spark.read.parquet(f"{folder}/data")


def latest_update(updates: DataFrame, keys: list[str]) -> DataFrame:
    """Fold update-mode output (with its batch number) into the last row per key."""
    row = F.max_by(F.struct(*[c for c in updates.columns if c != "batch"]), "batch").alias("__row")
    return updates.groupBy(*keys).agg(row).select("__row.*")


def run_with_restarts(start: Callable[[], object], attempts: int = 10, pause_seconds: float = 30.0) -> int:
    """Fixed-delay restart policy: ``start`` returns a running query; after a failure it is started
    again from its checkpoint. Returns the number of restarts."""
    for restarts in range(attempts + 1):
        try:
            start().awaitTermination()
            return restarts
        except Exception:
            if restarts == attempts:
                raise
            time.sleep(pause_seconds)
    return attempts
