"""Batch writes: routing, rolling targets, partition inserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

UNROUTED = "unrouted"


def route(df: DataFrame, tags: dict[str, Column]) -> dict[str, DataFrame]:
    """One filtered DataFrame per tag; rows that match no tag are under ``unrouted``."""
    hits = {tag: F.coalesce(test, F.lit(False)) for tag, test in tags.items()}
    rest = None
    for hit in hits.values():
        rest = ~hit if rest is None else rest & ~hit
    return {**{tag: df.where(hit) for tag, hit in hits.items()}, UNROUTED: df.where(rest)}


def tagged(df: DataFrame, tags: dict[str, Column], name: str = "tag") -> DataFrame:
    """Every row once per matching tag, or once as ``unrouted``: the input is read a single time."""
    hit = F.array_compact(F.array(*[F.when(test, F.lit(tag)) for tag, test in tags.items()]))
    return df.withColumn(name, F.explode(F.when(F.size(hit) > 0, hit).otherwise(F.array(F.lit(UNROUTED)))))


def write_routed(df: DataFrame, path: str, tags: dict[str, Column], mode: str = "append") -> None:
    """All routes in one pass, one folder per tag."""
    tagged(df, tags).write.partitionBy("tag").mode(mode).parquet(path)


def write_rolling(df: DataFrame, path: str, prefix: str, time: str, mode: str = "append") -> None:
    """One target per day, named prefix + yyyy-MM-dd."""
    target = F.concat(F.lit(prefix), F.date_format(time, "yyyy-MM-dd"))
    df.withColumn("target", target).write.partitionBy("target").mode(mode).parquet(path)


def insert_partitions(df: DataFrame, path: str, partition_columns: list[str], static: dict[str, object] | None = None,
                      overwrite: bool = False, columns: list[str] | None = None) -> None:
    """INSERT INTO / INSERT OVERWRITE of partitions. Overwrite replaces only the partitions the rows
    belong to. ``static`` fixes partition values; ``columns`` lists the inserted columns."""
    out = df.select(*columns) if columns else df
    for name, value in (static or {}).items():
        if name not in partition_columns:
            raise ValueError(f"{name} is not a partition column")
        out = out.withColumn(name, F.lit(value))
    writer = out.write.partitionBy(*partition_columns)
    if overwrite:
        writer = writer.option("partitionOverwriteMode", "dynamic").mode("overwrite")
    else:
        writer = writer.mode("append")
    writer.parquet(path)
