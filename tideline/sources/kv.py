"""Key-value tables: rows (hash, field, value) kept as parquet, and command logs folded into state."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..plans.skew import ROWS_PER_GROUP
from ..plans.slices import Order, Running, running


def glob_regex(pattern: str) -> str:
    """Key glob (* ? [abc] [^a] and backslash escapes) as a regular expression for the whole key."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\" and i + 1 < len(pattern):
            i += 1
            out.append(re.escape(pattern[i]))
        elif ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif ch == "[" and "]" in pattern[i + 1:]:
            end = pattern.index("]", i + 1)
            out.append("[" + pattern[i + 1:end].replace("\\", "\\\\") + "]")
            i = end
        else:
            out.append(re.escape(ch))
        i += 1
    return "(?s)^" + "".join(out) + "$"


def matches(column: str, pattern: str) -> Column:
    """Glob test. A literal beginning also becomes a prefix test, which parquet scans can use."""
    if pattern == "*":
        return F.col(column).isNotNull()
    prefix = re.match(r"[^*?\[\\]*", pattern).group()
    test = F.col(column).rlike(glob_regex(pattern))
    return F.col(column).startswith(prefix) & test if prefix else test


def store(df: DataFrame, path: str, hash_name: str, field: str, value: str, mode: str = "append") -> None:
    """Write (field, value) under a hash name. Only string columns are accepted."""
    kinds = dict(df.select(field, value).dtypes)
    if set(kinds.values()) != {"string"}:
        raise TypeError(f"key-value tables hold strings, got {kinds}")
    (df.select(F.lit(hash_name).alias("hash"), F.col(field).alias("field"), F.col(value).alias("value"))
     .write.partitionBy("hash").mode(mode).parquet(path))


def scan(spark: SparkSession, path: str, hash_name: str | None = None, match_key: str = "*") -> DataFrame:
    """HSCAN with a hash name: (field, value) of all matching fields. SCAN without: matching hash names."""
    table = spark.read.schema("field STRING, value STRING, hash STRING").parquet(path)
    if hash_name is None:
        return table.select("hash").distinct().where(matches("hash", match_key))
    return table.where((F.col("hash") == hash_name) & matches("field", match_key)).select("field", "value")


def fold_commands(log: DataFrame, rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """Final state of a log (seq, op, key, field, value) of SET HSET SADD ZADD ZREM LPUSH RPUSH.

    Rows of the result: kind, key, field, value, position. Strings and hash fields keep their last
    value, sets their members, sorted sets the last score of members not removed since, lists one row
    per element with its position. Lists stay rows, so no list has to fit into one task.
    """
    op = F.col("op")
    kind = (F.when(op == "SET", "string").when(op == "HSET", "hash").when(op == "SADD", "set").when(op.isin("ZADD", "ZREM"), "zset"))
    member = F.when(op == "HSET", F.col("field")).when(op != "SET", F.col("value"))
    # one pass and one shuffle: the last command decides about a string, a hash field, a member
    last = (log.where(kind.isNotNull()).groupBy(kind.alias("kind"), "key", member.alias("field"))
            .agg(F.max_by(F.struct("op", F.col("field").alias("score"), "value"), "seq").alias("l")).where("l.op <> 'ZREM'"))
    value = F.when(F.col("kind").isin("string", "hash"), F.col("l.value")).when(F.col("kind") == "zset", F.col("l.score"))
    folded = last.select("kind", "key", "field", value.cast("string").alias("value"), F.lit(None).cast("long").alias("position"))
    pushes = log.where(op.isin("LPUSH", "RPUSH"))
    left = F.when(F.col("op") == "LPUSH", 1).otherwise(0)
    placed = running(pushes, ["key"], Order("seq"), [
        Running("__lefts", "sum", left), Running("__rows", "count"), Running("__all_lefts", "total_sum", left)],
        rows_per_group)
    spot = F.when(F.col("op") == "LPUSH", F.col("__all_lefts") - F.col("__lefts")).otherwise(
        F.col("__all_lefts") + F.col("__rows") - F.col("__lefts") - 1)
    lists = placed.select(F.lit("list").alias("kind"), "key", F.lit(None).cast("string").alias("field"),
                          F.col("value").cast("string").alias("value"), spot.cast("long").alias("position"))
    return folded.unionByName(lists)


def distinct_sketch(log: DataFrame, error: float = 0.01) -> DataFrame:
    """PFADD: estimated number of distinct values per key."""
    return (log.where("op = 'PFADD'").groupBy("key")
            .agg(F.approx_count_distinct("value", error).alias("estimate")))


def published(log: DataFrame, channel: str) -> DataFrame:
    """PUBLISH: messages of one channel."""
    return log.where((F.col("op") == "PUBLISH") & (F.col("key") == channel)).select("seq", "value")
