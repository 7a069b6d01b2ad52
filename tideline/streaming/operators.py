"""Streaming forms of the operators. Each has a batch twin that defines its result."""

from __future__ import annotations

from collections.abc import Callable
import time as clock

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.paths import DEFAULT_CONFIG, PURCHASE_LIMIT
from ..operators.ranking import top_n
from ..operators.temporal import asof_join
from ..plans.durations import at, floor_to, instant, micros
from ..sources.sinks import write_routed
from .processors import CountWindow, FirstSeen, FlushBuffer, GrowingDistinct, GrowingWindow, PathCollector, SlidingCountWindow, VersionedLookup
from .runner import each_batch, start


def windowed_counts(df: DataFrame, time: str, size: str, keys: list[str], slide: str | None = None) -> DataFrame:
    window = F.window(time, size, slide) if slide else F.window(time, size)
    out = df.groupBy(window.alias("__w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), *keys, "n")


def session_counts(df: DataFrame, time: str, gap: str, keys: list[str]) -> DataFrame:
    out = df.groupBy(F.session_window(time, gap).alias("__w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return out.select(*keys, F.col("__w.start").alias("session_start"), F.col("__w.end").alias("session_end"), "n")


def pv_uv(df: DataFrame, time: str, user: str, size: str = "1 hour") -> DataFrame:
    """Exact page views and distinct users per window: first one row per window and user, then the
    count of those rows. Streams take no COUNT(DISTINCT), and this keeps the state spread by user."""
    per_user = df.groupBy(F.window(time, size), user).agg(F.count(F.lit(1)).alias("views"))
    both = per_user.groupBy(F.window("window", size)).agg(F.sum("views").alias("pv"), F.count(F.lit(1)).alias("uv"))
    return both.select(F.col("window.start").alias("window_start"), "pv", "uv")


def hot_items(df: DataFrame, time: str, item: str, size: str, slide: str, n: int, label: str = "hot-items",
              folder: str | None = None, every: str | None = None) -> DataFrame:
    """Top-N per hopping window. Closed windows leave the stream whole in one micro-batch, where the
    rank limit runs as a batch operator. ``folder`` and ``every`` as in runner.each_batch."""
    counts = windowed_counts(df, time, size, [item], slide)
    return each_batch(counts, label, lambda batch, _: top_n(
        batch, ["window_end"], [F.col("n").desc(), F.col(item).asc()], n), folder=folder, every=every)


def interval_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, upper: str,
                  how: str = "inner") -> DataFrame:
    """right_time in [left_time, left_time + upper] and equal keys; both sides carry watermarks.
    The inner join also uses time cells as a key, so a hot key's state is spread over its cells."""
    limit = F.expr(f"INTERVAL '{micros(upper) / 1e6:.6f}' SECOND")
    in_time = (F.col(right_time) >= F.col(left_time)) & (F.col(right_time) <= F.col(left_time) + limit)
    other = right.withColumnRenamed(key, "__r_key")
    cond = (F.col(key) == F.col("__r_key")) & in_time
    if how != "inner":
        return left.join(other, cond, how).drop("__r_key")
    width = micros(upper)
    first = F.floor(at(left_time) / width)
    probes = left.withColumn("__cell", F.explode(F.array(first, first + 1)))
    target = other.withColumn("__rcell", F.floor(at(right_time) / width))
    return probes.join(target, cond & (F.col("__cell") == F.col("__rcell"))).drop("__r_key", "__cell", "__rcell")


#: state groups that the keys of a stateful operator are spread over by hash; raise it where a group gets too large for a task
STATE_GROUPS = 512


def _key_text(df: DataFrame, key: str) -> Column:
    kind = df.schema[key].dataType.simpleString()
    if kind in ("float", "double"):
        return (F.col(key) + F.lit(0.0)).cast("string")  # -0.0 and 0.0 are one key
    return F.base64(key) if kind == "binary" else F.col(key).cast("string")


def _key_back(text: str, kind: str) -> Column:
    return F.unbase64(text) if kind == "binary" else F.col(text).cast(kind)


def versioned_lookup(facts: DataFrame, versions: DataFrame, key: str, time: str, fact_id: str, version_time: str,
                     version_id: str, payload: Column, value: Column, delay: str = "5 seconds", probes: int = 0,
                     how: str = "left", salts: int = 1, groups: int = STATE_GROUPS) -> DataFrame:
    """Retry lookup join (probes = retries + 1) or event-time as-of join (probes = 0) of two streams.

    Both inputs need watermarks on their times; rows without a time take no part. Keys are spread over ``groups`` state
    groups. ``salts`` spreads the facts of a hot key over that many; versions are repeated for each.
    """
    def side(df: DataFrame, number: int, salt: Column, moment: str, row_id: str, text: Column) -> DataFrame:
        held = _key_text(df, key)
        return df.where(F.col(moment).isNotNull()).select(
            F.pmod(F.xxhash64(held), F.lit(groups)).cast("int").alias("__group"), salt.alias("__salt"), held.alias("key"), F.lit(number).alias("side"),
            at(moment).alias("at_us"), F.col(row_id).cast("long").alias("id"), text.cast("string").alias("payload"), F.col(moment).alias("__time"))

    lefts = side(facts, 1, F.pmod(F.xxhash64(fact_id), F.lit(salts)).cast("int"), time, fact_id, payload)
    rights = side(versions, 0, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))), version_time, version_id, value)
    kind = facts.schema[key].dataType.simpleString()
    found = lefts.unionByName(rights).groupBy("__group", "__salt").transformWithStateInPandas(
        VersionedLookup(["__group", "__salt"], micros(delay), probes, how == "left"),
        "__group INT, __salt INT, key STRING, id BIGINT, payload STRING, version STRING, attempt INT", "Append", "EventTime")
    return found.select(_key_back("key", kind).alias(key), "id", "payload", "version", "attempt")


def incremental_window(df: DataFrame, time: str, size: str, interval: str, key: str, amount: str) -> DataFrame:
    """Incremental window with event-time firings: row count and total per key so far."""
    size_us, step_us = micros(size), micros(interval)
    rows = df.select(key, floor_to(at(time), size_us).alias("start_us"), at(time).alias("at_us"), F.lit(1).cast("long").alias("n"),
                     F.round(F.col(amount).cast("decimal(18,2)") * 100).cast("long").alias("total_cents"), time)
    kind = df.schema[key].dataType.simpleString()
    fired = rows.groupBy(key, "start_us").transformWithStateInPandas(
        GrowingWindow([key, "start_us"], size_us, step_us),
        f"{key} {kind}, start_us BIGINT, fire_us BIGINT, n BIGINT, total_cents BIGINT", "Append", "EventTime")
    return fired.select(key, instant(F.col("start_us"), "timestamp").alias("window_start"),
                        instant(F.col("fire_us"), "timestamp").alias("fire_time"), "n", (F.col("total_cents") / 100).alias("total"))


def incremental_distinct(df: DataFrame, time: str, size: str, interval: str, key: str, value: str, salts: int = 8,
                         label: str = "incremental-distinct", folder: str | None = None, every: str | None = None) -> DataFrame:
    """Incremental window of a stream: rows and distinct values per key so far, at every firing.

    State is split by value into ``salts`` groups per key and window, so a hot key is no single task. A firing leaves all
    its groups in the same micro-batch, which adds them up. NULL values count as rows only. Column batch numbers
    the micro-batch; ``folder`` and ``every`` as in runner.each_batch."""
    size_us, step_us = micros(size), micros(interval)
    spread = F.pmod(F.xxhash64(value), F.lit(salts)).cast("int")
    rows = df.select(key, floor_to(at(time), size_us).alias("start_us"), spread.alias("salt"), at(time).alias("at_us"),
                     F.col(value).cast("string").alias("value"), time)
    kind = df.schema[key].dataType.simpleString()
    parts = rows.groupBy(key, "start_us", "salt").transformWithStateInPandas(
        GrowingDistinct([key, "start_us", "salt"], size_us, step_us),
        f"`{key}` {kind}, start_us BIGINT, salt INT, fire_us BIGINT, n BIGINT, distinct BIGINT", "Append", "EventTime")

    def whole(batch: DataFrame, _: int) -> DataFrame:
        return (batch.groupBy(key, "start_us", "fire_us").agg(F.sum("n").alias("n"), F.sum("distinct").alias("distinct"))
                .select(key, instant(F.col("start_us"), "timestamp").alias("window_start"),
                        instant(F.col("fire_us"), "timestamp").alias("fire_time"), "n", "distinct"))

    return each_batch(parts, label, whole, folder=folder, every=every)


def early_results(df: DataFrame, time: str, size: str, keys: list[str], aggs: list[Column], offset: str | None = None) -> DataFrame:
    """Running result of open windows; write it in update mode with a processing-time trigger."""
    window = F.window(time, size, size, offset) if offset else F.window(time, size)
    out = df.groupBy(window.alias("__w"), *keys).agg(*aggs)
    rest = [c for c in out.columns if c != "__w" and c not in keys]
    return out.select(F.col("__w.start").alias("window_start"), *keys, *rest)


def count_windows(df: DataFrame, key: str, row_id: str, amount: str, size: int) -> DataFrame:
    rows = df.select(key, F.col(row_id).cast("long").alias("id"),
                     F.round(F.col(amount).cast("decimal(18,2)") * 100).cast("long").alias("cents"))
    kind = df.schema[key].dataType.simpleString()
    got = rows.groupBy(key).transformWithStateInPandas(
        CountWindow([key], size), f"{key} {kind}, window_no BIGINT, total_cents BIGINT", "Append", "None")
    return got.select(key, "window_no", (F.col("total_cents") / 100).alias("total"))


def sliding_count_windows(df: DataFrame, key: str, row_id: str, amount: str, size: int, slide: int) -> DataFrame:
    """Every ``slide`` rows per key, the total of its last ``size`` rows. Rows of a micro-batch count in the order of ``row_id``."""
    rows = df.select(key, F.col(row_id).cast("long").alias("id"),
                     F.round(F.col(amount).cast("decimal(18,2)") * 100).cast("long").alias("cents"))
    kind = df.schema[key].dataType.simpleString()
    got = rows.groupBy(key).transformWithStateInPandas(
        SlidingCountWindow([key], size, slide), f"{key} {kind}, arrivals BIGINT, total_cents BIGINT", "Append", "None")
    return got.select(key, "arrivals", F.least("arrivals", F.lit(size)).alias("rows_in_window"), (F.col("total_cents") / 100).alias("total"))


def purchase_paths(events: DataFrame, read_config: Callable[[], DataFrame], time: str = "ts", label: str = "paths",
                   folder: str | None = None, every: str | None = None, groups: int = STATE_GROUPS) -> DataFrame:
    """Paths closed by the stream, judged per micro-batch by the configuration in force at the purchase.
    ``read_config`` returns the configuration history (channel, ts, event_id and the two limits). Users are spread over
    ``groups`` state groups; events without a time take no part."""
    rows = events.where(F.col(time).isNotNull()).select(
        F.pmod(F.xxhash64("user_id", "channel"), F.lit(groups)).cast("int").alias("__group"), F.col("user_id").cast("string").alias("user_id"),
        "channel", "event_type", at(time).alias("at_us"), F.col("event_id").alias("id"), time)
    closed = rows.groupBy("__group").transformWithStateInPandas(
        PathCollector("__group"),
        "__group INT, user_id STRING, channel STRING, purchase_us BIGINT, id BIGINT, length BIGINT, counts MAP<STRING, BIGINT>",
        "Append", "EventTime")
    closed = closed.drop("__group").withColumn("user_id", F.col("user_id").cast("long"))

    def judge(batch: DataFrame, _: int) -> DataFrame:
        config = read_config()
        timed = batch.withColumn("purchase_time", instant(F.col("purchase_us"), config.schema["ts"].dataType))
        steered = asof_join(timed, config, ["channel"], "purchase_time", "ts",
                            {"__channel": "channel", "__times": "history_purchase_times",
                             "__longest": "max_purchase_path_length"}, tie="event_id")
        times = F.coalesce("__times", F.lit(DEFAULT_CONFIG["history_purchase_times"]))
        longest = F.coalesce("__longest", F.lit(DEFAULT_CONFIG["max_purchase_path_length"]))
        return (steered.where((times < PURCHASE_LIMIT) & (F.col("length") > longest))
                .select("user_id", F.coalesce("__channel", F.lit(DEFAULT_CONFIG["channel"])).alias("channel"), "purchase_time",
                        F.col("length").alias("purchase_path_length"), F.col("counts").alias("event_type_counts")))

    # judging measures the batch before it joins it, which would run the stateful operator again each time
    return each_batch(closed, label, judge, folder=folder, every=every, keep=True)


def first_seen(df: DataFrame, keys: list[str], ttl_ms: int, time: str | None = None) -> DataFrame:
    """First row per key, forgetting keys that stay idle for ``ttl_ms``. Of the rows that arrive together the
    earliest by ``time`` counts."""
    schema = df.schema
    return df.groupBy(*keys).transformWithStateInPandas(FirstSeen(ttl_ms, time), schema, "Append", "ProcessingTime")


def mini_batch_lookup(facts: DataFrame, read_dim: Callable[[], DataFrame], keys: list[str], how: str = "left",
                      label: str = "mini-batch", folder: str | None = None, every: str | None = None) -> DataFrame:
    """Per micro-batch: probe the distinct keys once, then join the answers back to the rows. A batch ends after
    ``every``, or before it with as many files as the source allows per trigger."""
    def probe(batch: DataFrame, _: int) -> DataFrame:
        answers = batch.select(*keys).distinct().join(read_dim(), keys)
        return batch.join(answers, keys, how)

    return each_batch(facts, label, probe, folder=folder, every=every)


class RefreshedTable:
    """A lookup table re-read when it is older than its time to live, at a micro-batch boundary."""

    def __init__(self, read: Callable[[], DataFrame], ttl_seconds: float, now: Callable[[], float] = clock.monotonic):
        self.read, self.ttl, self.now = read, ttl_seconds, now
        self.loaded, self.at, self.loads = None, None, 0

    def __call__(self) -> DataFrame:
        if self.loaded is None or self.now() - self.at >= self.ttl:
            if self.loaded is not None:
                self.loaded.unpersist()
            self.loaded, self.at, self.loads = self.read().persist(), self.now(), self.loads + 1
        return self.loaded


def jdbc_table(spark, url: str, table: str, partition_column: str, bounds: tuple[int, int], partitions: int,
               **options: str) -> DataFrame:
    """A database table read in parallel ranges, for use with RefreshedTable."""
    return spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1],
        numPartitions=partitions, **options).load()


def _run(writer, folder: str, every: str | None):
    query = start(writer, f"{folder}/checkpoint", every)
    if every:
        return query
    query.awaitTermination()


def route_stream(df: DataFrame, folder: str, tags: dict[str, Column], every: str | None = None):
    """Side outputs: every micro-batch is written once, one folder per tag and batch. Drains the stream, or with
    ``every`` returns the running query."""
    def write(batch: DataFrame, number: int) -> None:
        write_routed(batch, f"{folder}/data/batch={number}", tags, mode="overwrite")

    return _run(df.writeStream.foreachBatch(write), folder, every)


def statement_sink(df: DataFrame, folder: str, statement: str, batch_rows: int, write: Callable | None = None,
                   every: str | None = None):
    """Sink that writes every micro-batch whole: its rows grouped by statement, in files of at most ``batch_rows``
    rows. ``write`` replaces the parquet target, e.g. by a JDBC writer with batchsize. With ``every`` a micro-batch ends
    after that interval and the running query is returned. ``flushing_sink`` gathers rows over micro-batches."""
    def parquet(batch: DataFrame, number: int) -> None:
        (batch.write.option("maxRecordsPerFile", batch_rows).partitionBy(statement).mode("overwrite")
         .parquet(f"{folder}/data/batch={number}"))

    return _run(df.writeStream.foreachBatch(write or parquet), folder, every)


def flushing_sink(df: DataFrame, folder: str, statement: str, batch_rows: int, interval: str, write: Callable | None = None,
                  every: str = "1 second", salts: int = 1):
    """Batching sink over micro-batches: the rows of a statement are flushed as soon as ``batch_rows`` of them are there, or when
    the oldest has waited ``interval`` of processing time, whichever comes first; both survive a restart.

    A flush has a number per statement (and salt, which spreads a hot statement) in column ``flush`` and is written as one
    partition folder of its micro-batch, or by ``write(batch, number)``. Returns the running query; rows of open flushes
    wait in state when it is stopped, and overdue ones leave with the first micro-batch after a restart."""
    columns = [c for c in df.columns if c != statement]
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int")
    rows = df.select(F.col(statement), salt.alias("salt"), F.to_json(F.struct(*columns)).alias("payload"))
    kind = df.schema[statement].dataType.simpleString()
    flushed = rows.groupBy(statement, "salt").transformWithStateInPandas(
        FlushBuffer([statement, "salt"], batch_rows, micros(interval) // 1000),
        f"`{statement}` {kind}, salt INT, flush BIGINT, payload STRING", "Append", "ProcessingTime")
    back = flushed.select(statement, "salt", "flush", F.from_json("payload", df.select(*columns).schema).alias("__row")).select(statement, "salt", "flush", "__row.*")

    def parquet(batch: DataFrame, number: int) -> None:
        # a flush is bounded, so each is one file
        (batch.repartition(statement, "salt", "flush").write.partitionBy(statement, "salt", "flush").mode("overwrite")
         .parquet(f"{folder}/data/batch={number}"))

    return _run(back.writeStream.foreachBatch(write or parquet), folder, every)
