"""Streaming queries drained over the whole table, checked like their batch twins.

Append mode reports what the final watermark has passed: the newest time minus the delay."""

from pyspark.sql import functions as F

from ..functions import multisets
from ..session import fresh_dir
from ..streaming import control, operators as streams
from ..streaming.runner import append_to_table, each_batch, latest_update, stream_parquet
from .aggregates import PATH_SQL, path_inputs
from .joins import CONTROL_SQL, FIRST_VALUE_SQL, INTERVAL_SQL, prop_k, session_sql
from .registry import report
from .windows import HOP_SQL, LATE_SQL, PUNCTUATED_SQL, SLIDING_SQL, arrivals_of

MARK = "(SELECT date_trunc('millisecond', max(ts)) FROM events {where}) - INTERVAL '{delay}'"
NOT_SIGNUP = "WHERE event_type <> 'signup'"


def mark(delay, where=""):
    return MARK.format(delay=delay, where=where)


def events(t, delay="1 hour", kind=None):
    df = stream_parquet(t.spark, t.path("events"), "ts", None)
    df = df.where(F.col("event_type") == kind) if kind else df
    return df.withWatermark("ts", delay)


def zoneless(df):
    return df.select(*[F.col(n).cast("timestamp_ntz").alias(n) if kind == "timestamp" else F.col(n) for n, kind in df.dtypes])


@report("stream_tumbling_window", f"""
SELECT * FROM (SELECT time_bucket(INTERVAL '1' HOUR, ts) AS window_start,
  time_bucket(INTERVAL '1' HOUR, ts) + INTERVAL '1' HOUR AS window_end, event_type, count(*) AS n FROM events GROUP BY 1, 2, 3)
WHERE window_end <= {mark('1 hour')}""")
def _(t):
    return zoneless(append_to_table(streams.windowed_counts(events(t), "ts", "1 hour", ["event_type"]), "tumble"))


@report("stream_hopping_window", f"""
WITH w AS (SELECT event_type, time_bucket(INTERVAL '30' MINUTE, ts) - i * INTERVAL '30' MINUTE AS window_start FROM events, range(0, 4) r(i))
SELECT * FROM (SELECT window_start, window_start + INTERVAL '2' HOUR AS window_end, event_type, count(*) AS n FROM w GROUP BY 1, 2, 3)
WHERE window_end <= {mark('1 hour')}""")
def _(t):
    return zoneless(append_to_table(streams.windowed_counts(events(t), "ts", "2 hours", ["event_type"], "30 minutes"), "hop"))


@report("stream_session_window", f"""
SELECT user_id, s AS session_start, e AS session_end, n FROM {session_sql('click', 8).replace("max(ts) +", "count(*) AS n, max(ts) +")}
WHERE e <= {mark('1 hour', "WHERE event_type = 'click'")}""")
def _(t):
    return zoneless(append_to_table(streams.session_counts(events(t, kind="click"), "ts", "8 hours", ["user_id"]), "session"))


@report("stream_pv_uv", f"""
SELECT * FROM (SELECT time_bucket(INTERVAL '1' HOUR, ts) AS window_start, count(*) AS pv, count(DISTINCT user_id) AS uv
  FROM events GROUP BY 1) WHERE window_start + INTERVAL '1' HOUR <= {mark('1 hour')}""")
def _(t):
    return zoneless(append_to_table(streams.pv_uv(events(t), "ts", "user_id"), "pv-uv"))


@report("stream_hot_items", HOP_SQL + f"""
SELECT * FROM (SELECT window_end, user_id, n,
  row_number() OVER (PARTITION BY window_end ORDER BY n DESC, user_id) AS rank FROM c)
WHERE rank <= 3 AND window_end <= {mark('1 hour', "WHERE event_type = 'view'")}""")
def _(t):
    got = streams.hot_items(events(t, kind="view"), "ts", "user_id", "60 minutes", "5 minutes", 3)
    return zoneless(got.select("window_end", "user_id", "n", "rank"))


@report("stream_early_results", """
SELECT time_bucket(INTERVAL '1' DAY, ts + INTERVAL '8' HOUR) - INTERVAL '8' HOUR AS window_start, event_type, count(*) AS n,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY ALL""")
def _(t):
    running = streams.early_results(events(t), "ts", "1 day", ["event_type"], [
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total")], "16 hours")
    updates = each_batch(running, "early", lambda batch, _: batch, mode="update")
    return zoneless(latest_update(updates, ["window_start", "event_type"]).withColumn("total", F.col("total").cast("double")))


@report("stream_lookup_join", """
SELECT event_id, user_id, c_name FROM events LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON user_id = c_custkey""")
def _(t):
    dim = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"), "c_name")
    return append_to_table(events(t).select("event_id", "user_id").join(dim, "user_id", "left"), "lookup")


@report("stream_mini_batch_lookup", """
SELECT event_id, user_id, c_name FROM events LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON user_id = c_custkey""")
def _(t):
    dim = lambda: t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"), "c_name")
    got = streams.mini_batch_lookup(events(t).select("event_id", "user_id"), dim, ["user_id"])
    return got.select("event_id", "user_id", "c_name")


@report("stream_interval_join", INTERVAL_SQL.format(how=""))
def _(t):
    left = events(t, kind="click").select(F.col("event_id").alias("click_id"), "user_id", F.col("ts").alias("click_ts"))
    right = events(t, kind="purchase").select(F.col("event_id").alias("purchase_id"), "user_id", F.col("ts").alias("pay_ts"), "value")
    got = streams.interval_join(left, right, "user_id", "click_ts", "pay_ts", "6 hours")
    return append_to_table(got, "interval").select("click_id", "purchase_id", "value")


@report("stream_first_rows", "SELECT DISTINCT user_id, event_type FROM events")
def _(t):
    # which of several equal keys comes first depends on arrival, so only the keys are reported
    keys = events(t, "90 days").dropDuplicatesWithinWatermark(["user_id", "event_type"])
    return append_to_table(keys.select("user_id", "event_type"), "dedup")


STREAM_RETRY_SQL = f"""
WITH f AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click'),
d AS (SELECT user_id, ts AS available_at, value FROM events WHERE event_type = 'signup'),
p AS (SELECT f.*, greatest(0, ceil((epoch_us(first_at) - epoch_us(ts)) / 21600000000.0))::BIGINT AS wait
      FROM f LEFT JOIN (SELECT user_id, min(available_at) AS first_at FROM d GROUP BY 1) USING (user_id)),
q AS (SELECT event_id, user_id, ts, CASE WHEN wait <= 4 THEN wait END AS attempt FROM p),
r AS (SELECT *, ts + to_microseconds(coalesce(attempt, 4) * 21600000000) AS probe FROM q)
SELECT r.event_id, r.user_id, CAST(r.attempt AS INTEGER) AS attempt, d.value AS profile_value
FROM r ASOF LEFT JOIN d ON r.user_id = d.user_id AND r.probe >= d.available_at
WHERE r.probe <= {mark('2 hours', "WHERE event_type IN ('click', 'signup')")}"""


@report("stream_retry_lookup_join", STREAM_RETRY_SQL)
def _(t):
    both = events(t, "2 hours")
    got = streams.versioned_lookup(
        both.where("event_type = 'click'"), both.where("event_type = 'signup'"), "user_id", "ts", "event_id", "ts", "event_id",
        F.lit(""), F.col("value"), delay="6 hours", probes=4, how="left", salts=2)
    return append_to_table(got, "retry").select(F.col("id").alias("event_id"), "user_id", "attempt",
                                                F.col("version").cast("double").alias("profile_value"))


@report("stream_asof_join", f"""
SELECT p.event_id, p.user_id, c.value AS click_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c ON p.user_id = c.user_id AND p.ts >= c.ts
WHERE p.ts <= {mark('2 hours', "WHERE event_type IN ('purchase', 'click')")}""")
def _(t):
    both = events(t, "2 hours")
    got = streams.versioned_lookup(
        both.where("event_type = 'purchase'"), both.where("event_type = 'click'"), "user_id", "ts", "event_id", "ts", "event_id",
        F.lit(""), F.col("value"))
    return append_to_table(got, "asof").select(F.col("id").alias("event_id"), "user_id", F.col("version").cast("double").alias("click_value"))


@report("stream_incremental_window", f"""
WITH s AS (SELECT event_type, time_bucket(INTERVAL '1' DAY, ts) AS w, ts, value FROM events),
f AS (SELECT event_type, w, w + i * INTERVAL '3' HOUR AS fire FROM (SELECT event_type, w, min(ts) AS first FROM s GROUP BY ALL),
      range(1, 9) r(i) WHERE w + i * INTERVAL '3' HOUR > first)
SELECT f.event_type, f.w AS window_start, f.fire AS fire_time, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM f JOIN s ON s.event_type = f.event_type AND s.w = f.w AND s.ts < f.fire WHERE f.fire <= {mark('1 hour')} GROUP BY ALL""")
def _(t):
    return zoneless(append_to_table(streams.incremental_window(events(t), "ts", "1 day", "3 hours", "event_type", "value"), "increment"))


@report("stream_count_window", """
SELECT user_id, (rn - 1) // 10 AS window_no, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)
GROUP BY ALL HAVING count(*) = 10""")
def _(t):
    return append_to_table(streams.count_windows(events(t), "user_id", "event_id", "value", 10), "count")


@report("stream_count_window_sliding", SLIDING_SQL)
def _(t):
    return append_to_table(streams.sliding_count_windows(events(t), "user_id", "event_id", "value", 20, 5), "slide")


@report("stream_incremental_distinct", f"""
WITH s AS (SELECT event_type, time_bucket(INTERVAL '1' DAY, ts) AS w, ts, user_id FROM events),
f AS (SELECT event_type, w, w + i * INTERVAL '3' HOUR AS fire FROM (SELECT event_type, w, min(ts) AS first FROM s GROUP BY ALL),
      range(1, 9) r(i) WHERE w + i * INTERVAL '3' HOUR > first)
SELECT f.event_type, f.w AS window_start, f.fire AS fire_time, count(*) AS pv, count(DISTINCT user_id) AS uv
FROM f JOIN s ON s.event_type = f.event_type AND s.w = f.w AND s.ts < f.fire WHERE f.fire <= {mark('1 hour')} GROUP BY ALL""")
def _(t):
    got = streams.incremental_distinct(events(t), "ts", "1 day", "3 hours", "event_type", "user_id")
    return zoneless(got.select("event_type", "window_start", "fire_time", F.col("n").alias("pv"), F.col("distinct").alias("uv")))


@report("stream_purchase_paths", PATH_SQL.rstrip() + f" AND pt <= {mark('2 hours', NOT_SIGNUP)}")
def _(t):
    _, config = path_inputs(t.events)
    user_events, _ = path_inputs(stream_parquet(t.spark, t.path("events"), "ts"))
    got = streams.purchase_paths(user_events.withWatermark("ts", "2 hours"), lambda: config)
    return zoneless(got.drop("batch").withColumn("event_type_counts", multisets.as_text("event_type_counts")))


@report("stream_routing", """
SELECT 'even' AS tag, event_id FROM events WHERE event_id % 2 = 0 UNION ALL SELECT 'odd', event_id FROM events WHERE event_id % 2 = 1""")
def _(t):
    folder = fresh_dir(t.spark, "routing")
    streams.route_stream(events(t).select("event_id"), folder, {"even": F.expr("event_id % 2 = 0"), "odd": F.expr("event_id % 2 = 1")})
    return t.spark.read.parquet(f"{folder}/data").select("tag", "event_id")


@report("stream_statement_sink", "SELECT event_type AS statement, event_id, value FROM events")
def _(t):
    folder = fresh_dir(t.spark, "statements")
    streams.statement_sink(events(t).select(F.col("event_type").alias("statement"), "event_id", "value"), folder, "statement", 1000)
    return t.spark.read.parquet(f"{folder}/data").select("statement", "event_id", "value")


# --- rows judged by what all of them share ---------------------------------------------------

def arriving(t):
    """Events as a stream with their arrival number, which no Spark watermark drops."""
    return arrivals_of(stream_parquet(t.spark, t.path("events")))


@report("stream_late_rows", LATE_SQL)
def _(t):
    return control.late_rows(arriving(t), "arrival", "ts", "30 minutes").select("event_id", "watermark", "is_late")


@report("stream_late_side_output", LATE_SQL.replace("SELECT event_id, watermark, coalesce(ts < watermark, false) AS is_late FROM m",
                                                    "SELECT event_id, CASE WHEN ts < watermark THEN 'late' ELSE 'main' END AS tag FROM m"))
def _(t):
    folder = fresh_dir(t.spark, "side")
    control.late_side_output(arriving(t), "arrival", "ts", "30 minutes", folder)
    return t.spark.read.parquet(f"{folder}/routed").select("event_id", "tag")


@report("stream_punctuated_watermark", PUNCTUATED_SQL)
def _(t):
    return control.punctuated_watermark(arriving(t), "arrival", "ts", F.col("event_type") == "signup").select("event_id", "watermark")


@report("stream_control_match", CONTROL_SQL)
def _(t):
    rows = stream_parquet(t.spark, t.path("events")).select("event_id", "ts", "event_type", prop_k().alias("k"))
    got = control.control_match(rows.where("event_type <> 'signup'"), rows.where("event_type = 'signup'"), "ts", "k", "k", tie="event_id")
    return got.select("event_id", "k", "matched")


@report("stream_first_value_enrich", FIRST_VALUE_SQL)
def _(t):
    rows = stream_parquet(t.spark, t.path("events"))
    got = control.first_value_enrich(rows.where("event_type = 'purchase'").select("event_id", "user_id"),
                                     rows.where("value > 200").select("user_id", "event_type", "ts"), "user_id", "event_type", "ts")
    return got.select("event_id", "user_id", "match")


@report("stream_order_board", """
WITH c AS (SELECT time_bucket(INTERVAL '1' DAY, ts) AS window_start, event_type, sum(CAST(value AS DECIMAL(18,2))) AS ct FROM events GROUP BY ALL)
SELECT window_start, CAST(total AS DOUBLE) AS total, rank, event_type, CAST(ct AS DOUBLE) AS category_total
FROM (SELECT *, sum(ct) OVER (PARTITION BY window_start) AS total, row_number() OVER (PARTITION BY window_start ORDER BY ct DESC, event_type) AS rank FROM c)
WHERE rank <= 3""")
def _(t):
    got = control.last_boards(control.order_board(events(t), "ts", "event_type", "value"))
    return zoneless(got.withColumn("total", F.col("total").cast("double")).withColumn("category_total", F.col("category_total").cast("double")))
