"""Queries over windows, triggers' batch twins and lateness."""

from pyspark.sql import functions as F

from ..operators import ranking, windows
from ..plans.slices import Order
from .joins import of_type, prop_k, session_sql
from .registry import report

ARRIVAL = Order("event_id")


def cents(column):
    """Amounts with two places as whole numbers: sums stay exact, and cheaper than decimals."""
    return F.round(F.col(column) * 100).cast("long")


def money(column):
    return F.sum(cents(column)) / 100


HOP_SQL = """
WITH w AS (SELECT user_id, to_timestamp_us, unnest(range(0, 12)) AS i FROM (
  SELECT user_id, time_bucket(INTERVAL '5' MINUTE, ts) AS to_timestamp_us FROM events WHERE event_type = 'view')),
c AS (SELECT to_timestamp_us - i * INTERVAL '5' MINUTE + INTERVAL '60' MINUTE AS window_end, user_id, count(*) AS n
      FROM w GROUP BY ALL)
"""


@report("hot_items", HOP_SQL + """
SELECT * FROM (SELECT window_end, user_id, n,
  row_number() OVER (PARTITION BY window_end ORDER BY n DESC, user_id) AS rank FROM c) WHERE rank <= 3""")
def _(t):
    views = of_type(t, "view").select("ts", "user_id")
    return ranking.hot_items(views, "ts", "user_id", "60 minutes", "5 minutes", 3).select(
        "window_end", "user_id", "n", "rank")


@report("tumbling_window", """
SELECT time_bucket(INTERVAL '5' MINUTE, ts) AS window_start,
  time_bucket(INTERVAL '5' MINUTE, ts) + INTERVAL '5' MINUTE AS window_end, event_type, count(*) AS n
FROM events GROUP BY ALL""")
def _(t):
    return windows.tumble(t.events, "ts", "5 minutes", ["event_type"], [F.count(F.lit(1)).alias("n")])


@report("hopping_window", """
WITH w AS (SELECT event_type, value, time_bucket(INTERVAL '10' MINUTE, ts) - i * INTERVAL '10' MINUTE AS window_start
  FROM events, range(0, 6) r(i))
SELECT window_start, window_start + INTERVAL '60' MINUTE AS window_end, event_type, count(*) AS n, max(value) AS top
FROM w GROUP BY ALL""")
def _(t):
    return windows.hop(t.events, "ts", "10 minutes", "60 minutes", ["event_type"],
                       [F.count(F.lit(1)).alias("n"), F.max("value").alias("top")])


@report("hopping_window_panes", """
WITH w AS (SELECT event_type, value, time_bucket(INTERVAL '10' MINUTE, ts) - i * INTERVAL '10' MINUTE AS window_start
  FROM events, range(0, 6) r(i))
SELECT window_start, window_start + INTERVAL '60' MINUTE AS window_end, event_type, count(*) AS n,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM w GROUP BY ALL""")
def _(t):
    got = windows.hop_from_panes(t.events, "ts", "10 minutes", "60 minutes", ["event_type"],
                                 {"n": F.count(F.lit(1)), "total": F.sum(cents("value"))})
    return got.withColumn("total", F.col("total") / 100)


@report("session_window", f"""
SELECT user_id, s AS session_start, e AS session_end, n, total FROM {session_sql('click', 8).replace(
  "max(ts) +", "count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, max(ts) +")}""")
def _(t):
    got = windows.sessions(of_type(t, "click"), ["user_id"], "ts", "8 hours",
                           {"total": F.sum(cents("value"))})
    return got.withColumn("total", F.col("total") / 100)


@report("session_window_global", f"""
SELECT s AS session_start, e AS session_end, n FROM {session_sql('purchase', 1).replace(
  'PARTITION BY user_id', '').replace('user_id, g', 'g').replace('SELECT user_id,', 'SELECT').replace(
  "max(ts) +", "count(*) AS n, max(ts) +")}""")
def _(t):
    return windows.sessions(of_type(t, "purchase"), [], "ts", "1 hour")


@report("window_times", """
SELECT time_bucket(INTERVAL '1' HOUR, ts) AS window_start,
  time_bucket(INTERVAL '1' HOUR, ts) + INTERVAL '1' HOUR AS window_end,
  time_bucket(INTERVAL '1' HOUR, ts) + INTERVAL '1' HOUR - INTERVAL '1' MILLISECOND AS window_rowtime,
  count(*) AS n FROM events GROUP BY ALL""")
def _(t):
    return windows.window_times(windows.tumble(t.events, "ts", "1 hour", [], [F.count(F.lit(1)).alias("n")]))


@report("offset_day_window", """
SELECT time_bucket(INTERVAL '1' DAY, ts + INTERVAL '8' HOUR) - INTERVAL '8' HOUR AS window_start, event_type,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY ALL""")
def _(t):
    return windows.tumble(t.events, "ts", "1 day", ["event_type"], [money("value").alias("total")],
                          offset="16 hours").drop("window_end")


COUNT_SQL = """
SELECT user_id, (rn - 1) // 10 AS window_no, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)
GROUP BY ALL HAVING count(*) = 10"""


@report("count_window_tumbling", COUNT_SQL)
def _(t):
    return windows.count_windows(t.events, ["user_id"], ARRIVAL, 10, [money("value").alias("total")])


@report("count_window_tumbling_hot_keys", COUNT_SQL)
def _(t):
    return windows.count_windows(t.events, ["user_id"], ARRIVAL, 10, [money("value").alias("total")],
                                 rows_per_group=25)


SLIDING_SQL = """
SELECT user_id, arrivals, rows_in_window, total FROM (
  SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS arrivals,
    count(*) OVER f AS rows_in_window, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER f AS DOUBLE) AS total
  FROM events WINDOW f AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
WHERE arrivals % 5 = 0"""


def sliding(t, **limits):
    got = windows.sliding_count_windows(t.events.select("event_id", "user_id", "value"), ["user_id"], ARRIVAL, 20, 5,
                                        {"total": cents("value")}, **limits)
    return got.withColumn("total", F.col("total") / 100)


@report("count_window_sliding", SLIDING_SQL)
def _(t):
    return sliding(t)


@report("count_window_sliding_hot_keys", SLIDING_SQL)
def _(t):
    return sliding(t, rows_per_group=25)


@report("evict_to_newest", """
SELECT window_start, window_start + INTERVAL '6' HOUR AS window_end, event_type, count(*) AS n, max(value) AS top FROM (
  SELECT time_bucket(INTERVAL '6' HOUR, ts) AS window_start, event_type, value, row_number() OVER (
    PARTITION BY time_bucket(INTERVAL '6' HOUR, ts), event_type ORDER BY ts DESC, event_id DESC) AS r FROM events)
WHERE r <= 5 GROUP BY ALL""")
def _(t):
    return windows.evict_to_newest(t.events, ["event_type"], "ts", "6 hours", 5, "event_id",
                                   [F.count(F.lit(1)).alias("n"), F.max("value").alias("top")])


@report("evict_older_than", """
SELECT window_start, window_start + INTERVAL '6' HOUR AS window_end, event_type, count(*) AS n FROM (
  SELECT time_bucket(INTERVAL '6' HOUR, ts) AS window_start, event_type, ts, max(ts) OVER (
    PARTITION BY time_bucket(INTERVAL '6' HOUR, ts), event_type) AS newest FROM events)
WHERE ts >= newest - INTERVAL '2' HOUR GROUP BY ALL""")
def _(t):
    return windows.evict_older_than(t.events, ["event_type"], "ts", "6 hours", "2 hours",
                                    [F.count(F.lit(1)).alias("n")])


# arrival order for the lateness reports: props.k minutes after the event's own time
ARRIVAL_SQL = """a AS (SELECT event_id, ts, event_type, epoch_us(ts) + CAST(props->>'$.k' AS BIGINT) * 60000000 AS arrival
  FROM events)"""


def arrivals_of(events):
    return events.select("event_id", "ts", "event_type",
                         (F.unix_micros(F.col("ts").cast("timestamp")) + prop_k().cast("long") * 60_000_000).alias("arrival"))


def arrivals(t):
    return arrivals_of(t.events)


LATE_SQL = f"""
WITH {ARRIVAL_SQL}, m AS (SELECT *, max(ts) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  - INTERVAL '30' MINUTE AS watermark FROM a)
SELECT event_id, watermark, coalesce(ts < watermark, false) AS is_late FROM m"""


@report("late_rows", LATE_SQL)
def _(t):
    return windows.late_rows(arrivals(t), "arrival", "ts", "30 minutes").select("event_id", "watermark", "is_late")


@report("late_rows_sliced", LATE_SQL)
def _(t):
    return windows.late_rows(arrivals(t), "arrival", "ts", "30 minutes", rows_per_group=500).select(
        "event_id", "watermark", "is_late")


PUNCTUATED_SQL = f"""
WITH {ARRIVAL_SQL}
SELECT event_id, max(CASE WHEN event_type = 'signup' THEN ts END) OVER (ORDER BY arrival
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS watermark FROM a"""


@report("punctuated_watermark", PUNCTUATED_SQL)
def _(t):
    return windows.punctuated_watermark(arrivals(t), "arrival", "ts", F.col("event_type") == "signup").select(
        "event_id", "watermark")


@report("lag_watermark", f"""
WITH {ARRIVAL_SQL} SELECT event_id, epoch_us(ts) < arrival - 2700000000 AS is_late FROM a""")
def _(t):
    rows = arrivals(t).withColumn("ingest", F.timestamp_micros("arrival"))
    return windows.lag_watermark_flag(rows, "ts", "ingest", "45 minutes").select("event_id", "is_late")


@report("row_bundles", """
WITH s AS (SELECT event_type, epoch_us(ts) // 21600000000 AS slot, event_id, row_number() OVER (
    PARTITION BY event_type, epoch_us(ts) // 21600000000 ORDER BY event_id) AS rn FROM events)
SELECT event_type, slot, (rn - 1) // 8 AS part, string_agg(event_id, ',' ORDER BY rn) AS items
FROM s GROUP BY ALL""")
def _(t):
    got = windows.bundles(t.events, ["event_type"], "ts", ARRIVAL, "6 hours", 8, F.col("event_id").cast("string"))
    return got.withColumn("items", F.array_join("items", ","))
