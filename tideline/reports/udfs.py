"""Queries over user-defined scalar, table and aggregate functions."""

from pyspark.sql import functions as F

from ..functions import udfs
from ..operators import aggregates
from .joins import prop_k
from .registry import report


@report("scalar_functions", """
SELECT event_id, event_id + 1 AS a, CASE WHEN value > 20 THEN event_type ELSE 'null' END || '-' || user_id AS b,
  event_id * user_id * CAST(props->>'$.k' AS BIGINT) AS c, ts - INTERVAL '1500' MILLISECOND AS d, event_type AS e, user_id * 2 AS f FROM events""")
def _(t):
    rows = t.events.withColumn("maybe", F.when(F.col("value") > 20, F.col("event_type"))).withColumn("k", prop_k().cast("long"))
    return rows.select("event_id", udfs.increment("event_id").alias("a"),
                       udfs.concat_with_null("maybe", "user_id", separator="-").alias("b"),
                       udfs.product("event_id", "user_id", "k").alias("c"), udfs.time_minus("ts", 1500).alias("d"),
                       udfs.nested_row("event_type", "user_id")["name"].alias("e"),
                       udfs.nested_row("event_type", "user_id")["inner"]["twice"].alias("f"))


@report("python_functions", """
SELECT event_id, event_id + 1 AS batch, event_id + 1 AS one, 'tag-' || event_type AS prefixed, upper(event_type) AS up,
  length(event_type)::INTEGER AS size FROM events""")
def _(t):
    rows = t.events.select("event_id", "event_type", udfs.increment_batch("event_id").alias("batch"),
                           udfs.increment_row("event_id").alias("one"), udfs.prefixer("tag")("event_type").alias("prefixed"),
                           udfs.describe("event_type").alias("d"))
    return rows.select("event_id", "batch", "one", "prefixed", F.col("d.upper").alias("up"), F.col("d.size").alias("size"))


@report("registered_functions", """
SELECT user_id, sum(event_id + 1)::BIGINT AS a, sum(event_id * user_id)::BIGINT AS b FROM events GROUP BY user_id""")
def _(t):
    udfs.register_all(t.spark)
    return t.sql("""SELECT user_id, sum(increment_batch(event_id)) AS a, sum(weighted(event_id, user_id)) AS b
                    FROM {events} GROUP BY user_id""")


@report("split_function", """
SELECT p_partkey, unnest(list_filter(regexp_split_to_array(p_name, '[ e]'), lambda x: x <> '')[2:]) AS piece FROM part""")
def _(t):
    return t.part.select("p_partkey", udfs.split_text("p_name", " e", 1).alias("piece"))


@report("python_table_function", """
SELECT p_partkey, unnest(w) AS word, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS position FROM (
  SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)""")
def _(t):
    udfs.register_all(t.spark)
    return t.sql("SELECT p_partkey, word, position FROM {part}, LATERAL split_words(p_name, ' ')")


@report("row_emitting_functions", """
SELECT event_id, unnest([(ts::DATE - DATE '1970-01-01')::BIGINT, user_id, epoch_us(ts) // 1000]) AS v FROM events""")
def _(t):
    return t.events.withColumn("d", F.to_date("ts")).select("event_id", udfs.emit_three("d", "user_id", "ts").alias("v"))


@report("repeated_rows", """
SELECT p_partkey, p_brand AS copy FROM part, range(0, 60) r(i) WHERE i < p_size""")
def _(t):
    return t.part.select("p_partkey", udfs.repeat_rows("p_brand", "p_size").alias("copy"))


@report("twelve_columns", "SELECT p_partkey, " + ", ".join(f"p_type || '_{c}' AS t_{c}" for c in "abcdef") + ", " + ", ".join(
    f"CAST(length(p_type) + {i} AS INTEGER) AS n_{i}" for i in range(6)) + ", CAST(length(p_type) + length(p_brand) AS INTEGER) AS total FROM part")
def _(t):
    rows = t.part.withColumn("total", udfs.total_length("p_type", "p_brand"))
    return udfs.twelve_columns(rows, "p_type", ["p_partkey", "total"])


@report("random_piece")
def _(t):
    return t.part.select("p_partkey", udfs.pick_one("p_name", " ").alias("piece"), udfs.random_label()().alias("label"))


@report("weighted_average", """
SELECT event_type, CAST(sum(user_id * k) // nullif(sum(k), 0) AS BIGINT) AS wavg,
  CAST(sum(user_id * k * s) // nullif(sum(k * s), 0) AS BIGINT) AS net_wavg
FROM (SELECT *, CAST(props->>'$.k' AS BIGINT) AS k, CASE WHEN value > 200 THEN -1 ELSE 1 END AS s FROM events) GROUP BY event_type""")
def _(t):
    rows = t.events.withColumn("k", prop_k().cast("long")).withColumn("s", F.when(F.col("value") > 200, -1).otherwise(1))
    return rows.groupBy("event_type").agg(aggregates.weighted_average("user_id", "k").alias("wavg"),
                                          aggregates.weighted_average("user_id", "k", "s").alias("net_wavg"))


@report("retractable_distinct", """
SELECT user_id, count(*) FILTER (n > 0) AS live FROM (SELECT user_id, props->>'$.k' AS k,
  sum(CASE WHEN event_type = 'error' THEN -1 ELSE 1 END) AS n FROM events GROUP BY ALL) GROUP BY user_id""")
def _(t):
    rows = t.events.select("user_id", prop_k().alias("k"), F.when(F.col("event_type") == "error", -1).otherwise(1).alias("s"))
    return aggregates.distinct_after_retractions(rows, ["user_id"], "k", "s", "live")


@report("multi_argument_aggregates", """
SELECT user_id, count(*) FILTER (v IS NOT NULL AND k IS NOT NULL) AS both_n, sum(event_id + user_id)::BIGINT AS total,
  (count(DISTINCT event_type) + sum(event_id))::BIGINT AS mixed, max(event_id) AS top_long, max(event_type) AS top_text
FROM (SELECT *, CASE WHEN value > 20 THEN value END AS v, nullif(CAST(props->>'$.k' AS INTEGER), 7) AS k FROM events) GROUP BY user_id""")
def _(t):
    rows = t.events.withColumn("v", F.when(F.col("value") > 20, F.col("value"))).withColumn("k", F.nullif(prop_k(), F.lit(7)))
    return rows.groupBy("user_id").agg(
        aggregates.both_present("v", "k").alias("both_n"), F.sum(F.col("event_id") + F.col("user_id")).alias("total"),
        aggregates.distinct_plus_sum("event_type", "event_id").alias("mixed"),
        F.max("event_id").alias("top_long"), F.max("event_type").alias("top_text"))


@report("table_aggregate", """
SELECT user_id, m AS max_value FROM (SELECT user_id, max(value) AS m FROM events GROUP BY user_id), range(0, 2)""")
def _(t):
    return aggregates.emit_max_twice(t.events, ["user_id"], "value")
