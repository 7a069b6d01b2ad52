"""Queries over sources, sinks, routing and formats. What they read back, they wrote from the tables
into the shared folder first."""

from pyspark.sql import functions as F

from ..session import fresh_dir
from ..sources import declared, delimited, envelope, kv, sinks, topics
from ..sources.partitioned import delete_partitions, merge_partitions, update_partitions
from .joins import prop_k
from .registry import report
from .windows import money


@report("csv_scan", """
SELECT user_id, CAST(props->>'$.k' AS BIGINT) AS item_id, user_id % 10 AS category_id, event_type AS behavior,
  epoch_us(ts) // 1000000 AS ts_seconds FROM events""")
def _(t):
    path = fresh_dir(t.spark, "csv")
    t.events.select("user_id", prop_k(), F.col("user_id") % 10, "event_type",
                    F.unix_seconds(F.col("ts").cast("timestamp"))).write.csv(path)
    return delimited.read_delimited(t.spark, path, delimited.USER_BEHAVIOR)


ROUTES = {"good": "o_totalprice > 300000", "atomic": "o_orderstatus = 'P'", "bad": "o_orderpriority = '5-LOW'"}
ROUTE_SQL = " UNION ALL ".join(f"SELECT '{tag}' AS tag, o_orderkey FROM orders WHERE {test}" for tag, test in ROUTES.items()) + (
    " UNION ALL SELECT 'unrouted', o_orderkey FROM orders WHERE NOT (" + " OR ".join(ROUTES.values()) + ")")


@report("routed_frames", ROUTE_SQL)
def _(t):
    parts = sinks.route(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"),
                        {tag: F.expr(test) for tag, test in ROUTES.items()})
    frames = [df.select(F.lit(tag).alias("tag"), "o_orderkey") for tag, df in parts.items()]
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


@report("routed_write", ROUTE_SQL)
def _(t):
    path = fresh_dir(t.spark, "routes")
    sinks.write_routed(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"), path,
                       {tag: F.expr(test) for tag, test in ROUTES.items()})
    return t.spark.read.parquet(path).select("tag", "o_orderkey")


def envelope_lines(t):
    document = F.to_json(F.struct(
        F.struct(F.concat("event_type", F.lit('@"x".org')).alias("mail"), F.col("user_id").cast("string").alias("guid"),
                 prop_k().cast("string").alias("status")).alias("condition"),
        F.struct(F.col("value").alias("logValue"), F.lit("status").alias("metric")).alias("entityMata"),
        F.lit(999).alias("status"), F.col("event_id").alias("traceId")))
    header = F.concat(F.lit("ANALYSIS,"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(",2,"))
    return t.events.select(F.when(F.col("value") > 100, F.lit("no envelope")).otherwise(F.concat(header, document)).alias("value"))


ENVELOPE = "mail STRING, guid STRING, status INT, metric STRING, logValue DOUBLE, traceId BIGINT, time STRING"


@report("envelope_read", """
SELECT event_type || '@"x".org' AS mail, CAST(user_id AS VARCHAR) AS guid, CAST(props->>'$.k' AS INTEGER) AS status,
  'status' AS metric, value AS "logValue", event_id AS "traceId", strftime(ts, '%Y-%m-%d %H:%M:%S') AS time
FROM events WHERE value <= 100""")
def _(t):
    return envelope.read_envelope(envelope_lines(t), ENVELOPE, on_error="drop")


@report("envelope_read_corrupt", """
SELECT count(*) AS n, count(*) FILTER (value > 100) AS bad FROM events""")
def _(t):
    kept = envelope.read_envelope(envelope_lines(t), ENVELOPE, on_error="keep")
    return kept.agg(F.count(F.lit(1)).alias("n"), F.count("_corrupt").alias("bad"))


@report("envelope_write", """
SELECT '{"event_id":' || event_id || ',"event_type":"' || event_type || '","missing":null}' AS value FROM events""")
def _(t):
    return envelope.write_envelope(t.events.withColumn("missing", F.lit(None).cast("string")),
                                   ["event_id", "event_type", "missing"])


@report("map_null_keys", """
SELECT o_orderkey, o_orderstatus = 'F' AS has_key, CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE 'none' END AS literal FROM orders""")
def _(t):
    pairs = F.array(F.struct(F.when(F.col("o_orderstatus") == "F", "F").alias("key"), F.col("o_custkey").alias("value")))
    rows = t.orders.withColumn("pairs", pairs)
    return rows.select("o_orderkey", (F.size(envelope.map_from_pairs("pairs", "drop")) == 1).alias("has_key"),
                       F.map_keys(envelope.map_from_pairs("pairs", "literal", "none"))[0].alias("literal"))


@report("topic_json", """
SELECT CAST(user_id AS VARCHAR) AS key, CAST(user_id AS VARCHAR) AS "userId", event_type AS "eventType",
  epoch_us(ts) // 1000 AS "eventTime", CAST(props->>'$.k' AS INTEGER) AS product, value AS price FROM events""")
def _(t):
    rows = t.events.select(
        F.col("user_id").cast("string").alias("userId"), F.lit("APP").alias("channel"), F.col("event_type").alias("eventType"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("eventTime"),
        F.struct(prop_k().alias("productId"), F.col("value").alias("price"), F.lit(1).alias("amount")).alias("data"))
    parsed = topics.parse_topic(topics.to_topic(rows, "userId"), topics.USER_EVENT)
    return parsed.select("key", "userId", "eventType", "eventTime", F.col("data.productId").alias("product"),
                         F.col("data.price").alias("price"))


@report("kv_scan", """
SELECT CAST(c_custkey AS VARCHAR) AS field, c_name AS value FROM customer WHERE CAST(c_custkey AS VARCHAR) GLOB '1*[0-4]'""")
def _(t):
    path = fresh_dir(t.spark, "kv")
    kv.store(t.customer.withColumn("k", F.col("c_custkey").cast("string")), path, "customer", "k", "c_name")
    kv.store(t.part.withColumn("k", F.col("p_partkey").cast("string")), path, "part", "k", "p_name")
    return kv.scan(t.spark, path, "customer", "1*[0-4]")


@report("kv_lookup", """
SELECT o_orderkey, CAST(c_custkey AS VARCHAR) AS field, c_name AS value FROM orders
LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0""")
def _(t):
    path = fresh_dir(t.spark, "kv")
    kv.store(t.customer.where("c_acctbal > 0").withColumn("k", F.col("c_custkey").cast("string")), path, "customer", "k", "c_name")
    table = kv.scan(t.spark, path, "customer")
    return t.orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("k")).join(
        table, F.col("k") == F.col("field"), "left").drop("k")


def command_log(t):
    op = (F.when(F.col("event_type") == "view", "SET").when(F.col("event_type") == "click", "SADD")
          .when(F.col("event_type") == "signup", F.when(F.col("value") > 60, "ZREM").otherwise("ZADD"))
          .when(F.col("event_type") == "error", F.when(F.col("value") > 30, "LPUSH").otherwise("RPUSH")).otherwise("HSET"))
    member = (prop_k() % 20).cast("string")
    is_zset = F.col("event_type") == "signup"
    return t.events.select(F.col("event_id").alias("seq"), op.alias("op"), F.concat(F.lit("u"), "user_id").alias("key"),
                           F.when(is_zset, F.col("event_id").cast("string")).otherwise(member).alias("field"),
                           F.when(is_zset | (F.col("event_type") == "click"), member)
                           .otherwise(F.col("event_id").cast("string")).alias("value"))


KV_FOLD_SQL = """
WITH e AS (SELECT event_id, event_type, value AS x, 'u' || user_id AS key, CAST(CAST(props->>'$.k' AS INTEGER) % 20 AS VARCHAR) AS m,
  CAST(event_id AS VARCHAR) AS id FROM events),
z AS (SELECT *, row_number() OVER (PARTITION BY key, m ORDER BY event_id DESC) AS r FROM e WHERE event_type = 'signup'),
l AS (SELECT key, id, row_number() OVER (PARTITION BY key ORDER BY CASE WHEN x > 30 THEN 0 ELSE 1 END,
  CASE WHEN x > 30 THEN -event_id ELSE event_id END) - 1 AS p FROM e WHERE event_type = 'error')
SELECT 'string' AS kind, key, NULL::VARCHAR AS field, arg_max(id, event_id) AS value, NULL::BIGINT AS position FROM e WHERE event_type = 'view' GROUP BY key
UNION ALL SELECT 'hash', key, m, arg_max(id, event_id), NULL FROM e WHERE event_type = 'purchase' GROUP BY key, m
UNION ALL SELECT DISTINCT 'set', key, m, NULL, NULL FROM e WHERE event_type = 'click'
UNION ALL SELECT 'zset', key, m, id, NULL FROM z WHERE r = 1 AND x <= 60
UNION ALL SELECT 'list', key, NULL, id, p FROM l"""


@report("kv_command_fold", KV_FOLD_SQL)
def _(t):
    return kv.fold_commands(command_log(t))


@report("kv_command_fold_hot_keys", KV_FOLD_SQL)
def _(t):
    return kv.fold_commands(command_log(t), rows_per_group=8)


@report("kv_distinct_sketch")
def _(t):
    log = t.events.select(F.lit("PFADD").alias("op"), F.col("event_type").alias("key"), F.col("user_id").alias("value"))
    return kv.distinct_sketch(log)


@report("kv_publish", "SELECT event_id AS seq, CAST(value AS VARCHAR) AS value FROM events WHERE event_type = 'error'")
def _(t):
    log = t.events.select(F.col("event_id").alias("seq"), F.lit("PUBLISH").alias("op"), F.col("event_type").alias("key"),
                          F.col("value").cast("string").alias("value"))
    return kv.published(log, "error")


@report("rolling_sink", """
SELECT 'audit-' || strftime(ts, '%Y-%m-%d') AS target, count(*) AS n FROM events GROUP BY 1""")
def _(t):
    path = fresh_dir(t.spark, "rolling")
    sinks.write_rolling(t.events.select("event_id", "ts"), path, "audit-", "ts")
    return t.spark.read.parquet(path).groupBy("target").agg(F.count(F.lit(1)).alias("n"))


@report("insert_overwrite_partitions", """
SELECT o_orderkey, o_totalprice, o_orderstatus AS status, CASE WHEN o_orderstatus = 'F' THEN 'new' ELSE 'old' END AS load
FROM orders WHERE o_orderstatus <> 'F' OR o_totalprice > 100000
UNION ALL SELECT l_orderkey, l_extendedprice, 'X', 'static' FROM lineitem WHERE l_linenumber = 1""")
def _(t):
    path = fresh_dir(t.spark, "partitions")
    rows = t.orders.select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("status"))
    sinks.insert_partitions(rows.withColumn("load", F.lit("old")), path, ["status"])
    sinks.insert_partitions(rows.where("status = 'F' AND o_totalprice > 100000").withColumn("load", F.lit("new")), path,
                            ["status"], overwrite=True)
    extra = t.lineitem.where("l_linenumber = 1").select(F.col("l_orderkey").alias("o_orderkey"),
                                                        F.col("l_extendedprice").alias("o_totalprice"), F.lit("static").alias("load"))
    sinks.insert_partitions(extra, path, ["status"], static={"status": "X"}, columns=["o_orderkey", "o_totalprice", "load"])
    return t.spark.read.parquet(path).select("o_orderkey", "o_totalprice", "status", "load")


@report("declared_table", """
SELECT event_id, ts, value, value * 2 AS double_value, CAST(props->>'$.k' AS INTEGER) AS k, 'events.parquet' AS file FROM events""")
def _(t):
    table = declared.Declaration(
        columns=("event_id", "ts", "value", "props"), metadata={"file": "_metadata.file_name"},
        computed={"double_value": "value * 2", "k": "CAST(get_json_object(props, '$.k') AS INT)"},
        watermark=None, primary_key=("event_id",))
    return table.apply(t.events).drop("props")


@report("key_report", """
SELECT 'primary' AS kind, 'user_id,k' AS key, 0::BIGINT AS null_rows,
  count(*) FILTER (n > 1) AS duplicate_keys, sum(n - 1)::BIGINT AS surplus_rows
FROM (SELECT user_id, props->>'$.k' AS k, count(*) AS n FROM events GROUP BY ALL)
UNION ALL SELECT 'unique', 'v', sum(n) FILTER (v IS NULL)::BIGINT, count(*) FILTER (v IS NOT NULL AND n > 1),
  sum(n - 1) FILTER (v IS NOT NULL)::BIGINT FROM (SELECT CASE WHEN value < 100 THEN value END AS v, count(*) AS n FROM events GROUP BY ALL)""")
def _(t):
    rows = t.events.select("user_id", prop_k().alias("k"), F.when(F.col("value") < 100, F.col("value")).alias("v"))
    return declared.key_report(rows, ["user_id", "k"], [["v"]])


@report("temporary_view", """
SELECT segment, count(*) AS n FROM (SELECT c_mktsegment AS segment, c_acctbal AS balance FROM customer) WHERE balance > 0 GROUP BY segment""")
def _(t):
    t.customer.select("c_mktsegment", "c_acctbal").createOrReplaceTempView("tideline_customer")
    t.spark.sql("CREATE OR REPLACE TEMPORARY VIEW tideline_balance (segment, balance) AS SELECT * FROM tideline_customer")
    return t.spark.sql("SELECT segment, count(*) AS n FROM tideline_balance WHERE balance > 0 GROUP BY segment")


@report("batched_statement_totals", """
SELECT o_orderpriority AS statement, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1""")
def _(t):
    return t.orders.groupBy(F.col("o_orderpriority").alias("statement")).agg(money("o_totalprice").alias("total"))


# --- statements on partitioned tables --------------------------------------------------------

def orders_by_year(t):
    path = fresh_dir(t.spark, "orders")
    rows = t.orders.select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"), F.year("o_orderdate").alias("year"))
    rows.write.partitionBy("year").parquet(path)
    return path, rows


def priced(t, path):
    return t.spark.read.parquet(path).select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("double").alias("o_totalprice"), F.col("year").cast("long").alias("year"))


YEARS = "SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS price, year(o_orderdate) AS year FROM orders"


@report("merge_partitions", f"""
WITH o AS ({YEARS})
SELECT o_orderkey, CASE WHEN year = 1995 AND o_orderkey % 7 = 0 THEN 'M' ELSE o_orderstatus END AS o_orderstatus, CAST(price AS DOUBLE) AS o_totalprice, year
FROM o WHERE NOT (year = 1995 AND o_orderkey % 21 = 0)
UNION ALL SELECT -o_orderkey, 'N', 1.5, 1995 FROM o WHERE year = 1996 AND o_orderkey % 50 = 0""")
def _(t):
    path, rows = orders_by_year(t)
    changed = rows.where("year = 1995 AND o_orderkey % 7 = 0").select("o_orderkey", F.lit("M").alias("o_orderstatus"), "o_totalprice", "year", (F.col("o_orderkey") % 21 == 0).alias("gone"))
    added = rows.where("year = 1996 AND o_orderkey % 50 = 0").select((-F.col("o_orderkey")).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"),
                                                                      F.lit("1.5").cast("decimal(18,2)").alias("o_totalprice"), F.lit(1995).alias("year"), F.lit(False).alias("gone"))
    merge_partitions(path, changed.unionByName(added), ["o_orderkey"], ["year"], "gone")
    return priced(t, path)


@report("update_and_delete_partitions", f"""
WITH o AS ({YEARS})
SELECT o_orderkey, CASE WHEN year = 1994 AND price > 200000 THEN 'U' ELSE o_orderstatus END AS o_orderstatus, CAST(price AS DOUBLE) AS o_totalprice, year
FROM o WHERE NOT (year = 1993 OR price < 20000)""")
def _(t):
    path, _ = orders_by_year(t)
    update_partitions(t.spark, path, (F.col("year") == 1994) & (F.col("o_totalprice") > 200000), {"o_orderstatus": F.lit("U")}, ["year"])
    delete_partitions(t.spark, path, (F.col("year") == 1993) | (F.col("o_totalprice") < 20000), ["year"])
    return priced(t, path)
