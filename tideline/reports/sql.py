"""The SQL surface: query shape, set operations, expressions and scalar functions."""

from pyspark.sql import functions as F

from ..functions import jsons, multisets, scalars
from ..operators.ranking import top_n
from ..plans.durations import micros
from ..plans.slices import Order, trailing_range
from ..sources.declared import extended
from .registry import report
from .windows import cents


def same(name, spark_text, duck_text=None):
    """Register SQL text for both sides; ``{table}`` placeholders become plain names for the check."""
    plain = duck_text or spark_text.replace("{", "").replace("}", "")
    report(name, plain)(lambda t: t.sql(spark_text))


RANGE_SQL = """
SELECT event_id, count(*) OVER w AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) AS total, max(value) OVER w AS top
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL '1' DAY PRECEDING AND CURRENT ROW)"""


def range_report(t, **limits):
    got = trailing_range(t.events.select("event_id", "user_id", "ts", "value"), ["user_id"], Order("ts"), {
        "n": ("count", None), "total": ("sum", cents("value")), "top": ("max", F.col("value"))},
        micros("1 day"), **limits)
    return got.select("event_id", "n", (F.col("total") / 100).alias("total"), "top")


@report("range_frame", RANGE_SQL)
def _(t):
    return range_report(t)


@report("range_frame_hot_keys", RANGE_SQL)
def _(t):
    return range_report(t, rows_per_group=25)


# windows below run over one row per user and day, so their groups are bounded by the days covered
DAILY = """(SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n, max(value) AS top FROM {events}
            GROUP BY user_id, CAST(ts AS DATE))"""
same("row_frames", f"""
SELECT user_id, day, CAST(sum(n) OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS BIGINT) AS around,
  CAST(sum(n) OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS remaining,
  max(top) OVER (PARTITION BY user_id ORDER BY day RANGE BETWEEN INTERVAL '3' DAY PRECEDING AND INTERVAL '1' DAY FOLLOWING) AS near_top
FROM {DAILY}""")
same("named_window", f"""
SELECT user_id, day, row_number() OVER w AS rn, first_value(n) OVER w AS first_n, lag(n) OVER w AS before
FROM {DAILY} WINDOW w AS (PARTITION BY user_id ORDER BY day)""")

for _name, _op in {"union_distinct": "UNION", "union_all": "UNION ALL", "intersect": "INTERSECT",
                   "intersect_all": "INTERSECT ALL", "except_distinct": "EXCEPT", "except_all": "EXCEPT ALL"}.items():
    same(f"set_{_name}", f"""SELECT c_nationkey AS k FROM {{customer}} WHERE c_acctbal > 5000
                             {_op} SELECT s_nationkey AS k FROM {{supplier}}""")
same("set_minus", "SELECT c_custkey AS k FROM {customer} MINUS SELECT o_custkey AS k FROM {orders} WHERE o_totalprice > 400000",
     "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey AS k FROM orders WHERE o_totalprice > 400000")

same("order_limit_offset", """
SELECT o_orderkey, o_totalprice FROM {orders} ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 50 OFFSET 10""")
same("order_nulls_first", """
SELECT o_orderkey, CASE WHEN o_totalprice > 1000 THEN o_totalprice END AS price FROM {orders}
ORDER BY price ASC NULLS FIRST, o_orderkey LIMIT 25""")
same("fetch_first", "SELECT c_custkey, c_acctbal FROM {customer} ORDER BY c_acctbal, c_custkey LIMIT 20",
     "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey FETCH FIRST 20 ROWS ONLY")
same("select_distinct", "SELECT DISTINCT c_mktsegment, c_nationkey FROM {customer} WHERE c_acctbal > 0")
same("select_filter", """
SELECT ALL l_orderkey AS o, l_linenumber AS l, l_extendedprice * (1 - l_discount) AS net FROM {lineitem} AS x
WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00' AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24""")
same("common_table_expression", """
WITH big AS (SELECT o_custkey, count(*) AS n FROM {orders} WHERE o_totalprice > 200000 GROUP BY o_custkey),
     rich AS (SELECT c_custkey, c_name FROM {customer} WHERE c_acctbal > 5000)
SELECT c_name, n FROM rich JOIN big ON c_custkey = o_custkey""")
same("values_and_rows", """
SELECT o_orderkey, label FROM {orders} JOIN (VALUES ('F', 'finished'), ('O', 'open')) AS v(status, label)
ON o_orderstatus = status""")


@report("explicit_table", "SELECT * FROM part")
def _(t):
    t.part.createOrReplaceTempView("tideline_part")
    return t.spark.sql("TABLE tideline_part")


@report("unnest_with_ordinality", """
SELECT ordinality, count(*) AS n, max(v) AS top FROM (
  SELECT unnest(embedding) AS v, generate_subscripts(embedding, 1) AS ordinality FROM embeddings) GROUP BY ordinality""")
def _(t):
    # positions are 0-based in Spark and 1-based in SQL
    flat = t.embeddings.select(F.posexplode("embedding").alias("p", "v"))
    return flat.groupBy((F.col("p") + 1).cast("long").alias("ordinality")).agg(
        F.count(F.lit(1)).alias("n"), F.max("v").alias("top"))


@report("pivot", """
SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O,
  count(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY o_orderpriority""")
def _(t):
    return t.orders.groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).count()


@report("unpivot", """
SELECT p_partkey, 'size' AS name, CAST(p_size AS DOUBLE) AS v FROM part
UNION ALL SELECT p_partkey, 'price', p_retailprice FROM part""")
def _(t):
    rows = t.part.select("p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price"))
    return rows.unpivot("p_partkey", ["size", "price"], "name", "v")


@report("table_sample")
def _(t):
    return t.orders.sample(fraction=0.1, seed=42).select("o_orderkey", "o_custkey")


same("conditional_expressions", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE 'other' END AS a,
  CASE WHEN o_totalprice > 300000 THEN 1 WHEN o_totalprice > 100000 THEN 2 END AS b,
  coalesce(nullif(o_orderpriority, '5-LOW'), 'none') AS c, CASE WHEN o_custkey = 3 THEN NULL ELSE o_custkey END AS d FROM {orders}""")
same("predicates", """
SELECT o_orderkey, o_orderpriority LIKE '%!_%' ESCAPE '!' AS a, o_orderpriority LIKE '_-%H%' AS b,
  o_orderstatus IN ('F', 'P') AS c, o_totalprice NOT BETWEEN 1000 AND 200000 AS d,
  nullif(o_orderstatus, 'F') IS DISTINCT FROM 'O' AS e, (nullif(o_orderstatus, 'P') = 'F') IS TRUE AS f,
  (nullif(o_orderstatus, 'P') = 'F') IS NULL AS g, (nullif(o_orderstatus, 'P') = 'F') IS NOT FALSE AS h,
  NOT (o_orderstatus = 'F' AND o_custkey > 100 OR o_custkey < 10) AS i FROM {orders}""")


@report("symmetric_and_similar", """
SELECT o_orderkey, o_totalprice BETWEEN 100000 AND 300000 AS sym,
  regexp_full_match(o_orderpriority, '[1-2]-(URGENT|HI.*)') AS sim, o_orderpriority SIMILAR TO '.-.*S.*' AS sim2 FROM orders""")
def _(t):
    return t.orders.select(
        "o_orderkey", scalars.between_symmetric("o_totalprice", F.lit(300000), F.lit(100000)).alias("sym"),
        scalars.similar_to("o_orderpriority", "[1-2]-(URGENT|HI%)").alias("sim"),
        scalars.similar_to("o_orderpriority", "_-%S%").alias("sim2"))


same("arithmetic", """
SELECT l_orderkey, l_linenumber, l_partkey + l_suppkey AS a, l_partkey - l_suppkey AS b, l_suppkey * 3 AS c,
  l_partkey div 7 AS d, l_partkey % 7 AS e, -l_linenumber AS f, l_returnflag || '/' || l_linestatus AS g,
  l_extendedprice / l_quantity AS h FROM {lineitem}""", """
SELECT l_orderkey, l_linenumber, l_partkey + l_suppkey AS a, l_partkey - l_suppkey AS b, l_suppkey * 3 AS c,
  l_partkey // 7 AS d, l_partkey % 7 AS e, -l_linenumber AS f, l_returnflag || '/' || l_linestatus AS g,
  l_extendedprice / l_quantity AS h FROM lineitem""")
same("casts_and_literals", """
SELECT event_id, CAST(value AS INT) AS a, try_cast(event_type AS INT) AS b, CAST(event_id AS STRING) AS c,
  CAST(ts AS DATE) AS d, ts + INTERVAL '1' DAY - INTERVAL '2' HOUR AS e, DATE '2024-02-29' AS f,
  array(event_id, user_id)[1] AS g, map('u', user_id)['u'] AS h, struct(value AS v, user_id AS u).u AS i
FROM {events}""", """
SELECT event_id, CAST(trunc(value) AS INT) AS a, try_cast(event_type AS INT) AS b, CAST(event_id AS VARCHAR) AS c,
  CAST(ts AS DATE) AS d, ts + INTERVAL '22' HOUR AS e, DATE '2024-02-29' AS f,
  user_id AS g, user_id AS h, user_id AS i FROM events""")


@report("join_hints", """
SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def _(t):
    return t.sql("""SELECT /*+ SHUFFLE_HASH(n) */ n_name, count(*) AS n FROM {customer} JOIN {nation} AS n
                    ON c_nationkey = n_nationkey GROUP BY n_name""")


@report("extended_table", "SELECT c_custkey, c_name, CAST(NULL AS INTEGER) AS loyalty FROM customer")
def _(t):
    return extended(t.spark, t.path("customer"), t.customer.select("c_custkey", "c_name").schema, {"loyalty": "int"})


same("string_functions", """
SELECT p_partkey, upper(p_name) AS a, lower(p_brand) AS b, substring(p_name FROM 2 FOR 3) AS c, trim(BOTH 'a' FROM p_type) AS d,
  trim(LEADING 'S' FROM p_type) AS e, trim(TRAILING 'L' FROM p_type) AS f, position('e' IN p_name) AS g,
  overlay(p_name PLACING '##' FROM 3 FOR 2) AS h, translate(p_name, 'abc', 'xyz') AS i, left(p_name, 3) AS j, right(p_name, 2) AS k,
  char_length(p_name) AS l, character_length(p_type) AS m, octet_length(p_name) AS n FROM {part}""", """
SELECT p_partkey, upper(p_name) AS a, lower(p_brand) AS b, substring(p_name, 2, 3) AS c, trim(p_type, 'a') AS d,
  ltrim(p_type, 'S') AS e, rtrim(p_type, 'L') AS f, position('e' IN p_name) AS g,
  p_name[:2] || '##' || p_name[5:] AS h, translate(p_name, 'abc', 'xyz') AS i, left(p_name, 3) AS j, right(p_name, 2) AS k,
  length(p_name) AS l, length(p_type) AS m, strlen(p_name) AS n FROM part""")


@report("convert_charset", """
SELECT doc_id, CAST(2 * length(text) AS BIGINT) + 2 * len(regexp_extract_all(text, '[\U00010000-\U0010FFFF]')) AS n, md5(text) AS digest
FROM documents""")
def _(t):
    # two bytes for most characters, four for the rest, and the same text back
    return t.documents.select("doc_id", F.length(F.encode("text", "UTF-16BE")).cast("long").alias("n"),
                              F.md5(scalars.convert_using("text", "UTF-16BE")).alias("digest"))


@report("numeric_functions", """
SELECT event_id, abs(value - 50) AS a, CAST(ceil(value) AS BIGINT) AS b, CAST(floor(value) AS BIGINT) AS c, round(exp(value / 1000), 8) AS d,
  round(ln(value + 1), 8) AS e, event_id % 7 AS f, round(power(value, 1.5), 4) AS g, round(sqrt(value), 8) AS h,
  trunc((50 - value) * 10) / 10 AS i FROM events""")
def _(t):
    base = t.events.withColumn("shifted", F.lit(50) - F.col("value"))
    return base.select(
        "event_id", F.abs(F.col("value") - 50).alias("a"), F.ceil("value").alias("b"), F.floor("value").alias("c"),
        F.round(F.exp(F.col("value") / 1000), 8).alias("d"), F.round(F.ln(F.col("value") + 1), 8).alias("e"),
        (F.col("event_id") % 7).alias("f"), F.round(F.pow("value", F.lit(1.5)), 4).alias("g"),
        F.round(F.sqrt("value"), 8).alias("h"), scalars.truncate("shifted", 1).alias("i"))


EXTRACTS = ["YEAR", "QUARTER", "MONTH", "WEEK", "DAY", "DOY", "HOUR", "MINUTE", "SECOND", "MILLISECOND", "MICROSECOND",
            "NANOSECOND", "DECADE", "CENTURY", "MILLENNIUM", "ISODOW", "ISOYEAR", "EPOCH", "DOW"]


@report("extract_functions", "SELECT event_id, " + ", ".join(
    f"CAST(floor(date_part('{u}', ts)) AS BIGINT) AS {u.lower()}_" for u in EXTRACTS
    if u not in ("DOW", "NANOSECOND")) + ", CAST(date_part('DOW', ts) + 1 AS BIGINT) AS dow_, "
    "CAST(date_part('MICROSECOND', ts) AS BIGINT) * 1000 AS nanosecond_ FROM events")
def _(t):
    return t.events.select("event_id", *[scalars.extract(u, "ts").alias(u.lower() + "_") for u in EXTRACTS])


@report("time_arithmetic", """
SELECT event_id, date_trunc('hour', ts) AS a,
  CASE WHEN date_trunc('day', ts) = ts THEN ts ELSE date_trunc('day', ts) + INTERVAL '1' DAY END AS b,
  ts + INTERVAL '3' MONTH AS c, ts - INTERVAL '90' MINUTE AS d,
  datesub('hour', TIMESTAMP '2024-01-01 00:00:00', ts) AS e, datesub('month', TIMESTAMP '2023-03-15 12:00:00', ts) AS f,
  year(ts) AS g, month(ts) AS h, hour(ts) AS i, minute(ts) AS j, second(ts) AS k FROM events""")
def _(t):
    return t.events.select(
        "event_id", scalars.floor_time("ts", "HOUR").alias("a"), scalars.ceil_time("ts", "DAY").alias("b"), *[
            F.expr(e) for e in (
                "timestampadd(MONTH, 3, ts) AS c", "timestampadd(MINUTE, -90, ts) AS d",
                "timestampdiff(HOUR, TIMESTAMP_NTZ '2024-01-01 00:00:00', ts) AS e",
                "timestampdiff(MONTH, TIMESTAMP_NTZ '2023-03-15 12:00:00', ts) AS f",
                "year(ts) AS g", "month(ts) AS h", "hour(ts) AS i", "minute(ts) AS j", "second(ts) AS k")])


@report("current_time_functions", "SELECT count(*) AS n, true AS ordered, true AS same_day FROM events")
def _(t):
    return t.events.agg(F.count(F.lit(1)).alias("n"),
                        F.every(F.col("ts") < F.localtimestamp()).alias("ordered"),
                        F.every(F.current_date() == F.to_date(F.current_timestamp())).alias("same_day"))


@report("date_format_functions", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:00') AS a, strptime(strftime(ts, '%Y%m%d%H%M%S'), '%Y%m%d%H%M%S') AS b,
  make_timestamp(epoch_us(ts) // 1000 * 1000) AS c FROM events""")
def _(t):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return t.events.select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:00").alias("a"),
        F.to_timestamp_ntz(F.date_format("ts", "yyyyMMddHHmmss"), F.lit("yyyyMMddHHmmss")).alias("b"),
        F.timestamp_millis(ms).cast("timestamp_ntz").alias("c"))


@report("json_functions", """
SELECT event_id, true AS a, false AS b, CAST(props->>'$.k' AS INTEGER) AS c, -1 AS d, NULL::VARCHAR AS e,
  '[' || (props->>'$.k') || ']' AS f, '{"k":' || (props->>'$.k') || '}' AS g,
  '{"id":' || event_id || ',"type":"' || event_type || '"}' AS h, '["' || event_type || '","x"]' AS i FROM events""")
def _(t):
    return t.events.select(
        "event_id", jsons.json_exists("props", "$.k").alias("a"), jsons.json_exists("props", "$.none").alias("b"),
        jsons.json_value("props", "$.k", "int").alias("c"), jsons.json_value("props", "$.none", "int", on_empty=-1).alias("d"),
        jsons.json_query("props", "$.k").alias("e"), jsons.json_query("props", "$.k", "conditional").alias("f"),
        jsons.json_query("props", "$").alias("g"), jsons.json_object(id="event_id", type="event_type").alias("h"),
        jsons.json_array(F.col("event_type"), F.lit(None).cast("string"), F.lit("x")).alias("i"))


@report("json_aggregates", """
SELECT user_id, '{' || string_agg('"' || event_type || '":' || n, ',' ORDER BY event_type) || '}' AS obj,
  '[' || string_agg(n, ',' ORDER BY event_type) || ']' AS arr FROM (
  SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) GROUP BY user_id""")
def _(t):
    # one row per user and type first, so each JSON value holds at most one entry per type
    counts = t.events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("user_id").agg(jsons.json_objectagg("event_type", "n").alias("obj"),
                                         jsons.json_arrayagg("n", "event_type").alias("arr"))


@report("collection_constructors", """
SELECT o_orderkey, o_custkey AS a, o_orderstatus AS b, 2 AS c, o_orderpriority AS d FROM orders""")
def _(t):
    return t.orders.select(
        "o_orderkey", F.array("o_orderkey", "o_custkey")[1].alias("a"),
        F.create_map(F.lit("s"), F.col("o_orderstatus"))["s"].alias("b"),
        F.size(F.array("o_orderkey", "o_custkey")).alias("c"),
        F.struct("o_orderkey", F.col("o_orderpriority").alias("p"))["p"].alias("d"))


@report("multiset_constructor", """
SELECT event_id, event_type AS only, 3::bigint AS total, CASE WHEN event_type = 'click' THEN 'a:1,click:2'
  WHEN event_type < 'click' THEN 'a:1,' || event_type || ':1,click:1' ELSE 'a:1,click:1,' || event_type || ':1' END AS counted FROM events""")
def _(t):
    made = multisets.multiset(F.lit("a"), "event_type", F.lit("click"))
    return t.events.select("event_id", multisets.element(multisets.multiset("event_type")).alias("only"),
                           multisets.cardinality(made).alias("total"), multisets.as_text(made).alias("counted"))


@report("context_functions", """
SELECT o_orderstatus, true AS has_user, true AS has_catalog, count(*) AS n FROM orders GROUP BY o_orderstatus""")
def _(t):
    return t.orders.groupBy("o_orderstatus").agg(
        (F.length(F.current_user()) > 0).alias("has_user"), (F.length(F.current_catalog()) > 0).alias("has_catalog"),
        F.count(F.lit(1)).alias("n"))


@report("top_n_per_group", """
SELECT o_custkey, o_orderkey, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
  ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 2""")
def _(t):
    return top_n(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"],
                 [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 2).drop("o_totalprice")
