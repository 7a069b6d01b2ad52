"""Queries over the join operators."""

from pyspark.sql import functions as F

from ..operators import joins, temporal
from ..operators.windows import sessions
from ..plans.skew import salted_join
from .registry import report


def of_type(t, kind):
    return t.events.where(F.col("event_type") == kind)


def prop_k():
    return F.get_json_object("props", "$.k").cast("int")


@report("lookup_join_left", """
SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM orders
LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey""")
def _(t):
    dim = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return joins.lookup_join(t.orders.select("o_orderkey", "o_custkey"), dim, ["o_custkey"], "left")


@report("lookup_join_inner", """
SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM orders
JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey""")
def _(t):
    dim = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return joins.lookup_join(t.orders.select("o_orderkey", "o_custkey"), dim, ["o_custkey"], "inner")


RETRY_SQL = """
WITH f AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click'),
d AS (SELECT user_id, ts AS available_at, value, event_id AS v FROM events WHERE event_type = 'signup'),
firsts AS (SELECT user_id, min(available_at) AS first_at FROM d GROUP BY 1),
p AS (SELECT f.*, greatest(0, ceil((epoch_us(first_at) - epoch_us(ts)) / 21600000000.0))::BIGINT AS wait
      FROM f LEFT JOIN firsts USING (user_id)),
q AS (SELECT event_id, user_id, ts, CASE WHEN wait <= 4 THEN wait END AS attempt FROM p),
r AS (SELECT *, ts + to_microseconds(attempt * 21600000000) AS probe FROM q)
SELECT r.event_id, r.user_id, r.attempt, d.value AS profile_value
FROM r ASOF {how} JOIN d ON r.user_id = d.user_id AND r.probe >= d.available_at"""


def retry(t, how, **limits):
    dim = of_type(t, "signup").select("user_id", F.col("ts").alias("available_at"), "value", "event_id")
    facts = of_type(t, "click").select("event_id", "user_id", "ts")
    got = temporal.retry_lookup_join(facts, dim, "user_id", "ts", "available_at", {"profile_value": "value"},
                                     delay="6 hours", retries=3, how=how, tie="event_id", **limits)
    return got.select("event_id", "user_id", "attempt", "profile_value")


@report("retry_lookup_join_left", RETRY_SQL.format(how="LEFT"))
def _(t):
    return retry(t, "left")


@report("retry_lookup_join_inner", RETRY_SQL.format(how="").replace("ASOF  JOIN", "ASOF JOIN"))
def _(t):
    return retry(t, "inner")


@report("keyed_lookup_join", """
SELECT p_brand, count(*) AS n, count(DISTINCT l_orderkey) AS orders,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""")
def _(t):
    dim = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    facts = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    joined = joins.keyed_lookup_join(facts, dim, ["l_partkey"], "inner")
    return joined.groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("l_orderkey").alias("orders"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity"))


@report("keyed_lookup_join_salted", """
SELECT event_id, e.user_id, c_name FROM events e LEFT JOIN customer ON user_id = c_custkey""")
def _(t):
    # a low limit makes every busy user a hot key, so the salted path itself is checked
    dim = t.customer.select(F.col("c_custkey").alias("user_id"), "c_name")
    return salted_join(t.events.select("event_id", "user_id"), dim, ["user_id"], "left", rows_per_group=60)


@report("broadcast_lookup_join", """
SELECT s_suppkey, s_name, n_name, r_name FROM supplier
LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def _(t):
    nation = t.nation.withColumnRenamed("n_nationkey", "s_nationkey")
    region = t.region.withColumnRenamed("r_regionkey", "n_regionkey")
    got = joins.broadcast_lookup_join(t.supplier, nation, ["s_nationkey"])
    got = joins.broadcast_lookup_join(got, region, ["n_regionkey"])
    return got.select("s_suppkey", "s_name", "n_name", "r_name")


ASOF_SQL = """
SELECT p.event_id, p.user_id, p.value, c.event_id AS click_id, c.value AS click_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c
ON p.user_id = c.user_id AND p.ts >= c.ts"""


def asof(t, **limits):
    left = of_type(t, "purchase").select("event_id", "user_id", "ts", "value")
    right = of_type(t, "click")
    return temporal.asof_join(left, right, ["user_id"], "ts", "ts",
                              {"click_id": "event_id", "click_value": "value"}, tie="event_id", **limits).drop("ts")


@report("asof_join", ASOF_SQL)
def _(t):
    return asof(t)


@report("asof_join_hot_keys", ASOF_SQL)
def _(t):
    # a low limit makes every user hot, so the sliced path itself is checked
    return asof(t, rows_per_group=10)


LATEST_SQL = """
SELECT p.event_id, p.value, CASE WHEN p.value > c.value THEN c.event_id END AS error_id
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') c ON p.ts >= c.ts"""


def latest(t, **limits):
    left = of_type(t, "purchase").select("event_id", "ts", "value")
    got = temporal.latest_row_join(left, of_type(t, "error"), "ts", "ts",
                                   {"error_id": "event_id", "error_value": "value"},
                                   F.col("value") > F.col("error_value"), tie="event_id", **limits)
    return got.select("event_id", "value", "error_id")


@report("latest_row_join", LATEST_SQL)
def _(t):
    return latest(t)


@report("latest_row_join_sliced", LATEST_SQL)
def _(t):
    return latest(t, rows_per_group=200)


CONTROL_SQL = """
WITH k AS (SELECT event_id, ts, event_type, CAST(props->>'$.k' AS INTEGER) AS k FROM events)
SELECT d.event_id, d.k, 1 AS matched FROM (SELECT * FROM k WHERE event_type <> 'signup') d
ASOF JOIN (SELECT * FROM k WHERE event_type = 'signup') c ON d.ts >= c.ts WHERE d.k = c.k"""


@report("control_match", CONTROL_SQL)
def _(t):
    rows = t.events.select("event_id", "ts", "event_type", prop_k().alias("k"))
    got = temporal.control_match(rows.where("event_type <> 'signup'"), rows.where("event_type = 'signup'"),
                                 "ts", "k", "k", tie="event_id")
    return got.select("event_id", "k", "matched")


FIRST_VALUE_SQL = """
WITH c AS (SELECT user_id, arg_min(event_type, ts) AS v FROM events WHERE value > 200 GROUP BY user_id)
SELECT event_id, e.user_id, coalesce(v, 'No match') AS match
FROM events e LEFT JOIN c ON e.user_id = c.user_id WHERE event_type = 'purchase'"""


@report("first_value_enrich", FIRST_VALUE_SQL)
def _(t):
    data = of_type(t, "purchase").select("event_id", "user_id")
    return joins.first_value_enrich(data, t.events.where("value > 200"), "user_id", "event_type", "ts")


@report("regular_join_inner", """
SELECT o_orderkey, l_linenumber, l_quantity, o_totalprice FROM orders JOIN lineitem ON o_orderkey = l_orderkey
WHERE o_orderstatus = 'F'""")
def _(t):
    orders = t.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")
    items = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity")
    return orders.join(items, "o_orderkey")


OUTER_SQL = """
SELECT c_custkey, o_orderkey FROM (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') c
{how} JOIN (SELECT * FROM orders WHERE o_orderstatus = 'O') o ON c_custkey = o_custkey"""


def outer(t, how):
    c = t.customer.where("c_mktsegment = 'BUILDING'").select("c_custkey")
    o = t.orders.where("o_orderstatus = 'O'").select("o_orderkey", "o_custkey")
    return c.join(o, F.col("c_custkey") == F.col("o_custkey"), how).select("c_custkey", "o_orderkey")


@report("regular_join_left", OUTER_SQL.format(how="LEFT"))
def _(t):
    return outer(t, "left")


@report("regular_join_right", OUTER_SQL.format(how="RIGHT"))
def _(t):
    return outer(t, "right")


@report("regular_join_full", OUTER_SQL.format(how="FULL"))
def _(t):
    return outer(t, "full")


INTERVAL_SQL = """
SELECT c.event_id AS click_id, p.event_id AS purchase_id, p.value
FROM (SELECT * FROM events WHERE event_type = 'click') c
{how} JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
ON c.user_id = p.user_id AND p.ts BETWEEN c.ts AND c.ts + INTERVAL '6' HOUR"""


def intervals(t, how):
    left = of_type(t, "click").select(F.col("event_id").alias("click_id"), "user_id", F.col("ts").alias("click_ts"))
    right = of_type(t, "purchase").select(F.col("event_id").alias("purchase_id"), "user_id", "ts", "value")
    return joins.interval_join(left, right, ["user_id"], "click_ts", "ts", "0 hours", "6 hours", how,
                               row_id=["click_id"]).select("click_id", "purchase_id", "value")


@report("interval_join_inner", INTERVAL_SQL.format(how=""))
def _(t):
    return intervals(t, "inner")


@report("interval_join_left", INTERVAL_SQL.format(how="LEFT"))
def _(t):
    return intervals(t, "left")


@report("theta_join", """
SELECT o_orderkey, l_linenumber FROM orders JOIN lineitem
ON nullif(o_orderkey, 3) = l_orderkey AND l_shipdate > o_orderdate AND l_extendedprice * 4 > o_totalprice""")
def _(t):
    left = t.orders.withColumn("k", F.when(F.col("o_orderkey") != 3, F.col("o_orderkey")))
    cond = ((F.col("k") == F.col("l_orderkey")) & (F.col("l_shipdate") > F.col("o_orderdate"))
            & (F.col("l_extendedprice") * 4 > F.col("o_totalprice")))
    return joins.theta_join(left, t.lineitem, cond).select("o_orderkey", "l_linenumber")


@report("comma_join", """
SELECT c_custkey, n_name, r_name FROM customer, nation, region
WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey AND r_name <> 'ASIA'""")
def _(t):
    return t.sql("""SELECT c_custkey, n_name, r_name FROM {customer}, {nation}, {region}
                    WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey AND r_name <> 'ASIA'""")


@report("natural_join", """
SELECT * FROM (SELECT c_custkey AS k, c_name FROM customer)
NATURAL JOIN (SELECT o_custkey AS k, o_orderkey FROM orders)""")
def _(t):
    return t.sql("""SELECT * FROM (SELECT c_custkey AS k, c_name FROM {customer})
                    NATURAL JOIN (SELECT o_custkey AS k, o_orderkey FROM {orders})""")


@report("join_using", """
SELECT k, o_totalprice, l_quantity FROM (SELECT o_orderkey AS k, o_totalprice FROM orders)
JOIN (SELECT l_orderkey AS k, l_quantity FROM lineitem WHERE l_linenumber = 1) USING (k)""")
def _(t):
    orders = t.orders.select(F.col("o_orderkey").alias("k"), "o_totalprice")
    items = t.lineitem.where("l_linenumber = 1").select(F.col("l_orderkey").alias("k"), "l_quantity")
    return orders.join(items, on=["k"])


APPLY = """
SELECT c_custkey, biggest, n FROM {customer} {how} LATERAL (
  SELECT max(o_totalprice) AS biggest, count(*) AS n FROM {orders}
  WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT' GROUP BY o_custkey) x {on}"""


@report("cross_apply", """SELECT c_custkey, biggest, n FROM customer, LATERAL (
  SELECT max(o_totalprice) AS biggest, count(*) AS n FROM orders
  WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT' GROUP BY o_custkey) x""")
def _(t):
    return t.sql(APPLY.replace("{how}", ",").replace("{on}", ""))


@report("outer_apply", """
SELECT c_custkey, biggest, n FROM customer LEFT JOIN (
  SELECT o_custkey, max(o_totalprice) AS biggest, count(*) AS n FROM orders
  WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey) x ON o_custkey = c_custkey""")
def _(t):
    return t.sql(APPLY.replace("{how}", "LEFT JOIN").replace("{on}", "ON true"))


@report("lateral_table_function", """
SELECT event_id, unnest(string_split(event_type || '-' || user_id, '-')) AS piece FROM events""")
def _(t):
    return t.sql("""SELECT event_id, piece FROM {events},
                    LATERAL explode(split(concat(event_type, '-', user_id), '-')) AS x(piece)""")


@report("in_subquery", """
SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)""")
def _(t):
    big = t.orders.where("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey").join(big, "c_custkey", "left_semi")


@report("not_in_subquery", """
SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)""")
def _(t):
    return joins.not_in(t.customer.select("c_custkey"), t.orders.where("o_totalprice > 450000"),
                        "c_custkey", "o_custkey")


@report("not_in_with_null", """
SELECT c_custkey FROM customer WHERE c_custkey NOT IN
(SELECT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END FROM orders)""")
def _(t):
    values = t.orders.select(F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("v"))
    return joins.not_in(t.customer.select("c_custkey"), values, "c_custkey", "v")


@report("exists_subquery", """
SELECT o_orderkey FROM orders WHERE EXISTS (
  SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 49)""")
def _(t):
    return t.sql("""SELECT o_orderkey FROM {orders} WHERE EXISTS (
                    SELECT 1 FROM {lineitem} WHERE l_orderkey = o_orderkey AND l_quantity > 49)""")


@report("not_exists_subquery", """
SELECT c_custkey FROM customer WHERE NOT EXISTS (
  SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')""")
def _(t):
    return t.sql("""SELECT c_custkey FROM {customer} WHERE NOT EXISTS (
                    SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_orderstatus = 'F')""")


@report("compare_any", """
SELECT o_orderkey FROM orders WHERE o_totalprice < ANY (SELECT l_extendedprice FROM lineitem WHERE l_quantity < 3)""")
def _(t):
    return joins.compare_any(t.orders, "o_totalprice", "<", t.lineitem.where("l_quantity < 3"),
                             "l_extendedprice").select("o_orderkey")


@report("compare_all", """
SELECT o_orderkey FROM orders WHERE o_totalprice > ALL (SELECT l_extendedprice FROM lineitem)""")
def _(t):
    return joins.compare_all(t.orders, "o_totalprice", ">", t.lineitem, "l_extendedprice").select("o_orderkey")


@report("equals_some", """
SELECT s_suppkey FROM supplier WHERE s_nationkey = ANY (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900)""")
def _(t):
    return joins.compare_any(t.supplier, "s_nationkey", "=", t.customer.where("c_acctbal > 9900"),
                             "c_nationkey").select("s_suppkey")


@report("quantified_comparisons", """
SELECT s_suppkey,
  s_nationkey <> ANY (SELECT c_nationkey FROM customer WHERE c_acctbal > 9990) AS differs,
  s_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900) AS none,
  s_nationkey = ALL (SELECT n_nationkey FROM nation WHERE n_nationkey = 3) AS only_three,
  s_nationkey >= ALL (SELECT unnest([5, 9])) AS from_nine, s_nationkey = ANY (SELECT unnest([1, 2, 3])) AS listed FROM supplier""")
def _(t):
    some, many = t.customer.where("c_acctbal > 9990"), t.customer.where("c_acctbal > 9900")
    found = {
        "differs": joins.compare_any(t.supplier, "s_nationkey", "<>", some, "c_nationkey"),
        "none": joins.compare_all(t.supplier, "s_nationkey", "<>", many, "c_nationkey"),
        "only_three": joins.compare_all(t.supplier, "s_nationkey", "=", t.nation.where("n_nationkey = 3"), "n_nationkey"),
        "from_nine": joins.compare_all(t.supplier, "s_nationkey", ">=", [5, 9]),
        "listed": joins.compare_any(t.supplier, "s_nationkey", "=", [1, 2, 3])}
    out = t.supplier.select("s_suppkey")
    for name, rows in found.items():
        out = out.join(rows.select("s_suppkey", F.lit(True).alias(name)), "s_suppkey", "left")
    return out.select("s_suppkey", *[F.coalesce(name, F.lit(False)).alias(name) for name in found])


def session_sql(kind, gap_hours):
    return f"""(SELECT user_id, min(ts) AS s, max(ts) + INTERVAL '{gap_hours}' HOUR AS e FROM (
      SELECT *, sum(o) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM (
        SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                         <= INTERVAL '{gap_hours}' HOUR THEN 0 ELSE 1 END AS o
        FROM events WHERE event_type = '{kind}')) GROUP BY user_id, g)"""


def period_sql(condition):
    return f"""SELECT a.user_id, a.s AS view_start, b.s AS error_start
FROM {session_sql('view', 5)} a JOIN {session_sql('error', 3)} b ON a.user_id = b.user_id AND {condition}"""


def periods(t, predicate):
    view = sessions(of_type(t, "view"), ["user_id"], "ts", "5 hours").select(
        "user_id", F.col("session_start").alias("view_start"), F.col("session_end").alias("view_end"))
    error = sessions(of_type(t, "error"), ["user_id"], "ts", "3 hours").select(
        "user_id", F.col("session_start").alias("error_start"), F.col("session_end").alias("error_end"))
    return joins.period_join(view, error, ["user_id"], ("view_start", "view_end"),
                             ("error_start", "error_end"), predicate, "6 hours").select(
        "user_id", "view_start", "error_start")


@report("period_join_overlaps", period_sql("a.s < b.e AND b.s < a.e"))
def _(t):
    return periods(t, "overlaps")


@report("period_join_contains", period_sql("a.s <= b.s AND b.e <= a.e"))
def _(t):
    return periods(t, "contains")


@report("period_predicates", """
WITH p AS (SELECT o_orderkey, o_orderdate AS a, o_orderdate + INTERVAL '60' DAY AS b,
  l_shipdate AS c, l_shipdate + INTERVAL '30' DAY AS d FROM orders JOIN lineitem ON o_orderkey = l_orderkey)
SELECT count(*) FILTER (WHERE a < d AND c < b) AS overlaps, count(*) FILTER (WHERE a <= c AND d <= b) AS contains,
  count(*) FILTER (WHERE b <= c) AS precedes, count(*) FILTER (WHERE a >= d) AS succeeds,
  count(*) FILTER (WHERE b = c) AS immediately_precedes, count(*) FILTER (WHERE a = d) AS immediately_succeeds,
  count(*) FILTER (WHERE a = c AND b = d) AS equals FROM p""")
def _(t):
    p = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).selectExpr(
        "o_orderdate AS a", "o_orderdate + INTERVAL '60' DAY AS b", "l_shipdate AS c",
        "l_shipdate + INTERVAL '30' DAY AS d")
    return p.agg(*[F.count_if(joins.period_predicate(n, "a", "b", "c", "d")).alias(n)
                   for n in joins.PERIOD_PREDICATES])
