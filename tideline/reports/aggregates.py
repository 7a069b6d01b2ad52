"""Queries over incremental windows, aggregates, rankings, paths and changelogs."""

from pyspark.sql import functions as F

from ..functions import multisets
from ..operators import aggregates, changelog, incremental, paths, ranking
from ..plans.slices import Order
from .joins import of_type, prop_k
from .registry import report
from .windows import cents, money


@report("incremental_window", """
WITH s AS (SELECT event_type, time_bucket(INTERVAL '1' DAY, ts) AS w, ts, value, user_id FROM events),
g AS (SELECT event_type, w, min(ts) AS first FROM s GROUP BY ALL),
f AS (SELECT event_type, w, first, w + i * INTERVAL '3' HOUR AS fire FROM g, range(1, 9) r(i)
      WHERE w + i * INTERVAL '3' HOUR > first)
SELECT f.w AS window_start, f.fire AS fire_time, f.event_type, count(*) AS pv,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, min(value) AS low, max(value) AS high,
  count(DISTINCT user_id) AS uv
FROM f JOIN s ON s.event_type = f.event_type AND s.w = f.w AND s.ts < f.fire GROUP BY ALL""")
def _(t):
    got = incremental.incremental_window(
        t.events, "ts", "1 day", "3 hours", ["event_type"],
        sums={"pv": F.count(F.lit(1)), "total": F.sum(cents("value"))}, minimums={"low": F.min("value")},
        maximums={"high": F.max("value")}, distinct={"uv": "user_id"})
    return got.withColumn("total", F.col("total") / 100)


@report("incremental_pv_uv", """
WITH s AS (SELECT time_bucket(INTERVAL '1' DAY, ts) AS w, ts, user_id FROM events),
f AS (SELECT w, w + i * INTERVAL '10' MINUTE AS fire FROM (SELECT w, min(ts) AS first FROM s GROUP BY w), range(1, 145) r(i)
      WHERE w + i * INTERVAL '10' MINUTE > first)
SELECT f.w AS window_start, f.fire AS fire_time, count(*) AS pv, count(DISTINCT user_id) AS uv
FROM f JOIN s ON s.w = f.w AND s.ts < f.fire GROUP BY ALL""")
def _(t):
    return incremental.incremental_window(t.events, "ts", "1 day", "10 minutes", [],
                                          sums={"pv": F.count(F.lit(1))}, distinct={"uv": "user_id"})


@report("order_board", """
WITH s AS (SELECT event_type, time_bucket(INTERVAL '1' DAY, ts) AS w, ts, value FROM events),
f AS (SELECT event_type, w, w + i * INTERVAL '1' HOUR AS fire FROM (SELECT event_type, w, min(ts) AS first FROM s GROUP BY ALL),
      range(1, 25) r(i) WHERE w + i * INTERVAL '1' HOUR > first),
c AS (SELECT f.w, f.fire, f.event_type, sum(CAST(value AS DECIMAL(18,2))) AS ct
      FROM f JOIN s ON s.event_type = f.event_type AND s.w = f.w AND s.ts < f.fire GROUP BY ALL)
SELECT w AS window_start, fire AS fire_time, CAST(total AS DOUBLE) AS total, rank, event_type, CAST(ct AS DOUBLE) AS category_total
FROM (SELECT *, sum(ct) OVER (PARTITION BY w, fire) AS total,
      row_number() OVER (PARTITION BY w, fire ORDER BY ct DESC, event_type) AS rank FROM c) WHERE rank <= 3""")
def _(t):
    got = incremental.order_board(t.events, "ts", "event_type", "value", "1 day", "1 hour")
    return got.withColumn("total", F.col("total").cast("double")).withColumn(
        "category_total", F.col("category_total").cast("double"))


@report("hourly_pv_uv", """
SELECT strftime(ts, '%Y-%m-%d %H:00') AS hour, count(*) AS pv, count(DISTINCT user_id) AS uv FROM events GROUP BY 1""")
def _(t):
    return aggregates.hourly_pv_uv(t.events, "ts", "user_id")


@report("split_distinct", """
SELECT l_returnflag, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY l_returnflag""")
def _(t):
    return aggregates.split_distinct(t.lineitem, ["l_returnflag"], "l_partkey", "parts")


@report("first_row_dedup", """
SELECT o_custkey, o_orderkey, substring(o_orderpriority, 3) AS priority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
WHERE rn = 1 AND o_orderstatus IN ('F', 'O')""")
def _(t):
    first = aggregates.first_rows(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return first.where(F.col("o_orderstatus").isin("F", "O")).select(
        "o_custkey", "o_orderkey", F.expr("substring(o_orderpriority, 3)").alias("priority"))


PATH_SQL = """
WITH e AS (SELECT *, CAST(props->>'$.k' AS INTEGER) AS k FROM events),
u AS (SELECT event_id, ts, user_id, ['APP', 'WEB', 'H5'][k % 3 + 1] AS channel,
  CASE event_type WHEN 'view' THEN 'VIEW_PRODUCT' WHEN 'click' THEN 'ADD_TO_CART'
                  WHEN 'error' THEN 'REMOVE_FROM_CART' ELSE 'PURCHASE' END AS type FROM e WHERE event_type <> 'signup'),
c AS (SELECT event_id, ts, ['APP', 'WEB', 'H5'][k % 3 + 1] AS channel, k % 15 AS times,
  CAST(floor(value) AS BIGINT) % 6 AS longest FROM e WHERE event_type = 'signup' AND value > 100),
p AS (SELECT *, coalesce(sum(CASE WHEN type = 'PURCHASE' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, channel
  ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS path FROM u),
g AS (SELECT user_id, channel, path, count(*) AS len, max(CASE WHEN type = 'PURCHASE' THEN ts END) AS pt,
  count(*) FILTER (type = 'ADD_TO_CART') AS a, count(*) FILTER (type = 'REMOVE_FROM_CART') AS r,
  count(*) FILTER (type = 'VIEW_PRODUCT') AS v FROM p GROUP BY ALL HAVING pt IS NOT NULL),
j AS (SELECT g.*, c.channel AS cc, c.times, c.longest FROM g ASOF LEFT JOIN c ON g.channel = c.channel AND g.pt >= c.ts)
SELECT user_id, coalesce(cc, 'APP') AS channel, pt AS purchase_time, len AS purchase_path_length,
  concat_ws(',', CASE WHEN a > 0 THEN 'ADD_TO_CART:' || a END, 'PURCHASE:1',
    CASE WHEN r > 0 THEN 'REMOVE_FROM_CART:' || r END, CASE WHEN v > 0 THEN 'VIEW_PRODUCT:' || v END) AS event_type_counts
FROM j WHERE coalesce(times, 0) < 10 AND len > coalesce(longest, 3)"""


def path_inputs(events):
    channel = F.element_at(F.array(F.lit("APP"), F.lit("WEB"), F.lit("H5")), prop_k() % 3 + 1)
    kind = (F.when(F.col("event_type") == "view", "VIEW_PRODUCT").when(F.col("event_type") == "click", "ADD_TO_CART")
            .when(F.col("event_type") == "error", "REMOVE_FROM_CART").otherwise("PURCHASE"))
    user_events = events.where("event_type <> 'signup'").select(
        "event_id", "ts", "user_id", channel.alias("channel"), kind.alias("event_type"))
    config = events.where("event_type = 'signup' AND value > 100").select(
        "event_id", "ts", channel.alias("channel"), (prop_k() % 15).alias("history_purchase_times"),
        (F.floor("value") % 6).cast("int").alias("max_purchase_path_length"))
    return user_events, config


def path_report(t, **limits):
    got = paths.purchase_paths(*path_inputs(t.events), **limits)
    return got.withColumn("event_type_counts", multisets.as_text("event_type_counts"))


@report("purchase_paths", PATH_SQL)
def _(t):
    return path_report(t)


@report("purchase_paths_hot_keys", PATH_SQL)
def _(t):
    return path_report(t, rows_per_group=12)


@report("metric_summary", """
WITH m AS (SELECT regexp_replace(event_type || '.latency/ms', '[^a-zA-Z0-9:_]', '_', 'g') AS metric, value, ts FROM events)
SELECT metric, count(value) AS count, min(value) AS min, max(value) AS max, round(avg(value), 6) AS mean,
  round(stddev_samp(value), 6) AS stddev,
  round(count(value) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6), 9) AS rate,
  round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75,
  round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.98), 6) AS p98,
  round(quantile_cont(value, 0.99), 6) AS p99, round(quantile_cont(value, 0.999), 6) AS p999
FROM m GROUP BY metric""")
def _(t):
    named = t.events.withColumn("name", F.concat("event_type", F.lit(".latency/ms")))
    got = aggregates.metric_summary(named, "name", "value", "ts")
    rounded = {c: 9 if c == "rate" else 6 for c in got.columns if c not in ("metric", "count", "min", "max")}
    return got.select("metric", "count", "min", "max", *[F.round(c, d).alias(c) for c, d in rounded.items()])


@report("group_aggregates", """
SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total,
  round(avg(l_discount), 6) AS mean, min(l_tax) AS low, max(l_extendedprice) AS high,
  round(stddev_pop(l_quantity), 4) AS sd_pop, round(stddev_samp(l_quantity), 4) AS sd_samp,
  round(var_pop(l_quantity), 4) AS v_pop, round(var_samp(l_quantity), 4) AS v_samp,
  round(covar_pop(l_quantity, l_discount), 6) AS cov_pop, round(covar_samp(l_quantity, l_discount), 6) AS cov_samp,
  regr_count(l_quantity, l_tax) AS r_n, round(regr_sxx(l_quantity, l_tax), 4) AS r_sxx,
  round(regr_syy(l_quantity, l_tax), 2) AS r_syy, bool_and(l_quantity > 0) AS every_positive,
  bool_or(l_discount > 0.09) AS some_big
FROM lineitem GROUP BY ALL""")
def _(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), money("l_quantity").alias("total"), F.round(F.avg("l_discount"), 6).alias("mean"),
        F.min("l_tax").alias("low"), F.max("l_extendedprice").alias("high"),
        F.round(F.stddev_pop("l_quantity"), 4).alias("sd_pop"), F.round(F.stddev_samp("l_quantity"), 4).alias("sd_samp"),
        F.round(F.var_pop("l_quantity"), 4).alias("v_pop"), F.round(F.var_samp("l_quantity"), 4).alias("v_samp"),
        F.round(F.covar_pop("l_quantity", "l_discount"), 6).alias("cov_pop"),
        F.round(F.covar_samp("l_quantity", "l_discount"), 6).alias("cov_samp"),
        F.regr_count("l_quantity", "l_tax").alias("r_n"), F.round(F.regr_sxx("l_quantity", "l_tax"), 4).alias("r_sxx"),
        F.round(F.regr_syy("l_quantity", "l_tax"), 2).alias("r_syy"),
        F.every(F.col("l_quantity") > 0).alias("every_positive"), F.some(F.col("l_discount") > 0.09).alias("some_big"))


@report("distinct_and_filtered_aggregates", """
SELECT c_nationkey, count(DISTINCT c_mktsegment) AS segments, count(*) FILTER (WHERE c_acctbal < 0) AS in_debt,
  string_agg(DISTINCT c_mktsegment, '|' ORDER BY c_mktsegment) AS names FROM customer GROUP BY c_nationkey""")
def _(t):
    # one row per (nation, segment) first, so the list is built from distinct values only
    return t.sql("""
        SELECT c_nationkey, count(c_mktsegment) AS segments, CAST(sum(in_debt) AS BIGINT) AS in_debt,
               listagg(c_mktsegment, '|') WITHIN GROUP (ORDER BY c_mktsegment) AS names
        FROM (SELECT c_nationkey, c_mktsegment, count(*) FILTER (WHERE c_acctbal < 0) AS in_debt
              FROM {customer} GROUP BY c_nationkey, c_mktsegment) GROUP BY c_nationkey""")


@report("grouping_sets", """
SELECT o_orderstatus, o_orderpriority, grouping(o_orderstatus) AS gs, grouping(o_orderpriority) AS gp, count(*) AS n
FROM orders GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderstatus), ()) HAVING count(*) > 10""")
def _(t):
    return t.sql("""
        SELECT o_orderstatus, o_orderpriority, CAST(grouping(o_orderstatus) AS BIGINT) AS gs,
               CAST(grouping(o_orderpriority) AS BIGINT) AS gp, count(*) AS n
        FROM {orders} GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderstatus), ())
        HAVING count(*) > 10""")


@report("rollup", """
SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def _(t):
    return t.lineitem.rollup("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@report("cube", """
SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""")
def _(t):
    return t.lineitem.cube("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


MULTISET_CTE = """
WITH c AS (SELECT o_custkey AS k, o_orderstatus AS s, o_orderpriority AS v, count(*) AS n FROM orders GROUP BY ALL)"""


@report("collect_multiset", MULTISET_CTE + """
SELECT k, string_agg(v || ':' || n, ',' ORDER BY v) AS priorities FROM (
  SELECT k, v, sum(n)::BIGINT AS n FROM c GROUP BY ALL) GROUP BY k""")
def _(t):
    got = aggregates.collect_multiset(t.orders.withColumnRenamed("o_custkey", "k"), ["k"], "o_orderpriority", "m")
    return got.select("k", multisets.as_text("m").alias("priorities"))


@report("fusion_multisets", """
SELECT event_type, string_agg(d || ':' || n, ',' ORDER BY d) AS days FROM (
  SELECT event_type, dayofweek(ts) + 1 AS d, count(*) AS n FROM events GROUP BY ALL) GROUP BY event_type""")
def _(t):
    rows = t.events.select("event_type", "user_id", F.dayofweek("ts").alias("d"))
    per_user = aggregates.collect_multiset(rows, ["event_type", "user_id"], "d", "m")
    got = aggregates.fuse_multisets(per_user, ["event_type"], "m", "m")
    return got.select("event_type", multisets.as_text("m").alias("days"))


@report("intersection_multisets", """
WITH c AS (SELECT user_id, event_type, dayofweek(ts) + 1 AS d, count(*) AS n FROM events GROUP BY ALL)
SELECT user_id, string_agg(d || ':' || n, ',' ORDER BY d) AS days FROM (
  SELECT user_id, d, min(n) AS n FROM c GROUP BY user_id, d
  HAVING count(*) = (SELECT count(DISTINCT event_type) FROM c x WHERE x.user_id = c.user_id)) GROUP BY user_id""")
def _(t):
    rows = t.events.select("event_type", "user_id", F.dayofweek("ts").alias("d"))
    per_type = aggregates.collect_multiset(rows, ["user_id", "event_type"], "d", "m")
    got = aggregates.intersect_multisets(per_type, ["user_id"], "m", "m")
    return got.select("user_id", multisets.as_text("m").alias("days"))


@report("multiset_operators", MULTISET_CTE + """,
p AS (SELECT k, v, coalesce(sum(n) FILTER (s = 'F'), 0)::BIGINT AS f, coalesce(sum(n) FILTER (s = 'O'), 0)::BIGINT AS o
      FROM c GROUP BY ALL),
paired AS (SELECT k FROM p GROUP BY k HAVING sum(f) > 0 AND sum(o) > 0)
SELECT k, string_agg(v || ':' || (f + o), ',' ORDER BY v) FILTER (f + o > 0) AS union_all,
  coalesce(string_agg(v || ':' || 1, ',' ORDER BY v) FILTER (f + o > 0), '') AS union_distinct,
  coalesce(string_agg(v || ':' || least(f, o), ',' ORDER BY v) FILTER (f > 0 AND o > 0), '') AS intersect_all,
  coalesce(string_agg(v || ':' || 1, ',' ORDER BY v) FILTER (f > 0 AND o > 0), '') AS intersect_distinct,
  coalesce(string_agg(v || ':' || (f - o), ',' ORDER BY v) FILTER (f > o), '') AS except_all,
  coalesce(string_agg(v || ':' || 1, ',' ORDER BY v) FILTER (f > 0 AND o = 0), '') AS except_distinct,
  bool_or(v = '1-URGENT' AND f > 0) AS has_urgent, bool_and(f <= o) AS is_sub,
  bool_and(f <= 1) AS is_set, sum(f)::BIGINT AS cardinality
FROM p JOIN paired USING (k) GROUP BY k""")
def _(t):
    orders = t.orders.withColumnRenamed("o_custkey", "k")
    of = lambda s, n: aggregates.collect_multiset(orders.where(F.col("o_orderstatus") == s), ["k"], "o_orderpriority", n)
    pairs = of("F", "f").join(of("O", "o"), "k")
    binary = ["union_all", "union_distinct", "intersect_all", "intersect_distinct", "except_all", "except_distinct"]
    return pairs.select(
        "k", *[multisets.as_text(getattr(multisets, n)("f", "o")).alias(n) for n in binary],
        multisets.member_of("1-URGENT", "f").alias("has_urgent"), multisets.submultiset_of("f", "o").alias("is_sub"),
        multisets.is_a_set("f").alias("is_set"), multisets.cardinality("f").alias("cardinality"))


@report("retract_fold", """
SELECT user_id, k FROM (SELECT user_id, CAST(props->>'$.k' AS INTEGER) % 5 AS k,
  sum(CASE WHEN event_type = 'error' THEN -1 ELSE 1 END)::BIGINT AS n FROM events GROUP BY ALL), range(0, 1000) r(i) WHERE i < n""")
def _(t):
    return changelog.fold_retractions(retractions(t), ["user_id", "k"], "sign")


def retractions(t):
    return t.events.select("user_id", (prop_k() % 5).alias("k"),
                           F.when(F.col("event_type") == "error", -1).otherwise(1).alias("sign"))


@report("retract_errors", """
SELECT user_id, k, -n AS surplus FROM (SELECT user_id, CAST(props->>'$.k' AS INTEGER) AS k,
  sum(CASE WHEN event_type = 'error' THEN -1 ELSE 1 END)::BIGINT AS n FROM events GROUP BY ALL) WHERE n < 0""")
def _(t):
    log = t.events.select("user_id", prop_k().alias("k"),
                          F.when(F.col("event_type") == "error", -1).otherwise(1).alias("sign"))
    return changelog.unmatched_retractions(log, ["user_id", "k"], "sign")


@report("upsert_fold", """
SELECT user_id, k, value FROM (SELECT user_id, CAST(props->>'$.k' AS INTEGER) AS k, value, event_type,
  row_number() OVER (PARTITION BY user_id, CAST(props->>'$.k' AS INTEGER) ORDER BY event_id DESC) AS r FROM events)
WHERE r = 1 AND event_type <> 'purchase'""")
def _(t):
    log = t.events.select("user_id", prop_k().alias("k"), "value", "event_id",
                          (F.col("event_type") == "purchase").alias("gone"))
    return changelog.fold_upserts(log, ["user_id", "k"], "event_id", "gone")


@report("merge", """
WITH s AS (SELECT l_orderkey + 7500 AS o_orderkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS o_totalprice,
  count(*) > 5 AS gone FROM lineitem GROUP BY 1)
SELECT coalesce(s.o_orderkey, o.o_orderkey) AS o_orderkey, o.o_orderstatus,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE o.o_totalprice END AS o_totalprice
FROM orders o FULL JOIN s ON o.o_orderkey = s.o_orderkey WHERE coalesce(gone, false) = false""")
def _(t):
    source = t.lineitem.groupBy((F.col("l_orderkey") + 7500).alias("o_orderkey")).agg(
        money("l_quantity").alias("o_totalprice"), (F.count(F.lit(1)) > 5).alias("gone"))
    return changelog.merge_rows(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), source,
                                ["o_orderkey"], "gone")


RANK_SQL = """
SELECT o_orderkey, row_number() OVER w AS row_number, rank() OVER v AS rank, dense_rank() OVER v AS dense_rank,
  percent_rank() OVER v AS percent_rank, cume_dist() OVER v AS cume_dist, ntile(7) OVER w AS ntile
FROM (SELECT *, floor(o_totalprice / 1000) AS price FROM orders)
WINDOW w AS (PARTITION BY o_orderpriority ORDER BY price, o_orderkey), v AS (PARTITION BY o_orderpriority ORDER BY price)"""


def rank_report(t, **limits):
    rows = t.orders.select("o_orderkey", "o_orderpriority", F.floor(F.col("o_totalprice") / 1000).alias("price"))
    return ranking.ranks(rows, ["o_orderpriority"], Order("price", ("o_orderkey",)), 7, **limits).drop(
        "o_orderpriority", "price")


@report("rank_functions", RANK_SQL)
def _(t):
    return rank_report(t)


@report("rank_functions_hot_keys", RANK_SQL)
def _(t):
    return rank_report(t, rows_per_group=400)


LAG_SQL = """
SELECT event_id, lag(value) OVER w AS before, lead(value, 2) OVER w AS after2 FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""


def lag_report(t, **limits):
    rows = t.events.select("event_id", "user_id", "ts", "value")
    got = ranking.neighbours(rows, ["user_id"], Order("ts", ("event_id",)),
                             {"before": ("value", -1), "after2": ("value", 2)}, **limits)
    return got.select("event_id", "before", "after2")


@report("lag_lead", LAG_SQL)
def _(t):
    return lag_report(t)


@report("lag_lead_hot_keys", LAG_SQL)
def _(t):
    return lag_report(t, rows_per_group=30)


@report("positional_values", """
SELECT event_id, first_value(v) OVER w AS first_value, last_value(v) OVER w AS last_value,
  last_value(v IGNORE NULLS) OVER w AS last_non_null, nth_value(v, 3) OVER w AS nth_value
FROM (SELECT *, CASE WHEN value > 20 THEN value END AS v FROM events)
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def _(t):
    rows = t.events.select("event_id", "user_id", "ts", F.when(F.col("value") > 20, F.col("value")).alias("v"))
    got = ranking.positional_values(rows, ["user_id"], Order("ts", ("event_id",)), "v", 3, rows_per_group=40)
    return got.select("event_id", "first_value", "last_value", "last_non_null", "nth_value")


@report("full_frames_only", """
SELECT event_id, CASE WHEN count(*) OVER w = 5 THEN CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) END AS total
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS 4 PRECEDING)""")
def _(t):
    got = ranking.full_frames_only(t.events.select("event_id", "user_id", "value"), ["user_id"], Order("event_id"),
                                   {"total": cents("value")}, 4)
    return got.select("event_id", (F.col("total") / 100).alias("total"))


DISTINCT_SQL = """
SELECT event_id, count(DISTINCT event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS distinct_so_far FROM events"""


@report("running_distinct", DISTINCT_SQL)
def _(t):
    rows = t.events.select("event_id", "user_id", "event_type")
    return ranking.running_distinct(rows, ["user_id"], Order("event_id"), "event_type").select("event_id", "distinct_so_far")


@report("running_distinct_hot_keys", DISTINCT_SQL)
def _(t):
    rows = t.events.select("event_id", "user_id", "event_type")
    return ranking.running_distinct(rows, ["user_id"], Order("event_id"), "event_type", rows_per_group=20).select(
        "event_id", "distinct_so_far")
