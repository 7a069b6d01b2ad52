"""Row pattern queries."""

from pyspark.sql import functions as F

from ..operators.patterns import Measure, all_rows, match_rows
from .registry import report


def define(**kinds):
    return {symbol: F.col("event_type") == kind for symbol, kind in kinds.items()}


@report("pattern_paths", """
WITH s AS (SELECT user_id, string_agg(upper(event_type[1]), '' ORDER BY ts, event_id) AS letters FROM events GROUP BY user_id),
m AS (SELECT user_id, regexp_extract_all(letters, 'C[VE]*P') AS found FROM s)
SELECT user_id, unnest(found) AS letters, CAST(generate_subscripts(found, 1) AS BIGINT) AS match_number FROM m""")
def _(t):
    # letters other than the defined ones stand between matches; 60 days cover the whole table
    got = match_rows(t.events, ["user_id"], "ts", "event_id", "C (V | E)* P",
                     define(C="click", V="view", E="error", P="purchase"), within="60 days")
    return got.select("user_id", F.array_join("classifiers", "").alias("letters"), "match_number")


WITHIN_SQL = """
SELECT user_id, event_id AS start_id, next_id AS end_id, value + next_value AS total FROM (
  SELECT *, lead(event_id) OVER w AS next_id, lead(event_type) OVER w AS next_type, lead(ts) OVER w AS next_ts,
    lead(value) OVER w AS next_value FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE event_type = 'click' AND next_type = 'purchase' AND next_ts - ts <= INTERVAL '12' HOUR"""


def within_report(t, **limits):
    got = match_rows(t.events, ["user_id"], "ts", "event_id", "C P", define(C="click", P="purchase"), within="12 hours",
                     measures={"first": Measure("first", "value", "C"), "last": Measure("last", "value", "P")}, **limits)
    return got.select("user_id", "start_id", "end_id", (F.col("first") + F.col("last")).alias("total"))


@report("pattern_within", WITHIN_SQL)
def _(t):
    return within_report(t)


@report("pattern_within_hot_keys", WITHIN_SQL)
def _(t):
    return within_report(t, rows_per_group=2)


@report("pattern_rising_values", """
WITH r AS (SELECT user_id, event_id, ts, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events),
g AS (SELECT *, row_number() OVER w - sum(CASE WHEN value > before THEN 1 ELSE 0 END) OVER w AS run FROM r
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, count(*) AS n_rows, max(event_id) AS end_id FROM g WHERE value > before GROUP BY user_id, run HAVING count(*) >= 3""")
def _(t):
    # UP compares the row with its predecessor; three or more rises in a row
    got = match_rows(t.events, ["user_id"], "ts", "event_id", "UP{3,}", {"UP": F.col("value") > F.col("before")},
                     within="60 days", neighbours={"before": ("value", -1)})
    return got.select("user_id", F.col("n_rows").cast("long").alias("n_rows"), "end_id")


@report("pattern_all_rows", """
WITH m AS (SELECT user_id, event_id, lead(event_id) OVER w AS next_id, event_type, lead(event_type) OVER w AS next_type, ts,
    lead(ts) OVER w AS next_ts FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, event_id AS row_id, 'C' AS classifier FROM m WHERE event_type = 'click' AND next_type = 'purchase' AND next_ts - ts <= INTERVAL '1' DAY
UNION ALL SELECT user_id, next_id, 'P' FROM m WHERE event_type = 'click' AND next_type = 'purchase' AND next_ts - ts <= INTERVAL '1' DAY""")
def _(t):
    got = match_rows(t.events, ["user_id"], "ts", "event_id", "C P", define(C="click", P="purchase"), within="1 day",
                     skip="to next row")
    return all_rows(got, ["user_id"]).drop("match_number")


# --- clauses ---------------------------------------------------------------------------------

LETTERS = "WITH s AS (SELECT user_id, string_agg(upper(event_type[1]), '' ORDER BY ts, event_id) AS letters FROM events GROUP BY user_id)"


def over_users(t, pattern, **options):
    return match_rows(t.events, ["user_id"], "ts", "event_id", pattern, define(C="click", V="view", E="error", P="purchase", S="signup"),
                      within="60 days", **options)


@report("pattern_anchors", f"""
{LETTERS}
SELECT user_id, 'first' AS side, length(regexp_extract(letters, '^[VC]+'))::bigint AS n FROM s WHERE regexp_matches(letters, '^[VC]')
UNION ALL SELECT user_id, 'last', length(regexp_extract(letters, '[VC]+$'))::bigint FROM s WHERE regexp_matches(letters, '[VC]$')""")
def _(t):
    # the run of views and clicks a user began with, and the one the user ended with
    first, last = over_users(t, "^ (V | C)+"), over_users(t, "(V | C)+ $")
    return first.select("user_id", F.lit("first").alias("side"), F.col("n_rows").cast("long").alias("n")).unionByName(
        last.select("user_id", F.lit("last").alias("side"), F.col("n_rows").cast("long").alias("n")))


@report("pattern_permute", f"""
{LETTERS}, m AS (SELECT user_id, regexp_extract_all(letters, 'CPV|CVP|PCV|PVC|VCP|VPC') AS found FROM s)
SELECT user_id, unnest(found) AS letters, CAST(generate_subscripts(found, 1) AS BIGINT) AS match_number FROM m""")
def _(t):
    got = over_users(t, "PERMUTE (C, P, V)")
    return got.select("user_id", F.array_join("classifiers", "").alias("letters"), "match_number")


@report("pattern_left_out", f"""
{LETTERS}, m AS (SELECT user_id, regexp_extract_all(letters, 'C[VE]*P') AS found FROM s)
SELECT user_id, 'CP' AS letters, length(f)::int AS n_rows, n AS match_number
FROM (SELECT user_id, unnest(found) AS f, CAST(generate_subscripts(found, 1) AS BIGINT) AS n FROM m)""")
def _(t):
    # the rows between belong to the match but are not shown
    got = over_users(t, "C {- (V | E)* -} P")
    return got.select("user_id", F.array_join("classifiers", "").alias("letters"), "n_rows", "match_number")


@report("pattern_subset", f"""
{LETTERS}, m AS (SELECT user_id, regexp_extract_all(letters, 'C[VE]*P') AS found FROM s)
SELECT user_id, (length(f) - 2)::double AS between_rows, n AS match_number
FROM (SELECT user_id, unnest(found) AS f, CAST(generate_subscripts(found, 1) AS BIGINT) AS n FROM m)""")
def _(t):
    got = over_users(t, "C (V | E)* P", subsets={"BETWEEN_ROWS": ["V", "E"]}, measures={"between_rows": Measure("count", None, "BETWEEN_ROWS")})
    return got.select("user_id", "between_rows", "match_number")
