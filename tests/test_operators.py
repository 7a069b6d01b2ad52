import datetime as dt
import random

import pytest
import regex
from pyspark.sql import functions as F

from helpers import rows
from tideline.functions import jsons, multisets, scalars, udfs
from tideline.operators import changelog, paths
from tideline.operators.patterns import Measure, all_rows, match_rows
from tideline.operators.windows import late_rows
from tideline.sources import declared, envelope, kv, sinks

T0 = dt.datetime(2024, 1, 1)
sec = lambda n: T0 + dt.timedelta(seconds=n)


# --- changelog -------------------------------------------------------------------------------------

@pytest.mark.parametrize("per_task", [2, 1000])
def test_retractions_keep_duplicates(spark, per_task):
    log = [("a", 1)] * 7 + [("a", -1)] * 2 + [("b", 1), ("b", -1), ("c", -1), (None, 1)]
    df = spark.createDataFrame(log, "v string, s int")
    assert rows(changelog.fold_retractions(df, ["v"], "s", per_task)) == sorted([("a",)] * 5 + [(None,)], key=repr)
    assert rows(changelog.unmatched_retractions(df, ["v"], "s")) == [("c", 1)]


def test_upserts_and_merge(spark):
    log = spark.createDataFrame([(1, "a", 1, False), (1, "b", 2, False), (2, "c", 3, False), (2, "c", 4, True)], "k int, v string, s int, gone boolean")
    assert rows(changelog.fold_upserts(log, ["k"], "s", "gone")) == [(1, "b")]
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 30)], "k int, v string, w int")
    source = spark.createDataFrame([(2, "B", False), (3, "C", True), (4, "D", False)], "k int, v string, gone boolean")
    assert rows(changelog.merge_rows(target, source, ["k"], "gone")) == sorted([(1, "a", 10), (2, "B", 20), (4, "D", None)], key=repr)


# --- purchase paths --------------------------------------------------------------------------------

def path_case(spark, events, config, **limits):
    ev = spark.createDataFrame([(i, u, c, kind, sec(t)) for i, (u, c, kind, t) in enumerate(events)],
                               "event_id long, user_id long, channel string, event_type string, ts timestamp_ntz")
    cf = spark.createDataFrame([(i, c, sec(t), times, longest) for i, (c, t, times, longest) in enumerate(config)],
                               "event_id long, channel string, ts timestamp_ntz, history_purchase_times int, max_purchase_path_length int")
    return rows(paths.purchase_paths(ev, cf, **limits), "user_id", "channel", "purchase_path_length")


@pytest.mark.parametrize("limit", [3, 10_000])
def test_purchase_paths(spark, limit):
    view = lambda u, c, n, t: [(u, c, "VIEW_PRODUCT", t + i) for i in range(n)]
    buy = lambda u, c, t: [(u, c, "PURCHASE", t)]
    run = lambda ev, cf=(): path_case(spark, ev, list(cf), rows_per_group=limit)
    assert run(view(1, "APP", 2, 0) + buy(1, "APP", 9)) == []                      # length 3 = maximum
    assert run(view(1, "APP", 3, 0) + buy(1, "APP", 9)) == [(1, "APP", 4)]         # one more
    assert run(view(1, "H5", 3, 0) + buy(1, "H5", 9)) == [(1, "APP", 4)]           # default config names APP
    cf = [("H5", 0, 0, 1), ("H5", 50, 0, 100)]
    two = view(1, "H5", 3, 1) + buy(1, "H5", 9) + view(1, "H5", 3, 51) + buy(1, "H5", 60)
    assert run(two, cf) == [(1, "H5", 4)]                                          # config changed in between
    assert run(view(1, "H5", 3, 1) + buy(1, "H5", 9), [("H5", 0, 10, 1)]) == []    # too many purchases before
    both = view(1, "H5", 2, 1) + view(1, "APP", 4, 3) + buy(1, "H5", 20) + buy(1, "APP", 21)
    assert run(both, [("H5", 0, 0, 1)]) == [(1, "APP", 5), (1, "H5", 3)]           # channels are separate


# --- row patterns ----------------------------------------------------------------------------------

def naive_matches(data, pattern, within, skip):
    """data: (id, key, t, letters) where letters are all symbols the row meets."""
    out = []
    for key in {r[1] for r in data}:
        group = sorted([r for r in data if r[1] == key], key=lambda r: (r[2], r[0]))
        i = 0
        while i < len(group):
            best = None
            end = max(j for j in range(len(group)) if group[j][2] <= group[i][2] + within) + 1
            m = expand(pattern, group, i, end)
            if m:
                out.append((key, group[i][0], group[m - 1][0], m - i))
                i = m if skip == "past last row" else i + 1
            else:
                i += 1
    return sorted(out, key=repr)


def expand(pattern, group, start, end):
    """Longest preferred match by trying the regular expression on row-set characters."""
    sets = sorted({g[3] for g in group})
    code = {s: chr(0x4E00 + i) for i, s in enumerate(sets)}
    text = "".join(code[g[3]] for g in group)
    body = "".join("[" + ("".join(code[s] for s in sets if ch in s) or "\0") + "]" if ch.isalpha() else ch for ch in pattern)
    m = regex.compile(body).match(text, start, end)
    return m.end() if m and m.end() > start else None


@pytest.mark.parametrize("pattern,skip,limit", [
    ("A B+ C", "past last row", 20), ("(A | B)+ C", "past last row", 10_000), ("(A | B)+ C", "to next row", 20),
    ("A{2,3}", "past last row", 20), ("A B*? C?", "past last row", 10_000)])
def test_patterns_against_a_loop(spark, pattern, skip, limit):
    rng = random.Random(11)
    data = [(i, rng.choice([1, 1, 1, 2]), rng.randrange(300), "".join(s for s in "ABC" if rng.random() < 0.45)) for i in range(150)]
    df = spark.createDataFrame([(i, k, sec(t), s) for i, k, t, s in data], "id long, k int, t timestamp_ntz, s string")
    got = match_rows(df, ["k"], "t", "id", pattern, {c: F.col("s").contains(c) for c in "ABC"}, "20 seconds",
                     skip=skip, rows_per_group=limit)
    assert rows(got, "k", "start_id", "end_id", "n_rows") == naive_matches(data, pattern.replace(" ", ""), 20, skip)


def test_pattern_measures_and_rows(spark):
    df = spark.createDataFrame([(i, 1, sec(i), s, v) for i, (s, v) in enumerate(zip("ABBCABC", [1, 2, 3, 4, 5, 6, 7]))],
                               "id long, k int, t timestamp_ntz, s string, v int")
    symbols = {c: F.col("s") == c for c in "ABC"}
    got = match_rows(df, ["k"], "t", "id", "A B+ C", symbols, "1 minute", measures={
        "b": Measure("sum", "v", "B"), "n": Measure("count", None, "B"), "last": Measure("last", "v", "C"), "top": Measure("max", "v")})
    assert rows(got, "match_number", "start_id", "end_id", "b", "n", "last", "top") == [
        (1, 0, 3, 5.0, 2.0, 4.0, 4.0), (2, 4, 6, 6.0, 1.0, 7.0, 7.0)]
    assert rows(all_rows(got, ["k"]), "row_id", "classifier")[:4] == [(0, "A"), (1, "B"), (2, "B"), (3, "C")]
    resume = match_rows(df, ["k"], "t", "id", "(B | C)+ A? B*", symbols, "1 minute", skip="to last B")
    assert [r[0] for r in rows(resume, "start_id")] == [1, 5]
    with pytest.raises(ValueError):
        match_rows(df, ["k"], "t", "id", "A & B", symbols, "1 minute")


# --- envelope --------------------------------------------------------------------------------------

# fixed values: the line and the row it must become
SCHEMA = ("mail STRING, guid STRING, status INT, ipAddress STRING, metric STRING, service STRING, traceId STRING, "
          "logValue DOUBLE, time STRING")
LINE = ('ANALYSIS,2020-08-06 17:20:24.066,2,{"condition":{"mail":"zhangsan@qq.com","guid":"1111111","request_id":"b1","status":"200"},'
        '"entityMata":{"ipAddress":"0.0.0.0","logValue":2.0,"metric":"metric1","service":"service1"},"traceId":"385307967614d7c1"}')


def test_envelope_golden_row(spark):
    df = spark.createDataFrame([(LINE,)], "value string")
    assert rows(envelope.read_envelope(df, SCHEMA)) == [
        ("zhangsan@qq.com", "1111111", 200, "0.0.0.0", "metric1", "service1", "385307967614d7c1", 2.0, "2020-08-06 17:20:24.066")]


BAD = ["no brace", 'onlyone{"a":1}', 'x,t,{"b":1}', 'x,t,{"a":{"c":1}}', 'x,t,{"a":[1]}', 'x,t,{"a":1', None, '{"a":1}']


@pytest.mark.parametrize("bad", BAD)
def test_envelope_bad_rows(spark, bad):
    df = spark.createDataFrame([(bad,), ('x,t,2,{"a":5}',)], "value string")
    assert rows(envelope.read_envelope(df, "a INT, time STRING", on_error="drop")) == [(5, "t")]
    kept = envelope.read_envelope(df, "a INT, time STRING", on_error="keep")
    assert rows(kept, "a", "_corrupt") == sorted([(None, bad), (5, None)], key=repr)
    with pytest.raises(Exception, match="bad envelope row"):
        envelope.read_envelope(df, "a INT, time STRING").collect()


def test_envelope_first_hit_and_conversions(spark):
    doc = r'x,t,{"o":{"a":" \"a\": 7 \\","n":null,"b":"true","i":"12","d":"x1","l":9007199254740993},"a":"second","b":false}'
    got = envelope.read_envelope(spark.createDataFrame([(doc,)], "value string"),
                                 "time STRING, a STRING, n STRING, b BOOLEAN, i INT, d DOUBLE, l BIGINT")
    assert rows(got) == [("t", ' "a": 7 \\', "null", True, 12, 0.0, 9007199254740993)]


def test_map_null_keys(spark):
    df = spark.sql("SELECT array(struct(CAST(NULL AS STRING) AS key, 1 AS value), struct('a' AS key, 2 AS value)) AS p")
    assert rows(df.select(envelope.map_from_pairs("p", "drop"))) == [({"a": 2},)]
    assert rows(df.select(envelope.map_from_pairs("p", "literal", "nil"))) == [({"nil": 1, "a": 2},)]
    with pytest.raises(Exception):
        df.select(envelope.map_from_pairs("p", "fail")).collect()


# --- key-value tables ------------------------------------------------------------------------------

@pytest.mark.parametrize("pattern,expected", [
    ("1*", ["1", "10", "1a"]), ("1?", ["10", "1a"]), ("[12]*", ["1", "10", "1a", "2"]), ("1[^a]", ["10"]), (r"\*", ["*"]), ("*", ["*", "1", "10", "1a", "2"])])
def test_glob(spark, pattern, expected):
    df = spark.createDataFrame([(x,) for x in ["1", "10", "1a", "2", "*"]], "f string")
    assert [r[0] for r in rows(df.where(kv.matches("f", pattern)))] == expected


def test_kv_table(spark, tmp_path):
    cities = {"1": "changzhou", "10": "jilin", "11": "wuxi", "2": "beijing", "3": "shanghai", "5": "shenzhen", "8": "hefei"}
    df = spark.createDataFrame(list(cities.items()), "cityId string, cityName string")
    kv.store(df, str(tmp_path / "kv"), "cities", "cityId", "cityName")
    assert rows(kv.scan(spark, str(tmp_path / "kv"), "cities", "1*")) == [("1", "changzhou"), ("10", "jilin"), ("11", "wuxi")]
    assert rows(kv.scan(spark, str(tmp_path / "kv"))) == [("cities",)]
    facts = spark.createDataFrame([(str(n), str(n)) for n in (1, 1, 3, 3, 5, 5, 8)][0:2] + [("3", "3"), ("5", "5"), ("5", "5"), ("8", "8")], "id1 string, id2 string")
    joined = facts.join(kv.scan(spark, str(tmp_path / "kv"), "cities"), F.col("id1") == F.col("field"))
    assert rows(joined) == [("1", "1", "1", "changzhou")] * 2 + [("3", "3", "3", "shanghai")] + [("5", "5", "5", "shenzhen")] * 2 + [("8", "8", "8", "hefei")]
    with pytest.raises(TypeError):
        kv.store(spark.createDataFrame([(1, "a")], "k int, v string"), str(tmp_path / "kv"), "x", "k", "v")


@pytest.mark.parametrize("limit", [2, 1000])
def test_command_fold(spark, limit):
    log = [(1, "LPUSH", "l", None, "a"), (2, "RPUSH", "l", None, "b"), (3, "LPUSH", "l", None, "c"), (4, "ZADD", "z", "1.5", "m"),
           (5, "ZADD", "z", "2.5", "m"), (6, "ZADD", "z", "1", "n"), (7, "ZREM", "z", None, "n"), (8, "SET", "s", None, "x"), (9, "SET", "s", None, "y")]
    got = kv.fold_commands(spark.createDataFrame(log, "seq long, op string, key string, field string, value string"), limit)
    assert rows(got) == sorted([("list", "l", None, "c", 0), ("list", "l", None, "a", 1), ("list", "l", None, "b", 2),
                                ("zset", "z", "m", "2.5", None), ("string", "s", None, "y", None)], key=repr)


# --- declarations, routing, functions --------------------------------------------------------------

def test_declaration_rejects_double_names(spark):
    with pytest.raises(ValueError):
        declared.Declaration(computed={"id": "1"}).apply(spark.range(3))


def test_key_report(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, None), (3, None)], "k int, u string")
    assert rows(declared.key_report(df, ["k"], [["u"]])) == [("primary", "k", 1, 1, 1), ("unique", "u", 2, 0, 0)]


def test_routes(spark):
    df = spark.createDataFrame([(1,), (2,), (6,), (None,)], "n int")
    parts = sinks.route(df, {"even": F.expr("n % 2 = 0"), "big": F.expr("n > 5")})
    assert {t: rows(p) for t, p in parts.items()} == {"even": [(2,), (6,)], "big": [(6,)], "unrouted": sorted([(1,), (None,)], key=repr)}
    assert rows(sinks.tagged(df, {"even": F.expr("n % 2 = 0"), "big": F.expr("n > 5")}), "tag", "n") == sorted(
        [("even", 2), ("even", 6), ("big", 6), ("unrouted", 1), ("unrouted", None)], key=repr)


def test_late_rows(spark):
    df = spark.createDataFrame([(1, sec(10)), (2, sec(30)), (3, sec(24)), (4, sec(25))], "a long, t timestamp_ntz")
    assert rows(late_rows(df, "a", "t", "5 seconds"), "a", "is_late") == [(1, False), (2, False), (3, True), (4, False)]


def test_similar_patterns(spark):
    df = spark.createDataFrame([("abc",), ("aXc",), ("a.c",), ("a%c",)], "s string")
    match = lambda p, e=None: [r[0] for r in rows(df.where(scalars.similar_to("s", p, e)))]
    assert match("a_c") == ["a%c", "a.c", "aXc", "abc"] and match("a.c") == ["a.c"]
    assert match("(a)(b|X)c") == ["aXc", "abc"] and match("a[bX]%") == ["aXc", "abc"] and match("a!%c", "!") == ["a%c"]


def test_scalar_edges(spark):
    df = spark.createDataFrame([(-2.57, 3.99)], "x double, y double")
    assert rows(df.select(scalars.truncate("x", 1), scalars.truncate("y"))) == [(-2.5, 3.0)]
    df = spark.createDataFrame([(",a,,b,c",), (None,)], "s string")
    assert [r[0] for r in rows(df.select(udfs.split_text("s")))] == ["a", "b", "c"]
    assert [r[0] for r in rows(df.select(udfs.split_text("s", ",", 2)))] == ["c"]
    assert [r[0] for r in rows(df.select(udfs.split_text("s", ",b", -3)))] == ["a", "c"]


def test_json_values(spark):
    df = spark.createDataFrame([('{"a":"x","o":{"n":1},"z":null}',), ("broken",), (None,)], "j string")
    value = lambda path, **kw: [r[0] for r in df.select(jsons.json_value("j", path, **kw).alias("v")).collect()]
    assert value("$.a", on_error="E") == ["x", "E", None]
    assert value("$.o", on_error="E") == ["E", "E", None]
    assert value("$.q", on_empty="0", on_error="E") == ["0", "E", None]
    assert value("$.z", on_empty="0") == [None, None, None]
    assert [r[0] for r in df.select(jsons.json_exists("j", "$.z")).collect()] == [True, False, False]


def test_multiset_element(spark):
    df = spark.sql("SELECT map('a', 1L) AS one, map('a', 2L) AS two, map_from_arrays(CAST(array() AS ARRAY<STRING>), CAST(array() AS ARRAY<BIGINT>)) AS none")
    assert rows(df.select(multisets.element("one"), multisets.element("none"))) == [("a", None)]
    with pytest.raises(Exception, match="more than one element"):
        df.select(multisets.element("two")).collect()


# CHAR and VARCHAR exist in tables only; frames hold STRING
TYPES = ["STRING", "BOOLEAN", "BINARY", "DECIMAL(10,3)", "TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE", "DATE",
         "TIMESTAMP_NTZ", "TIMESTAMP", "INTERVAL YEAR TO MONTH", "INTERVAL DAY TO SECOND", "ARRAY<INT>", "MAP<STRING, BIGINT>",
         "STRUCT<a: INT NOT NULL COMMENT 'c', b: STRUCT<c: ARRAY<MAP<STRING, DOUBLE>>>>"]


@pytest.mark.parametrize("kind", TYPES)
@pytest.mark.parametrize("required", ["", " NOT NULL"])
def test_type_matrix_round_trip(spark, tmp_path, kind, required):
    df = spark.createDataFrame([], f"v {kind}{required}")
    df.write.parquet(str(tmp_path / "t"))
    back = spark.read.schema(df.schema).parquet(str(tmp_path / "t"))
    # parquet reads make nested fields nullable
    assert back.dtypes == df.dtypes and back.count() == 0


def test_pattern_null_and_large_keys(spark):
    """A NULL key is one key, and integers beyond 2**53 stay exact beside it."""
    big = 2 ** 60 + 1
    df = spark.createDataFrame([(k, i, 100 * n + i) for n, k in enumerate((7, None, big)) for i in range(6)], "k long, t long, id long").withColumn(
        "t", F.timestamp_seconds("t"))
    got = match_rows(df, ["k"], "t", "id", "A A", {"A": F.lit(True)}, "1 hour")
    assert rows(got, "k", "match_number", "row_ids") == sorted(
        [(k, m + 1, [100 * n + 2 * m, 100 * n + 2 * m + 1]) for n, k in enumerate((7, None, big)) for m in range(3)], key=repr)


def test_pattern_with_many_symbols(spark):
    df = spark.createDataFrame([(1, i, i) for i in range(24)], "k int, t long, id long").withColumn("t", F.timestamp_seconds("t"))
    define = {f"S{j}": F.col("id") % 12 == j for j in range(12)}
    got = match_rows(df, ["k"], "t", "id", " ".join(define), define, "1 hour").collect()
    assert [(r.start_id, r.end_id, r.classifiers) for r in got] == [(0, 11, list(define)), (12, 23, list(define))]


def test_json_clauses(spark):
    df = spark.createDataFrame([(1, '{"a": 1, "b": [2]}', None), (2, '{"a": "x"}', "y")], "i int, t string, n string")
    got = df.select("i", jsons.json_value("t", "$.b", on_error="wrong", on_empty="none").alias("v"),
                    jsons.json_array("i", "n", F.lit(1.5), F.lit(True)).alias("a"), jsons.json_array("i", "n", absent_on_null=False).alias("all"))
    assert rows(got) == [(1, "wrong", "[1,1.5,true]", "[1,null]"), (2, "none", '[2,"y",1.5,true]', '[2,"y"]')]
    with pytest.raises(Exception, match="leads nowhere"):
        df.select(jsons.json_value("t", "$.z", on_empty=jsons.ERROR)).collect()
    both = df.agg(jsons.json_arrayagg("n", "i", absent_on_null=False).alias("a"), jsons.json_objectagg("i", "n", absent_on_null=True).alias("o")).first()
    assert both.a.replace(" ", "") == '[null,"y"]' and both.o == '{"2":"y"}'


def test_update_and_delete_by_condition(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 9)], "k int, v int")
    assert rows(changelog.update_where(df, F.col("v") > 5, {"v": F.col("v") + F.col("k")})) == [(1, 5), (2, None), (3, 12)]
    assert rows(changelog.delete_where(df, F.col("v") > 5)) == [(1, 5), (2, None)]


def test_declared_primary_key_refuses_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    key = declared.Declaration(primary_key=("k",), unique=(("v",),))
    assert rows(key.apply(df.where("k is not null"))) == [(1, "a")]
    with pytest.raises(Exception, match="primary key column k"):
        key.apply(df).collect()
    with pytest.raises(ValueError):
        declared.Declaration(primary_key=("z",)).apply(df)
