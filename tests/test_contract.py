"""Every registered query against its SQL, on the smallest data."""

import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))
from compare import connect, duck_rows, spark_rows  # noqa: E402

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


def test_every_check_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).columns == ["window_end", "user_id", "n", "rank"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, duck, data):
    columns, got = spark_rows(QUERIES[name](spark, data))
    expected_columns, expected = duck_rows(duck, ORACLES[name])
    assert columns == expected_columns
    assert got == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(name, spark, data):
    assert QUERIES[name](spark, data).count() > 0
