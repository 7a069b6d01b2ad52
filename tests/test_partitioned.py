"""Statements on partitioned tables: right rows, and files of untouched partitions stay as they are."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tideline.sources import partitioned
from tideline.sources.partitioned import delete_partitions, merge_partitions, update_partitions

SCHEMA = "k int, v string, p string"
ROWS = [(1, "a", "x"), (2, "b", "x"), (3, "c", "y"), (4, "d", "z/ 1"), (5, "e", None), (6, "f", "w"), (None, "g", "w")]


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(ROWS, SCHEMA).write.partitionBy("p").parquet(path)
    return path


def files(path):
    """Data files by partition folder."""
    out = {}
    for f in glob.glob(f"{path}/*/*.parquet"):
        out.setdefault(os.path.basename(os.path.dirname(f)), set()).add((os.path.basename(f), os.stat(f).st_mtime_ns))
    return out


def read(spark, path):
    return rows(spark.read.schema(SCHEMA).parquet(path), "k", "v", "p")


@pytest.mark.parametrize("named", [1000, 0])
def test_merge_rewrites_touched_partitions_only(spark, table, named, monkeypatch):
    monkeypatch.setattr(partitioned, "NAMED", named)
    before = files(table)
    # a change, a move to a new partition, a deletion that empties a partition, a new row, a deletion of nothing
    source = spark.createDataFrame([(1, "A", "x", False), (3, "C", "new", False), (4, None, "z/ 1", True), (7, "n", None, False), (99, "-", "w", True)],
                                   "k int, v string, p string, gone boolean")
    touched = merge_partitions(table, source, ["k"], ["p"], "gone")
    assert read(spark, table) == sorted([(1, "A", "x"), (2, "b", "x"), (3, "C", "new"), (5, "e", None), (6, "f", "w"), (None, "g", "w"), (7, "n", None)], key=repr)
    assert sorted(str(r.p) for r in touched.collect()) == ["None", "new", "x", "y", "z/ 1"]
    after = files(table)
    assert after["p=w"] == before["p=w"] and after["p=x"] != before["p=x"]
    assert set(after) == {"p=w", "p=x", "p=new", "p=__HIVE_DEFAULT_PARTITION__"}


def test_merge_without_the_partition_column_keeps_places(spark, table):
    before = files(table)
    merge_partitions(table, spark.createDataFrame([(2, "B")], "k int, v string"), ["k"], ["p"])
    assert read(spark, table) == sorted([(k, "B" if k == 2 else v, p) for k, v, p in ROWS], key=repr)
    after = files(table)
    assert {p for p in before if before[p] != after[p]} == {"p=x"}


def test_update_and_delete(spark, table):
    before = files(table)
    update_partitions(spark, table, F.col("k") == 2, {"p": F.lit("y"), "v": F.upper("v")}, ["p"])
    assert read(spark, table) == sorted([(k, "B" if k == 2 else v, "y" if k == 2 else p) for k, v, p in ROWS], key=repr)
    after = files(table)
    assert {p for p in before if before[p] != after.get(p)} == {"p=x", "p=y"}
    # an unknown condition keeps its row
    delete_partitions(spark, table, F.col("k") >= 5, ["p"])
    assert read(spark, table) == sorted([(1, "a", "x"), (2, "B", "y"), (3, "c", "y"), (4, "d", "z/ 1"), (None, "g", "w")], key=repr)
    last = files(table)
    assert "p=__HIVE_DEFAULT_PARTITION__" not in last and last["p=x"] == after["p=x"] and last["p=y"] == after["p=y"]


def test_nothing_to_do(spark, table):
    before = files(table)
    delete_partitions(spark, table, F.lit(False), ["p"])
    update_partitions(spark, table, F.col("k") == -1, {"v": F.lit("!")}, ["p"])
    merge_partitions(table, spark.createDataFrame([], "k int, v string, p string"), ["k"], ["p"])
    assert files(table) == before
