"""MERGE, UPDATE and DELETE on a partitioned parquet folder, which rewrite the partitions they touch and no other.

A statement first finds the partitions it touches, reading keys and partition columns only. The new content of these is
written to the shared folder and then replaces them by Spark's dynamic partition overwrite, whose commit moves finished
folders into place: a statement that fails before leaves the table as it was. Partitions left without rows are removed.
One statement runs on a table at a time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.changelog import delete_where, merge_rows, update_where
from ..plans.sizes import broadcast_if_small
from ..plans.skew import meets
from ..plans.staging import staged

#: touched partitions that are named in the scan's partition filter; more of them are joined
NAMED = 1000
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder of a null partition value


def _only(target: DataFrame, touched: DataFrame, by: list[str]) -> DataFrame:
    """The rows of the touched partitions; the scan reads no other files."""
    some = touched.limit(NAMED + 1).collect()
    if len(some) <= NAMED:
        here = [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(r[c])) for c in by]) for r in some]
        return target.where(reduce(lambda a, b: a | b, here, F.lit(False)))
    named = touched.select(*[F.col(c).alias(f"__p_{c}") for c in by])
    return target.join(broadcast_if_small(named), meets(by, "__p_"), "left_semi")


def _replace(spark: SparkSession, path: str, content: DataFrame, touched: DataFrame, by: list[str]) -> None:
    ready = staged(content, "rewritten")
    filled = ready.select(*by).distinct()
    (ready.write.partitionBy(*by).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path))
    # at most one row per partition of the table
    emptied = touched.join(filled.select(*[F.col(c).alias(f"__p_{c}") for c in by]), meets(by, "__p_"), "left_anti").collect()
    if emptied:
        base = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = base.getFileSystem(spark._jsc.hadoopConfiguration())
        for row in emptied:
            parts = [f"{c}={NO_VALUE if row[c] is None else spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(row[c]))}" for c in by]
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(base, "/".join(parts)), True)


def merge_partitions(path: str, source: DataFrame, keys: list[str], by: list[str], delete_flag: str | None = None) -> DataFrame:
    """MERGE ``source`` (one row per key) into the table at ``path``, partitioned ``by``: as changelog.merge_rows, but only the
    partitions that hold a key of the source, or get a row from it, are read and rewritten. Returns the touched partitions."""
    spark = source.sparkSession
    target, source = spark.read.parquet(path), staged(source, "merged-rows")
    touched = target.select(*dict.fromkeys([*keys, *by])).join(broadcast_if_small(source.select(*keys).distinct()), keys, "left_semi").select(*by)
    if set(by) <= set(source.columns):
        stays = source.where(~F.coalesce(F.col(delete_flag), F.lit(False))) if delete_flag else source
        touched = touched.unionByName(stays.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in by]))
    touched = staged(touched.distinct(), "touched")
    _replace(spark, path, merge_rows(_only(target, touched, by), source, keys, delete_flag), touched, by)
    return touched


def update_partitions(spark: SparkSession, path: str, condition: Column, assignments: dict[str, Column], by: list[str]) -> DataFrame:
    """UPDATE SET ... WHERE on the table at ``path``. Rows may move to other partitions, which keep the rows they have."""
    target = spark.read.parquet(path)
    hit = target.where(F.coalesce(condition, F.lit(False)))
    touched = hit.select(*by)
    if set(by) & set(assignments):
        touched = touched.unionByName(update_where(hit, F.lit(True), assignments).select(*by))
    touched = staged(touched.distinct(), "touched")
    _replace(spark, path, update_where(_only(target, touched, by), condition, assignments), touched, by)
    return touched


def delete_partitions(spark: SparkSession, path: str, condition: Column, by: list[str]) -> DataFrame:
    """DELETE WHERE on the table at ``path``."""
    target = spark.read.parquet(path)
    touched = staged(target.where(F.coalesce(condition, F.lit(False))).select(*by).distinct(), "touched")
    _replace(spark, path, delete_where(_only(target, touched, by), condition), touched, by)
    return touched
