"""Changelog rows folded into the table they describe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


COPIES_PER_TASK = 100_000


def fold_retractions(log: DataFrame, columns: list[str], sign: str, copies_per_task: int = COPIES_PER_TASK) -> DataFrame:
    """Add / retract log -> table. Equal rows are counted before the shuffle; a row with net count n
    appears n times. Rows with very many copies are cut into parts that spread over the tasks."""
    net = log.groupBy(*columns).agg(F.sum(sign).alias("__n")).where("__n > 0")
    one = F.lit(1).cast("long")
    few = net.where(F.col("__n") <= copies_per_task)
    parts = F.ceil(F.col("__n") / copies_per_task)
    many = (net.where(F.col("__n") > copies_per_task)
            .withColumn("__part", F.explode(F.sequence(one, parts)))
            .repartition(*columns, "__part")
            .withColumn("__n", F.least(F.lit(copies_per_task), F.col("__n") - (F.col("__part") - 1) * copies_per_task)))
    copied = lambda df: df.select(*columns, F.explode(F.sequence(one, F.col("__n"))).alias("__i")).drop("__i")
    return copied(few).unionByName(copied(many))


def unmatched_retractions(log: DataFrame, columns: list[str], sign: str) -> DataFrame:
    """Rows retracted more often than they were added, with the surplus."""
    return (log.groupBy(*columns).agg((-F.sum(sign)).alias("surplus")).where("surplus > 0"))


def fold_upserts(log: DataFrame, keys: list[str], sequence: str, is_delete: str) -> DataFrame:
    """Upsert log -> table: the last change per key wins, a deletion removes the key."""
    row = F.max_by(F.struct(*log.columns), F.col(sequence)).alias("__row")
    return (log.groupBy(*keys).agg(row).select("__row.*").where(~F.col(is_delete)).drop(is_delete, sequence))


def merge_rows(target: DataFrame, source: DataFrame, keys: list[str], delete_flag: str | None = None) -> DataFrame:
    """MERGE as a full outer join: source rows replace or extend the target; flagged rows delete.
    Columns of the target missing from the source keep their value."""
    flag = F.coalesce(F.col(f"s.{delete_flag}"), F.lit(False)) if delete_flag else F.lit(False)
    joined = target.alias("t").join(
        source.withColumn("__hit", F.lit(True)).alias("s"),
        [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full").where(~flag)
    pick = lambda c: (F.when(F.col("s.__hit"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
                      if c in source.columns else F.col(f"t.{c}"))
    return joined.select(*[F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")).alias(c) if c in keys
                           else pick(c).alias(c) for c in target.columns])


def update_where(target: DataFrame, condition: Column, assignments: dict[str, Column]) -> DataFrame:
    """UPDATE SET ... WHERE: rows for which the condition is true take the new values, which see the old row."""
    hit = F.coalesce(condition, F.lit(False))
    return target.select(*[F.when(hit, assignments[c]).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c)
                           if c in assignments else F.col(c) for c in target.columns])


def delete_where(target: DataFrame, condition: Column) -> DataFrame:
    """DELETE WHERE: rows for which the condition is true go; an unknown condition keeps its row."""
    return target.where(~F.coalesce(condition, F.lit(False)))
