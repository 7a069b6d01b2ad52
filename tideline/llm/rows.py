"""Row numbers over a whole table without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..plans.staging import staged

IN_PARTITION = (1 << 33) - 1


def numbered(df: DataFrame, order: list[str], name: str = "row_number") -> tuple[DataFrame, int]:
    """``df`` with numbers 0..N-1 along ``order``, and N. Rows are range-partitioned and written once; the
    places of the partitions are one number per partition. Give an order that tells different rows apart:
    then the numbers depend on the rows alone, not on how they were partitioned."""
    placed = staged(df.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("__at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("__at", 33)
    sizes = sorted(placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    total, offsets = 0, []
    for row in sizes:
        offsets.append((row["part"], total))
        total += row["n"]
    spark = df.sparkSession
    # as many rows as the table has partitions
    places = spark.createDataFrame(offsets, "__part long, __before long")
    out = (placed.withColumn("__part", part).join(F.broadcast(places), "__part")
           .withColumn(name, F.col("__before") + F.col("__at").bitwiseAND(IN_PARTITION)).drop("__at", "__part", "__before"))
    return out, total
