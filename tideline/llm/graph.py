"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from ..plans.staging import staged


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, written, and a fingerprint of them that the write itself has observed."""
    seen = Observation()
    out = staged(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")), "edges")
    return out, (seen.get["n"], seen.get["h"])


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, root): the smallest node reachable from each node over the links (a, b). Nodes without
    links are not listed. Every step works on edges only; minima are combined before the shuffle, so a
    node with many links is no single task, and every step is written to the shared folder.

    ``known`` are components of other links that hold as well: new links then join their roots only."""
    if known is not None:
        one = known.select(F.col("node").alias("a"), F.col("root").alias("r_a"))
        two = known.select(F.col("node").alias("b"), F.col("root").alias("r_b"))
        links = (links.join(one, "a", "left").join(two, "b", "left").select(F.coalesce("r_a", "a").alias("a"), F.coalesce("r_b", "b").alias("b"))
                 .unionByName(known.select(F.col("root").alias("a"), F.col("node").alias("b"))))
    edges, before = _written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a != b")
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").select(F.explode(F.array(
            F.struct("m", F.col("a").alias("x")), F.struct("m", F.col("b").alias("x")))).alias("e"))
        edges, after = _written(small.select(F.col("e.m").alias("a"), F.col("e.x").alias("b")).where("a != b").distinct())
        if after == before:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        before = after
