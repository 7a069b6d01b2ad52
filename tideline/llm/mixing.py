"""Mixing sources to target weights.

Tokens are summed per source; targets and repetition rates follow from the weights; every document is
emitted floor(rate) times and once more where a hash of its id says so with the probability left over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.sizes import broadcast_if_small
from ..plans.staging import staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SEED = "mix"


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.expr(f"regexp_count({text}, r'{WORD}')"), F.lit(0)).cast("long")


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size, target) from (source, source_size): shares of all sizes by weight, a target at
    most ``most`` times its source, the excess shared anew by weight until none is above.

    That is one level L for all: target = min(most * size, L * weight). Along rising most * size / weight
    the sources that stop come first, so running sums find L. Only the sources' rows meet in this window."""
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    weighed = totals.withColumn("turn", F.row_number().over(order) - 1).withColumn(
        "w", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("turn") % len(weights) + 1).cast("int")).cast("long"))
    all_ = Window.partitionBy(F.lit(0))
    rising = all_.orderBy(F.col("source_size") * most / F.col("w"), "turn")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    stops = (weighed.withColumn("left_size", F.sum("source_size").over(all_) - F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0)))
             .withColumn("left_weight", F.sum("w").over(rising.rowsBetween(0, Window.unboundedFollowing)))
             # stopped: its share of what is left reaches its most
             .withColumn("stopped", F.col("left_size") * F.col("w") >= F.col("source_size") * most * F.col("left_weight"))
             .withColumn("open_weight", F.max(F.when(~F.col("stopped"), F.col("left_weight"))).over(all_))
             .withColumn("open_size", F.max_by("left_size", F.when(~F.col("stopped"), F.col("left_weight"))).over(all_)))
    share = F.col("open_size") * F.col("w") / F.col("open_weight")
    return stops.select("source", "source_size", F.when(F.col("stopped"), (F.col("source_size") * most).cast("double"))
                        .otherwise(share.cast("double")).alias("target"))


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the seed, the id and the text, so that rows without an id do not all draw alike."""
    row = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), F.md5(F.coalesce(text.cast("string"), F.lit(""))))
    return F.conv(F.substring(F.md5(row), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, copies and taken of every document.

    Null and empty texts have size 0. Documents without a source are one source, the last. A source of size
    0 has target 0 and rate 0: none of its documents is taken. Rows with the same id and text count each and draw alike.
    Other columns are ignored; an empty table gives no rows."""
    sized = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                               n_words().alias("size"), draw(F.col("doc_id").cast("long"), F.col("text"), seed).alias("__draw")), "sizes")
    goal = rates(sized, weights, most)
    rows = sized.join(goal, F.col("source").eqNullSafe(F.col("of")), "left")
    return rows.select("doc_id", "size", "source_size", "target", _copies().alias("copies"),
                       (F.col("size") * _copies()).alias("taken"))


def rates(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """(of, source_size, target, rate) per source, broadcast where small."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = staged(targets(totals, weights, most).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)), "targets")
    return broadcast_if_small(goal.withColumnRenamed("source", "of"), 8 << 20)


def _copies() -> Column:
    whole = F.floor("rate")
    return whole + F.when(F.col("__draw") < F.col("rate") - whole, 1).otherwise(0)


def repeated(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: str = SEED) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken. Sizes are counted in one pass over
    the texts and the rows are emitted in a second one; the texts are not shuffled."""
    sized = docs.select(F.col("source").cast("string").alias("source"), n_words().alias("size")).groupBy("source").agg(F.sum("size").alias("size"))
    goal = rates(sized, weights, most).select(F.struct("of", "rate").alias("__goal"))
    held = docs.select(F.struct(*docs.columns).alias("__doc"))
    rows = held.join(goal, F.col("__doc.source").cast("string").eqNullSafe(F.col("__goal.of")))
    rows = rows.select("__doc", F.col("__goal.rate").alias("rate"), draw(F.col("__doc.doc_id").cast("long"), F.col("__doc.text"), seed).alias("__draw"))
    return rows.select(F.explode(F.array_repeat("__doc", _copies().cast("int"))).alias("d")).select("d.*")
