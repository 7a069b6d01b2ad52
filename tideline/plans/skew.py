"""Hot-key detection and salted joins.

A key is hot when it has more than ``rows_per_group`` rows, so there can never be more hot keys than
``total rows / rows_per_group``: the list of hot keys is small by construction.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

ROWS_PER_GROUP = 1_000_000
SALT = "__salt"
BROADCAST_KEYS = 100_000


def meets(keys: list[str], prefix: str, also: Column | None = None, null_safe: bool = True) -> Column:
    """Join condition ``key = prefix + key`` for every key; null keys meet only if null_safe."""
    pairs = [F.col(k).eqNullSafe(F.col(prefix + k)) if null_safe else F.col(k) == F.col(prefix + k)
             for k in keys]
    return reduce(lambda a, b: a & b, pairs if also is None else [*pairs, also])


def hot_keys(df: DataFrame, keys: list[str], rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """The keys holding more than rows_per_group rows. Counts are combined before the shuffle."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
            .where(F.col("__n") > rows_per_group))


def salted_join(facts: DataFrame, dim: DataFrame, keys: list[str], how: str = "left",
                rows_per_group: int = ROWS_PER_GROUP, hint: str | None = None) -> DataFrame:
    """Hash join in which hot fact keys are spread over several tasks. Without hot keys, a plain join.

    Rows of a hot key get a salt 0..n-1 with n from the key's own row count; the matching dimension
    rows are repeated n times. Rows of other keys keep salt 0 and are never repeated.
    ``how`` is inner, left, left_semi or left_anti; the dimension side carries the equal key names.
    ``hint`` is a join hint for the dimension side of whichever join runs.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a salted join cannot be {how}")
    hinted = lambda side: side.hint(hint) if hint else side
    known = facts.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])).select(*keys)
    if known.count() <= rows_per_group:
        return facts.join(hinted(dim), keys, how)
    sizes = hot_keys(known, keys, rows_per_group)
    n_hot = sizes.count()
    if n_hot == 0:
        return facts.join(hinted(dim), keys, how)
    hot = sizes.select(*[F.col(k).alias(f"__hot_{k}") for k in keys],
                       F.ceil(F.col("__n") / rows_per_group).cast("int").alias("__copies"))
    hot = F.broadcast(hot) if n_hot <= BROADCAST_KEYS else hot
    on_hot = meets(keys, "__hot_", null_safe=False)
    drop = ["__copies", *[f"__hot_{k}" for k in keys]]
    spread = (facts.join(hot, on_hot, "left")
              .withColumn(SALT, F.when(F.col("__copies").isNull(), F.lit(0))
                          .otherwise(F.pmod(F.xxhash64(*facts.columns), F.col("__copies")).cast("int")))
              .drop(*drop))
    copies = (dim.join(hot, on_hot, "left")
              .withColumn(SALT, F.explode(F.sequence(F.lit(0), F.coalesce("__copies", F.lit(1)) - 1)))
              .drop(*drop))
    return spread.join(hinted(copies), [*keys, SALT], how).drop(SALT)
