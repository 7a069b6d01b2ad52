"""Sharding: a Feistel permutation with cycle walking over global row numbers.

The permuted number p of row r of N says everything: shard p mod S, slot p div S. Shards differ by one row
at most, the order within them is a reproducible shuffle, and where a row lies can be computed from its number.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..plans.staging import staged
from .rows import numbered

PRIME = (1 << 31) - 1
#: fixed odd constants, two for each round: multiplier and offset of the round's mixing function
ROUNDS = ((1566083941, 402653189), (1337006139, 805306457), (1873012691, 1610612741),
          (1232145661, 201326611), (1719614413, 100663319), (1442695041, 50331653))


def half_bits(n: int) -> int:
    """Bits of each half: the permuted domain is the smallest even power of two that holds n numbers."""
    return max(1, -(-max(1, (n - 1).bit_length()) // 2))


def permuted(x: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A permutation of 0..n-1: Feistel rounds, walked on while the result is n or above."""
    bits = half_bits(n)
    mask = (1 << bits) - 1
    out = x.astype(np.int64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> bits, out[todo] & mask
        for multiplier, offset in ROUNDS:
            # halves are below 2**31, so squares and products stay below 2**63
            left, right = right, left ^ ((((right * right) % PRIME + right * multiplier + offset + seed) % PRIME) & mask)
        out[todo] = (left << bits) | right
        todo = todo[out[todo] >= n]
    return out


def permutation(row: Column, n: int, seed: int = 0) -> Column:
    if n > 1 << 62:
        raise ValueError("more rows than the permutation covers")
    @F.pandas_udf("long")
    def run(x: pd.Series) -> pd.Series:
        return pd.Series(permuted(x.to_numpy(np.int64), n, seed))
    return run(row)


def sharded(docs: DataFrame, shards: int = 24, seed: int = 0) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 8), text_crc32, law, shard, slot, grown_shard of every row.

    Rows are numbered by (doc_id, text_crc32, size), nulls first. Rows equal in all three may swap their
    places, which changes nothing that is returned. Null texts count as empty. Other columns are ignored;
    an empty table gives no rows."""
    bytes_ = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "utf-8")
    sized = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.length(bytes_) + 8).cast("long").alias("size"),
                               F.crc32(bytes_).alias("text_crc32")), "sized")
    rows, n = numbered(sized, ["doc_id", "text_crc32", "size"], "__row")
    placed = rows.withColumn("__p", permutation(F.col("__row"), n, seed))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), (F.col("__p") % shards).cast("int").alias("shard"),
                         F.expr(f"__p div {shards}").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
