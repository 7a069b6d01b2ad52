"""User-defined functions: native expressions where one exists, Arrow batches where Python is wanted."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType


# --- scalar ---------------------------------------------------------------------------------------

def increment(x: str, by: int = 1) -> Column:
    return F.col(x) + by


def concat_with_null(*columns: str, separator: str = "") -> Column:
    """Concatenation that prints a null argument as 'null'."""
    return F.concat_ws(separator, *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns])


def product(*columns: str) -> Column:
    return reduce(lambda a, b: a * b, [F.col(c) for c in columns])


def time_minus(time: str, milliseconds: int) -> Column:
    return F.col(time) - F.expr(f"INTERVAL '{milliseconds / 1000:.3f}' SECOND")


def nested_row(name: str, number: str) -> Column:
    """A row holding a nested row."""
    return F.struct(F.col(name).alias("name"), F.struct(F.col(number).alias("n"), (F.col(number) * 2).alias("twice")).alias("inner"))


@F.pandas_udf(LongType())
def increment_batch(x: pd.Series) -> pd.Series:
    return x + 1


@F.udf(returnType=LongType(), useArrow=True)
def increment_row(x):
    return None if x is None else x + 1


def prefixer(prefix: str):
    """A function with state made once per task: each batch of an Arrow stream sees the opened prefix."""
    @F.pandas_udf(StringType())
    def add_prefix(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        opened = f"{prefix}-"
        for batch in batches:
            yield opened + batch
    return add_prefix


@F.udf(returnType=StructType([StructField("upper", StringType()), StructField("size", IntegerType())]), useArrow=True)
def describe(text):
    return None if text is None else (text.upper(), len(text))


def random_label():
    """A function Spark must not fold or repeat."""
    return F.udf(lambda: __import__("uuid").uuid4().hex, StringType()).asNondeterministic()


# --- table functions ------------------------------------------------------------------------------

def split_text(text: str, separators: str = ",", start: int = 0) -> Column:
    """Pieces between any of the separator characters, empty pieces dropped, from index ``start`` on
    (a negative start is 0). Use inside ``select``; a null text gives no rows."""
    pattern = "[" + "".join("\\" + c if c in "\\]^-[" else c for c in separators) + "]"
    pieces = F.filter(F.split(F.col(text), pattern), lambda p: p != "")
    return F.explode(F.slice(pieces, max(start, 0) + 1, 2_147_483_647 - max(start, 0) - 1))


def total_length(*columns: str) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(F.length(c), F.lit(0)) for c in columns])


def emit_three(date: str, number: str, time: str) -> Column:
    """Three rows: days of the date, the number, milliseconds of the time."""
    return F.explode(F.array(F.unix_date(date).cast("long"), F.col(number).cast("long"),
                             F.unix_millis(F.col(time).cast("timestamp"))))


def twelve_columns(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    letters = [F.concat(F.col(text), F.lit(f"_{c}")).alias(f"t_{c}") for c in "abcdef"]
    sizes = [(F.length(text) + i).alias(f"n_{i}") for i in range(6)]
    return df.select(*keep, *letters, *sizes)


def repeat_rows(text: str, times: str) -> Column:
    return F.explode(F.array_repeat(F.col(text), F.greatest(F.col(times), F.lit(0)).cast("int")))


@F.udtf(returnType="word: string, position: int")
class SplitWords:
    """Python table function usable as LATERAL split_words(text, separator)."""

    def eval(self, text: str, separator: str):
        if text is not None:
            for i, piece in enumerate(p for p in text.split(separator) if p):
                yield piece, i


def pick_one(text: str, separator: str = "#") -> Column:
    """A random piece of the text."""
    pieces = F.split(F.col(text), separator)
    return F.element_at(pieces, (F.floor(F.rand() * F.size(pieces)) + 1).cast("int"))


def register_all(spark: SparkSession) -> None:
    """Make the functions callable from SQL."""
    spark.udf.register("increment_batch", increment_batch)
    spark.udf.register("increment_row", increment_row)
    spark.udf.register("describe_text", describe)
    spark.udtf.register("split_words", SplitWords)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION weighted(v BIGINT, w BIGINT) RETURNS BIGINT RETURN v * w")
