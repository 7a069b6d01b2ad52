"""Envelope JSON: a comma-separated header, then one JSON document per row.

Declared columns are found by name at any depth. The first hit in depth-first order is the first place
the key stands in the text, so a regular expression finds it without walking the document.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

TIME = "time"


def _raw(document: Column, name: str) -> Column:
    """Text of the value behind the first key of this name; '{' or '[' for objects and arrays."""
    key = re.escape(name)
    pattern = rf'(?<!\\)"{key}"\s*+:\s*+("[^"\\]*+(?:\\.[^"\\]*+)*+"|[\[{{]|[^,\s}}\]]++)'
    return F.regexp_extract(document, pattern, 1)


def _typed(raw: Column, kind: str) -> Column:
    """Lenient conversion: text that is no number is 0, text other than true is false."""
    unescaped = F.get_json_object(F.concat(F.lit('{"v":'), raw, F.lit("}")), "$.v")
    text = (F.when(~raw.startswith('"'), raw).when(F.contains(raw, F.lit("\\")), unescaped)
            .otherwise(F.substring(raw, F.lit(2), F.length(raw) - 2)))
    number = F.coalesce(text.try_cast("double"), F.when(text == "true", F.lit(1.0)), F.lit(0.0))
    if kind == "string" or kind.startswith(("varchar", "char")):
        return text
    if kind == "boolean":
        return F.when(raw.startswith('"'), F.trim(text) == "true").otherwise((text == "true") | (F.coalesce(text.try_cast("double"), F.lit(0.0)) != 0))
    if kind == "int":
        return F.coalesce(text.try_cast("int"), number.cast("int"))
    if kind == "bigint":
        return F.coalesce(text.try_cast("bigint"), number.cast("bigint"))
    if kind in ("double", "float"):
        return number.cast(kind)
    return F.lit(None).cast(kind)


def read_envelope(lines: DataFrame, schema: StructType | str, value: str = "value", on_error: str = "fail") -> DataFrame:
    """Parse a text column. The column named ``time`` is the header's second field.

    on_error: fail stops the job, drop leaves bad rows out, keep adds ``_corrupt`` with the bad text.
    A row is bad without a brace or second header field, with a broken document, and when a column is
    missing or holds an object or array.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if on_error not in ("fail", "drop", "keep"):
        raise ValueError("on_error is fail, drop or keep")
    text = F.col(value).cast("string")
    brace = F.instr(text, "{")
    # split() keeps trailing empty fields, which the header rule does not count
    header = F.split(F.regexp_replace(F.substring(text, F.lit(1), brace - 1), ",+$", ""), ",")
    document = F.substring(text, brace, F.length(text))
    bad = (text.isNull() | (brace == 0) | (F.size(header) < 2) | F.try_parse_json(document).isNull())
    names = [f.name for f in schema.fields if f.name != TIME]
    # inline() of a one-row array keeps the optimizer from repeating these expressions for every column
    row = F.struct(text.alias("__text"), bad.alias("__broken"), F.get(header, F.lit(1)).alias("__time"),
                   *[_raw(document, n).alias(f"__raw_{i}") for i, n in enumerate(names)])
    staged = lines.select(F.inline(F.array(row)))
    missing = [F.col(f"__raw_{i}").isin("", "{", "[") for i in range(len(names))]
    staged = staged.withColumn("__bad", reduce(lambda x, y: x | y, missing, F.col("__broken")))
    spot = {n: F.col(f"__raw_{i}") for i, n in enumerate(names)}
    ok = ~F.col("__bad")
    plain = [(F.col("__time") if f.name == TIME else _typed(spot[f.name], f.dataType.simpleString())).alias(f.name)
             for f in schema.fields]
    if on_error == "drop":
        return staged.where(ok).select(*plain)
    out = [F.when(ok, c).alias(f.name) for c, f in zip(plain, schema.fields)]
    if on_error == "keep":
        return staged.select(*out, F.when(F.col("__bad"), F.col("__text")).alias("_corrupt"))
    message = F.concat(F.lit("bad envelope row: "), F.coalesce("__text", F.lit("null")))
    checked = staged.withColumn("__text", F.when(F.col("__bad"), F.raise_error(message)).otherwise(F.col("__text")))
    # the check must run whichever columns are read later, so every output depends on it
    return checked.select(*[F.when(F.col("__text").isNotNull(), c).alias(f.name) for c, f in zip(out, schema.fields)])


def map_from_pairs(pairs: str, null_key: str = "fail", literal: str = "null") -> Column:
    """Map from an array of (key, value) pairs with a rule for null keys: fail, drop or literal."""
    col = F.col(pairs)
    if null_key == "drop":
        return F.map_from_entries(F.filter(col, lambda p: p["key"].isNotNull()))
    if null_key == "literal":
        return F.map_from_entries(F.transform(
            col, lambda p: F.struct(F.coalesce(p["key"], F.lit(literal)).alias("key"), p["value"].alias("value"))))
    if null_key == "fail":
        return F.map_from_entries(col)
    raise ValueError("null_key is fail, drop or literal")


def write_envelope(df: DataFrame, columns: list[str]) -> DataFrame:
    """Flat JSON of the declared columns, nulls included."""
    return df.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value"))
