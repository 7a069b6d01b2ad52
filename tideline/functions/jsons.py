"""SQL/JSON functions on JSON text columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: as on_empty or on_error: the query fails instead of answering
ERROR = object()


def _answer(choice, what: str) -> Column:
    return F.raise_error(F.lit(f"JSON {what}")).cast("string") if choice is ERROR else F.lit(choice)


def json_exists(text: str, path: str) -> Column:
    """Also true where the path leads to a JSON null."""
    return F.expr(f"coalesce(variant_get(try_parse_json({text}), '{path}', 'variant') IS NOT NULL, false)")


def json_value(text: str, path: str, returning: str = "string", on_empty=None, on_error=None) -> Column:
    """Scalar at the path. on_empty answers a missing path, on_error invalid text, an object, an array
    or a value that cannot be cast. Either may be ERROR."""
    empty, wrong = (_answer(x, what).cast(returning) for x, what in ((on_empty, "path leads nowhere"), (on_error, "value is not the scalar asked for")))
    parsed = f"try_parse_json({text})"
    found = F.expr(f"try_variant_get({parsed}, '{path}', 'variant')")
    kind = F.schema_of_variant(found)
    scalar = F.expr(f"try_variant_get({parsed}, '{path}', '{returning}')")
    return (F.when(F.col(text).isNull(), F.lit(None))
            .when(F.expr(f"{parsed} IS NULL"), wrong)
            .when(found.isNull(), empty)
            .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), wrong)
            .when(kind == "VOID", F.lit(None))
            .otherwise(F.coalesce(scalar, wrong)))


def json_query(text: str, path: str, wrapper: str = "without") -> Column:
    """Object or array at the path as JSON text. wrapper: without (a scalar gives null), conditional
    (a scalar is put into an array), unconditional (anything is)."""
    found = F.expr(f"try_variant_get(try_parse_json({text}), '{path}', 'variant')")
    kind = F.schema_of_variant(found)
    nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    plain, wrapped = F.to_json(found), F.concat(F.lit("["), F.to_json(found), F.lit("]"))
    if wrapper == "without":
        return F.when(found.isNotNull() & nested, plain)
    if wrapper == "conditional":
        return F.when(found.isNotNull(), F.when(nested, plain).otherwise(wrapped))
    return F.when(found.isNotNull(), wrapped)


def json_object(absent_on_null: bool = False, **columns) -> Column:
    options = {"ignoreNullFields": str(absent_on_null).lower()}
    return F.to_json(F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()]), options)


def json_array(*columns, absent_on_null: bool = True) -> Column:
    """Array of values of any types. Nulls are left out unless asked for."""
    texts = [F.to_json((F.col(c) if isinstance(c, str) else c).cast("variant")) for c in columns]
    items = F.array(*[t if absent_on_null else F.coalesce(t, F.lit("null")) for t in texts])
    return F.concat(F.lit("["), F.array_join(F.filter(items, lambda x: x.isNotNull()), ","), F.lit("]"))


def json_objectagg(key: str, value: str, absent_on_null: bool = False) -> Column:
    """Aggregate into one JSON object per group, keys in order. Give it groups of bounded size."""
    pair = F.struct(F.col(key).cast("string").alias("key"), F.col(value).alias("value"))
    pairs = F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), pair) if absent_on_null else pair))
    return F.to_json(F.map_from_entries(pairs))


def json_arrayagg(value: str, order: str, absent_on_null: bool = True) -> Column:
    """Aggregate into one JSON array per group in the given order. Nulls are left out unless asked for."""
    pair = F.struct(order, value)
    pairs = F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), pair) if absent_on_null else pair))
    return F.to_json(F.transform(pairs, lambda p: p[value]))
