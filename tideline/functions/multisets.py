"""Multisets as maps value -> multiplicity."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(m):
    return F.col(m) if isinstance(m, str) else m


def _zip(a, b, how) -> Column:
    zero = F.lit(0).cast("long")
    merged = F.map_zip_with(_col(a), _col(b), lambda k, x, y: how(F.coalesce(x, zero), F.coalesce(y, zero)))
    return F.map_filter(merged, lambda k, n: n > 0)


def multiset(*values) -> Column:
    """MULTISET[value, ...]: each different value with its multiplicity."""
    held = F.array(*[_col(v) for v in values])
    count = lambda x: F.size(F.filter(held, lambda y: y.eqNullSafe(x))).cast("long")
    return F.map_from_entries(F.transform(F.array_distinct(held), lambda x: F.struct(x, count(x))))


def union_all(a, b) -> Column:
    return _zip(a, b, lambda x, y: x + y)


def union_distinct(a, b) -> Column:
    return _zip(a, b, lambda x, y: F.least(x + y, F.lit(1).cast("long")))


def intersect_all(a, b) -> Column:
    return _zip(a, b, lambda x, y: F.least(x, y))


def intersect_distinct(a, b) -> Column:
    return _zip(a, b, lambda x, y: F.least(x, y, F.lit(1).cast("long")))


def except_all(a, b) -> Column:
    return _zip(a, b, lambda x, y: x - y)


def except_distinct(a, b) -> Column:
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    return _zip(a, b, lambda x, y: F.when((x > 0) & (y == 0), one).otherwise(none))


def member_of(value, m) -> Column:
    return F.coalesce(F.element_at(_col(m), value), F.lit(0).cast("long")) > 0


def submultiset_of(a, b) -> Column:
    return F.size(except_all(a, b)) == 0


def is_a_set(m) -> Column:
    return F.forall(F.map_values(_col(m)), lambda n: n == 1)


def cardinality(m) -> Column:
    return F.aggregate(F.map_values(_col(m)), F.lit(0).cast("long"), lambda acc, n: acc + n)


def element(m) -> Column:
    """The single element of a one-element multiset, null for an empty one, an error otherwise."""
    size = cardinality(m)
    return (F.when(size == 1, F.map_keys(_col(m))[0])
            .when(size > 1, F.raise_error(F.lit("the multiset has more than one element"))))


def as_text(m) -> Column:
    """Sorted ``value:n,value:n`` form, for comparing and printing."""
    entries = F.array_sort(F.map_entries(_col(m)))
    return F.array_join(F.transform(entries, lambda e: F.concat_ws(":", e["key"].cast("string"), e["value"].cast("string"))), ",")
