"""Lookup, interval, period and null-aware joins over bounded or streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.durations import at, micros
from ..plans.sizes import BROADCAST_BYTES, broadcast_if_small, estimated_bytes
from ..plans.skew import ROWS_PER_GROUP, meets, salted_join


#: a table up to this size (as Catalyst estimates it) may be built into hash maps, one per shuffle partition
HASHED_BYTES = 16 * BROADCAST_BYTES


def lookup_join(facts: DataFrame, dim: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Probe a keyed table once per fact row: left pads a miss with nulls, inner drops it.
    The planner broadcasts the table where its size allows and splits skewed partitions otherwise."""
    if how not in ("left", "inner"):
        raise ValueError("a lookup join is left or inner")
    return facts.join(dim, keys, how)


def keyed_lookup_join(facts: DataFrame, dim: DataFrame, keys: list[str], how: str = "left",
                      rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """Lookup join with the facts hash-distributed on the key; hot keys are salted. The table is hashed per task
    where its size allows; a larger one is sorted, which spills."""
    hint = "shuffle_hash" if estimated_bytes(dim) <= HASHED_BYTES else None
    return salted_join(facts, dim, keys, how, rows_per_group, hint)


def broadcast_lookup_join(facts: DataFrame, dim: DataFrame, keys: list[str], how: str = "left",
                          max_bytes: int = BROADCAST_BYTES,
                          rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """Lookup join with the table copied to every task while it is small, hash-distributed beyond."""
    if estimated_bytes(dim) <= max_bytes:
        return facts.join(F.broadcast(dim), keys, how)
    return keyed_lookup_join(facts, dim, keys, how, rows_per_group)


def first_value_enrich(data: DataFrame, control: DataFrame, key: str, value: str, time: str,
                       missing: str = "No match") -> DataFrame:
    """Enrich rows with the first value a control stream announced for their key."""
    known = control.groupBy(key).agg(F.min_by(value, time).alias("__known"))
    return (data.join(broadcast_if_small(known), [key], "left")
            .withColumn("match", F.coalesce(F.col("__known").cast("string"), F.lit(missing)))
            .drop("__known"))


def interval_join(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str,
                  lower: str | int, upper: str | int, how: str = "inner",
                  row_id: list[str] | None = None) -> DataFrame:
    """Rows of equal key with right_time in [left_time + lower, left_time + upper].

    Time is cut into cells as long as the interval, and the cell joins the equality keys: a left row
    looks at no more than two cells, so a hot key is spread over its cells and never paired with its
    whole history. ``how='left'`` needs ``row_id``, the columns naming a left row. Column names of
    the two sides must differ except for the keys.
    """
    low, high = micros(lower), micros(upper)
    width = max(high - low, 1)
    lt, rt = at(left_time), at(right_time)
    cell = lambda us: F.floor(us / width)
    if how not in ("inner", "left") or how == "left" and not row_id:
        raise ValueError("how is inner, or left with row_id")
    cells = F.sequence(cell(lt + low), cell(lt + high))
    target = (right.select(*[F.col(c).alias(f"__r_{c}" if c in keys else c) for c in right.columns])
              .withColumn("__rcell", cell(rt)))
    cond = meets(keys, "__r_", null_safe=False) & (F.col("__cell") == F.col("__rcell")) & (rt - lt).between(low, high)
    extra = ["__cell", "__rcell", *[f"__r_{k}" for k in keys]]
    if how == "inner":
        return left.withColumn("__cell", F.explode(cells)).join(target, cond).drop(*extra)
    # every cell of a left row looks for partners; of a row without any, the first cell's padding stays
    probes = left.select("*", F.posexplode_outer(cells).alias("__nth", "__cell"))
    tried = probes.join(target, cond, "left")
    found = F.max(F.col("__rcell").isNotNull()).over(Window.partitionBy(*row_id))
    return (tried.withColumn("__found", found)
            .where(F.col("__rcell").isNotNull() | (~F.col("__found") & (F.coalesce("__nth", F.lit(0)) == 0)))
            .drop("__nth", "__found", *extra))


def theta_join(left: DataFrame, right: DataFrame, condition: Column, how: str = "inner") -> DataFrame:
    """Equality plus inequality condition; null keys never match."""
    return left.join(right, condition, how)


def not_in(left: DataFrame, right: DataFrame, column: str, right_column: str) -> DataFrame:
    """``left.column NOT IN (right)`` with SQL's null rules, as a distributed anti join."""
    values = right.select(F.col(right_column).alias("__v"))
    if not values.where("__v IS NULL").isEmpty():
        return left.where(F.lit(False))
    if values.isEmpty():
        return left
    return left.where(F.col(column).isNotNull()).join(values, F.col(column) == F.col("__v"), "left_anti")


def compare_any(left: DataFrame, column: str, op: str, right: DataFrame | list, right_column: str = "value") -> DataFrame:
    """``column <op> SOME (right)`` for < <= > >= = <>: the extremes of the right side decide. ``right`` is a
    table or a list of values."""
    right = _values(left, column, right, right_column)
    if op == "=":
        return left.join(right.select(F.col(right_column).alias("__v")),
                         F.col(column) == F.col("__v"), "left_semi")
    return left.where(_against_extreme(right, right_column, column, op, any_of=True))


def compare_all(left: DataFrame, column: str, op: str, right: DataFrame | list, right_column: str = "value") -> DataFrame:
    """``column <op> ALL (right)`` for < <= > >= = <>. True on an empty right side, never true when the
    right side holds a null."""
    right = _values(left, column, right, right_column)
    if op == "<>":
        return not_in(left, right, column, right_column)
    return left.where(_against_extreme(right, right_column, column, op, any_of=False))


def _values(left: DataFrame, column: str, right: DataFrame | list, name: str) -> DataFrame:
    if isinstance(right, DataFrame):
        return right
    kind = left.schema[column].dataType.simpleString()
    return left.sparkSession.createDataFrame([(v,) for v in right], f"`{name}` {kind}")


def _against_extreme(right, right_column, column, op, any_of) -> Column:
    row = right.agg(F.min(right_column).alias("lo"), F.max(right_column).alias("hi"), F.count(F.lit(1)).alias("n"),
                    F.count(right_column).alias("known")).first()
    if row["n"] == 0:
        return F.lit(not any_of)
    if row["known"] == 0 or (not any_of and row["known"] < row["n"]):
        return F.lit(False)
    col, lo, hi = F.col(column), F.lit(row["lo"]), F.lit(row["hi"])
    if op == "<>":  # some other value stands on the right
        return (col != lo) | (col != hi)
    if op == "=":   # all values are this one
        return (col == lo) & (col == hi)
    bound = lo if (op in ("<", "<=")) != any_of else hi
    return {"<": col < bound, "<=": col <= bound, ">": col > bound, ">=": col >= bound}[op]


PERIOD_PREDICATES = {
    "overlaps": lambda a, b, c, d: (a < d) & (c < b),
    "contains": lambda a, b, c, d: (a <= c) & (d <= b),
    "equals": lambda a, b, c, d: (a == c) & (b == d),
    "precedes": lambda a, b, c, d: b <= c,
    "succeeds": lambda a, b, c, d: a >= d,
    "immediately_precedes": lambda a, b, c, d: b == c,
    "immediately_succeeds": lambda a, b, c, d: a == d,
}


def period_predicate(name: str, start: str, end: str, other_start: str, other_end: str) -> Column:
    return PERIOD_PREDICATES[name](*[F.col(c) for c in (start, end, other_start, other_end)])


def _cells(start: str, end: str, width: int) -> tuple[Column, Column]:
    """First and last cell that the half-open period touches."""
    return F.floor(at(start) / width), F.floor((at(end) - 1) / width)


def tree_nodes(first: Column, last: Column, levels: int) -> Column:
    """The nodes (level, number) of a binary tree over cells that make up the cells first..last: at most two a level."""
    def of_level(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        low, high = F.call_function("shiftright", first + size - 1, level), F.call_function("shiftright", last + 1, level)
        node = lambda odd, number: F.when((low < high) & (odd % 2 != 0), F.struct(level.alias("level"), number.alias("number")))
        return F.array(node(low, low), node(high, high - 1))
    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(max(levels - 1, 0))), of_level)))


def _starts_within(points: DataFrame, point: str, periods: DataFrame, start: str, end: str, keys: Column, width: int, levels: int) -> DataFrame:
    """Pairs of a row of ``points`` and one of ``periods`` whose cells hold the point's: each pair once. A period is listed
    under the few nodes that make it up, a point under the nodes above its cell, and both meet in one node."""
    cell = F.floor(at(point) / width)
    above = F.transform(F.sequence(F.lit(0), F.lit(max(levels - 1, 0))), lambda l: F.struct(l.alias("level"), F.call_function("shiftright", cell, l).alias("number")))
    listed = periods.withColumn("__node", F.explode(tree_nodes(*_cells(start, end, width), levels)))
    return points.withColumn("__above", F.explode(above)).join(listed, keys & (F.col("__above") == F.col("__node"))).drop("__above", "__node")


def period_join(left: DataFrame, right: DataFrame, keys: list[str], left_period: tuple[str, str],
                right_period: tuple[str, str], predicate: str = "overlaps",
                cell: str | int = "1 hour") -> DataFrame:
    """Join two tables of half-open periods [start, end) on equal keys and a period predicate.

    Of two periods that overlap, one holds the start of the other; one that contains another holds its start. Starts
    look for periods in a binary tree over cells of time: a period of n cells is listed under at most 2 log2(n) nodes,
    however long it is, and no pair is seen twice. The other predicates pin one instant and become plain equality joins.
    precedes and succeeds describe nearly all pairs and are offered as ``period_predicate`` only.
    """
    a, b = left_period
    c, d = right_period
    other = right.select(*[F.col(x).alias(f"__r_{x}" if x in keys else x) for x in right.columns])
    cond = meets(keys, "__r_", null_safe=False) if keys else F.lit(True)
    exact = {"equals": (F.col(a) == F.col(c)) & (F.col(b) == F.col(d)),
             "immediately_precedes": F.col(b) == F.col(c), "immediately_succeeds": F.col(a) == F.col(d)}
    drop = [f"__r_{k}" for k in keys]
    if predicate in exact:
        return left.join(other, cond & exact[predicate]).drop(*drop)
    if predicate not in ("overlaps", "contains"):
        raise ValueError(f"{predicate} is not joinable at scale")
    width = micros(cell)
    lefts, rights = left.where(F.col(a) < F.col(b)), other.where(F.col(c) < F.col(d))
    longest = 0
    for df, start, end in ((lefts, a, b), (rights, c, d)):
        first, last = _cells(start, end, width)
        longest = max(longest, df.agg(F.max(last - first + 1)).first()[0] or 0)
    levels, holds = int(longest).bit_length(), period_predicate(predicate, a, b, c, d)
    columns = [*left.columns, *[x for x in other.columns if x not in drop]]
    out = _starts_within(rights, c, lefts, a, b, cond, width, levels).where(holds & (F.col(a) <= F.col(c))).select(*columns)
    if predicate == "overlaps":
        more = _starts_within(lefts, a, rights, c, d, cond, width, levels).where(holds & (F.col(c) < F.col(a))).select(*columns)
        out = out.unionByName(more)
    return out
