"""Ordered computations per key that stay parallel when one key holds most of the rows.

A plain window puts all rows of a key into one task. Here groups larger than ``rows_per_group`` are laid out by a range
exchange over their keys and full order; a partition of it is a slice. Every computation then runs in two levels:

1. inside (key, slice), with an ordinary window;
2. over one summary row per (key, slice), which yields what each slice inherits from the others.

Spark samples the borders of a range exchange itself, in a bounded sample, so neither cuts nor a search per row are
needed. The full order is the order column, the columns that break its ties, and a random number for what those leave
equal: outliers, bursts, equal values and NULLs cannot fill one slice. Groups that are not large stay whole. The rows
are written once with their slice, so every use of a split sees the same rows in the same slices, also after a lost
executor. Tables without hot groups get the plain window plan; both plans give the same values, NULLs and types.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .sizes import broadcast_if_small
from .skew import ROWS_PER_GROUP, meets
from .staging import staged

SLICE = "__slice"
#: sampled rows per rows_per_group when groups are measured, and slices per rows_per_group
SAMPLED, FINE = 32, 2
#: summary rows that may be broadcast: one per slice of a hot group
BROADCAST_SLICES = 500_000
#: rows of a block in which a RANGE frame is computed directly
FRAME_BLOCK = 256
IN_PARTITION = (1 << 33) - 1


@dataclass(frozen=True)
class Order:
    """Sort order of a group: one slicing column and columns that break its ties."""
    column: str
    ties: tuple[str, ...] = ()
    descending: bool = False

    def columns(self) -> list[Column]:
        turn = (lambda c: F.col(c).desc()) if self.descending else (lambda c: F.col(c).asc())
        return [turn(self.column), *[F.col(c).asc() for c in self.ties]]

    def position(self, df: DataFrame) -> Column:
        """A number that never decreases along the order."""
        kind = df.schema[self.column].dataType
        col = F.col(self.column)
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            number = F.unix_micros(col.cast("timestamp")).cast("double")
        elif isinstance(kind, T.DateType):
            number = F.unix_date(col).cast("double")
        elif isinstance(kind, T.NumericType):
            number = col.cast("double")
        else:
            raise TypeError(f"cannot slice along {self.column} of type {kind.simpleString()}")
        return -number if self.descending else number

    def main(self, df: DataFrame) -> Column:
        """The order column as an exact value that sorts ascending, NULLs first (last when descending)."""
        col, kind = F.col(self.column), df.schema[self.column].dataType
        if not self.descending:
            return F.struct(F.lit(False).alias("f"), col.alias("v"))
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            col = -F.unix_micros(col.cast("timestamp"))
        elif isinstance(kind, T.DateType):
            col = -F.unix_date(col)
        elif isinstance(kind, T.NumericType):
            col = -col
        else:
            raise TypeError(f"cannot sort {self.column} of type {kind.simpleString()} backwards in slices")
        return F.struct(F.col(self.column).isNull().alias("f"), col.alias("v"))


@dataclass(frozen=True)
class Running:
    """One running value. kind: count, sum, min, max, last (last non-null), rank, dense_rank, upto (rows up to
    the last peer), total_count, total_sum (the last two over the whole group)."""
    name: str
    kind: str
    expr: Column | None = None
    exclusive: bool = False


@dataclass(frozen=True)
class Split:
    """Rows with their slice; ``slices`` is 0 when no group is hot and no slice column exists. A split can
    serve any number of calls on the same frame."""
    df: DataFrame
    keys: tuple[str, ...]
    order: Order
    slices: int

    @property
    def sliced(self) -> bool:
        return self.slices > 0

    def group(self) -> list[str]:
        return [*self.keys, SLICE] if self.sliced else list(self.keys)

    def window(self, ties: bool = True):
        parts = self.group()
        base = Window.partitionBy(*parts) if parts else Window.partitionBy(F.lit(0))
        return base.orderBy(*self.order.columns()[:None if ties else 1])


def _hot_groups(measured: DataFrame, keys: list[str], rows_per_group: int) -> DataFrame | None:
    """The keys of groups above ``rows_per_group`` rows, as a sample tells, named ``__hot_key``; None where no group is.
    Without keys the whole table is one group. There are at most as many as the table has multiples of the limit."""
    rate = min(1.0, SAMPLED / rows_per_group)
    if not keys:
        return measured.sparkSession.range(1).select()
    sample = measured.select(*keys).where(F.rand(23) < rate) if rate < 1 else measured.select(*keys)
    hot = staged(sample.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > rate * rows_per_group)
                 .select(*[F.col(k).alias(f"__hot_{k}") for k in keys]), "hot-groups")
    return None if hot.isEmpty() else hot


def _marked(df: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    """``df`` with ``__is_hot``."""
    if not keys:
        return df.withColumn("__is_hot", F.lit(True))
    named = broadcast_if_small(hot.withColumn("__is_hot", F.lit(True)), 8 << 20)
    return (df.join(named, meets(keys, "__hot_"), "left").drop(*[f"__hot_{k}" for k in keys])
            .withColumn("__is_hot", F.coalesce("__is_hot", F.lit(False))))


def slice_count(df: DataFrame, rows: int, rows_per_group: int) -> int:
    """Slices for so many rows. A limit below the default one cuts finer only as far as that gives tasks to cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    wanted = -(-FINE * rows // rows_per_group)
    return max(2, min(wanted, max(4 * cores, -(-FINE * rows // ROWS_PER_GROUP))))


def _with_places(laid: DataFrame, name: str) -> DataFrame:
    """Number the rows of a layout along its order, from 0: the place in the partition and one offset per partition."""
    total, offsets = 0, []
    # as many rows as there are slices
    for row in sorted(laid.groupBy(SLICE).agg(F.count(F.lit(1)).alias("n")).collect()):
        offsets.append((row[SLICE], total))
        total += row["n"]
    before = laid.sparkSession.createDataFrame(offsets, "__of long, __before long")
    return (laid.join(F.broadcast(before), F.col(SLICE) == F.col("__of"))
            .withColumn(name, F.col("__before") + F.col("__in_slice").bitwiseAND(IN_PARTITION)).drop("__of", "__before"))


def with_row_numbers(df: DataFrame, by: list[str], name: str, rows_per_slice: int = ROWS_PER_GROUP) -> DataFrame:
    """Rows numbered from 0 along ``by`` over the whole table, without a window."""
    many = slice_count(df, df.count(), rows_per_slice)
    laid = staged(df.repartitionByRange(many, *by).sortWithinPartitions(*by).withColumn(SLICE, F.spark_partition_id().cast("long"))
                  .withColumn("__in_slice", F.monotonically_increasing_id()), "laid-out")
    return _with_places(laid, name).drop(SLICE, "__in_slice")


def split(df: DataFrame, keys: list[str], order: Order, rows_per_group: int = ROWS_PER_GROUP,
          sizes_from: DataFrame | None = None) -> Split:
    """Measure the groups and slice the hot ones. A table no larger than one group needs one count
    (answered from file footers where possible) and nothing else.

    ``sizes_from`` is a cheaper frame with the key columns of about the same rows, such as the table ``df`` was
    joined from. It only decides what is sliced; any slicing gives the same result.
    """
    keys = list(keys)
    measured = df if sizes_from is None else sizes_from
    rows = measured.count()
    hot = _hot_groups(measured, keys, rows_per_group) if rows > rows_per_group else None
    if hot is None:
        return Split(df, tuple(keys), order, 0)
    many = slice_count(df, rows, rows_per_group)
    is_hot = F.col("__is_hot")
    turned = (lambda c: c.desc()) if order.descending else (lambda c: c.asc())
    along = [F.when(is_hot, F.col(k)).asc() for k in keys]
    # groups that are not hot have one place, so none of them is parted
    along += [F.when(~is_hot, F.xxhash64(*keys)).asc()] if keys else []
    along += [turned(F.when(is_hot, F.col(order.column))), *[F.when(is_hot, F.col(c)).asc() for c in order.ties if c in df.columns]]
    spread = _marked(df, keys, hot).withColumn("__r", F.when(is_hot, F.rand(11)))
    by = [is_hot.asc(), *along, F.col("__r").asc()]
    cut = (spread.repartitionByRange(many, *by).sortWithinPartitions(*by).drop("__r")
           .withColumn(SLICE, F.spark_partition_id().cast("long")).withColumn("__in_slice", F.monotonically_increasing_id()))
    return Split(staged(cut, "slices"), tuple(keys), order, many)


def _local(spec: Running, parts: Split) -> Column:
    if spec.kind == "rank":
        return F.rank().over(parts.window(ties=False))
    if spec.kind == "dense_rank":
        return F.dense_rank().over(parts.window(ties=False))
    if spec.kind == "upto":
        return F.count(F.lit(1)).over(parts.window(ties=False).rangeBetween(Window.unboundedPreceding, 0))
    if spec.kind.startswith("total_"):
        cols = parts.group()
        whole = Window.partitionBy(*cols) if cols else Window.partitionBy(F.lit(0))
        agg = F.count(F.lit(1)) if spec.kind == "total_count" else F.sum(spec.expr)
        return agg.over(whole)
    frame = parts.window().rowsBetween(Window.unboundedPreceding, -1 if spec.exclusive else 0)
    if spec.kind == "count":
        return F.count(F.lit(1) if spec.expr is None else spec.expr).over(frame)
    if spec.kind == "last":
        return F.last(spec.expr, ignorenulls=True).over(frame)
    return {"sum": F.sum, "min": F.min, "max": F.max}[spec.kind](spec.expr).over(frame)


PEERS = ("rank", "dense_rank", "upto")


def _summary(spec: Running, order: Order) -> Column:
    if spec.kind in ("count", "total_count"):
        return F.count(F.lit(1) if spec.expr is None else spec.expr)
    if spec.kind in ("sum", "total_sum"):
        return F.sum(spec.expr)
    if spec.kind in ("min", "max"):
        return {"min": F.min, "max": F.max}[spec.kind](spec.expr)
    at = F.struct(order.column, *order.ties)
    chooser = F.min_by if order.descending else F.max_by
    if order.descending and order.ties:
        raise ValueError("last with a descending order takes no tie columns")
    return chooser(F.struct(spec.expr.alias("v")), F.when(spec.expr.isNotNull(), at))


def _inherited(spec: Running, across, before) -> Column:
    got = F.col(f"__s_{spec.name}")
    if spec.kind.startswith("total_"):
        return F.sum(got).over(across)
    if spec.kind == "last":
        return F.last(got, ignorenulls=True).over(before)["v"]
    if spec.kind in ("min", "max"):
        return {"min": F.min, "max": F.max}[spec.kind](got).over(before)
    return F.sum(got).over(before)


def _peers(summary: DataFrame, across, before) -> DataFrame:
    """What slices pass on about equal order values, which may reach over several of them: the rank of a slice's
    first value, the distinct values before it, and the rows up to the last peer of its last value."""
    along = across.orderBy(SLICE)
    after = along.rowsBetween(1, Window.unboundedFollowing)
    return (summary
            .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
            .withColumn("__joined", F.coalesce(F.lag("__hi").over(along) == F.col("__lo"), F.lit(False)))
            .withColumn("__goes_on", F.coalesce(F.lead("__lo").over(along) == F.col("__hi"), F.lit(False)))
            .withColumn("__single", F.col("__lo") == F.col("__hi"))
            # where the run of the slice's last value began, unless it began in an earlier slice
            .withColumn("__began", F.when(~(F.col("__single") & F.col("__joined")), F.col("__before") + F.col("__n") - F.col("__n_hi") + 1))
            .withColumn("__head", F.when(F.col("__joined"), F.last("__began", True).over(before)).otherwise(F.col("__before") + 1))
            .withColumn("__fewer", F.coalesce(F.sum("__d").over(before), F.lit(0)) - F.sum(F.col("__joined").cast("long")).over(along))
            # where a run that enters from the left ends, unless it leaves on the right
            .withColumn("__ends", F.when(~(F.col("__single") & F.col("__goes_on")), F.col("__before") + F.col("__n_lo")))
            .withColumn("__tail", F.when(F.col("__goes_on"), F.first("__ends", True).over(after)).otherwise(F.col("__before") + F.col("__n"))))


def running(df: DataFrame, keys: list[str], order: Order, specs: list[Running], rows_per_group: int = ROWS_PER_GROUP,
            parts: Split | None = None, sizes_from: DataFrame | None = None) -> DataFrame:
    """Add running values per key in the given order. ``expr`` columns refer to ``df`` by name.
    ``parts`` reuses a split of the same frame; ``sizes_from`` as in ``split``. Types are those of the plain
    window functions, whichever plan runs."""
    parts = parts or split(df, keys, order, rows_per_group, sizes_from=sizes_from)
    plain = df.select(*[_local(s, Split(df, tuple(keys), order, 0)).alias(s.name) for s in specs]).schema
    if not parts.sliced:
        return df.select("*", *[_local(s, parts).alias(s.name) for s in specs])
    keys = list(parts.keys)
    peers = any(s.kind in PEERS for s in specs)
    local = {f"__l_{s.name}": _local(s, parts) for s in specs}
    if peers:
        local |= {f"__q_{kind}": _local(Running("", kind), parts) for kind in PEERS}
        local["__main"] = order.main(parts.df)
    detail = parts.df.select("*", *[c.alias(n) for n, c in local.items()])
    sums = [_summary(s, order).alias(f"__s_{s.name}") for s in specs if s.kind not in PEERS]
    across = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = across.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    if peers:
        # the windows already know the first and the last run of equal values of a slice
        n = F.count(F.lit(1))
        summary = detail.where("__is_hot").groupBy(*parts.group()).agg(
            n.alias("__n"), F.max("__q_dense_rank").alias("__d"), F.min("__main").alias("__lo"), F.max("__main").alias("__hi"),
            F.min("__q_upto").alias("__n_lo"), (n - F.max("__q_rank") + 1).alias("__n_hi"), *sums)
        summary = _peers(summary, across, before)
    else:
        summary = parts.df.where("__is_hot").groupBy(*parts.group()).agg(*sums)
    carried = summary.select(*[F.col(k).alias(f"__k_{k}") for k in parts.group()],
                             *[_inherited(s, across, before).alias(f"__p_{s.name}") for s in specs if s.kind not in PEERS],
                             *(["__lo", "__hi", "__before", "__head", "__fewer", "__tail"] if peers else []))
    # a row per slice of a hot group, and the split has counted those
    joined = detail.join(F.broadcast(carried) if parts.slices <= BROADCAST_SLICES else carried, meets(parts.group(), "__k_"), "left")
    out = [F.col(c) for c in df.columns]
    for s in specs:
        local, past = F.col(f"__l_{s.name}"), F.col(f"__p_{s.name}")
        if s.kind == "rank":
            col = F.when(F.col("__main") == F.col("__lo"), F.col("__head")).otherwise(local + F.coalesce("__before", F.lit(0)))
        elif s.kind == "dense_rank":
            col = local + F.coalesce("__fewer", F.lit(0))
        elif s.kind == "upto":
            col = F.when(F.col("__main") == F.col("__hi"), F.col("__tail")).otherwise(local + F.coalesce("__before", F.lit(0)))
        elif s.kind.startswith("total_"):
            col = F.coalesce(past, local)
        elif s.kind == "last":
            col = F.coalesce(local, past)
        elif s.kind == "min":
            col = F.least(local, past)
        elif s.kind == "max":
            col = F.greatest(local, past)
        elif s.kind == "sum":
            col = F.when(local.isNull() & past.isNull(), F.lit(None)).otherwise(
                F.coalesce(local, F.lit(0)) + F.coalesce(past, F.lit(0)))
        else:
            col = local + F.coalesce(past, F.lit(0))
        kind = plain[s.name].dataType
        # sums and ranks widen; values that are carried as they are keep their type anyway
        out.append((col if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) else col.cast(kind)).alias(s.name))
    return joined.select(*out)


def _blocks(df: DataFrame, keys: list[str], order: Order, back: int, ahead: int, rows_per_group: int,
            sizes_from: DataFrame | None) -> tuple[DataFrame, list[str]] | None:
    """Rows of hot groups laid out in blocks of equally many rows, by their places in the layout. Rows within ``back``
    before or ``ahead`` after another block are lent to it as well, so a window inside a block sees every row it needs."""
    parts = split(df, keys, order, rows_per_group, sizes_from=sizes_from)
    if not parts.sliced:
        return None
    size = max(rows_per_group, back, ahead, 1)
    placed = _with_places(parts.df, "__rn")
    home = F.when(F.col("__is_hot"), F.floor(F.col("__rn") / size)).otherwise(-1)
    first, last = F.floor((F.col("__rn") - ahead) / size), F.floor((F.col("__rn") + back) / size)
    lent = (placed.withColumn("__home", home)
            .withColumn("__block", F.explode(F.when(F.col("__is_hot"), F.sequence(F.greatest(first, F.lit(0)), last)).otherwise(F.array("__home")))))
    return lent, [*keys, "__block"]


def shifted(df: DataFrame, keys: list[str], order: Order, values: dict[str, tuple[str, int]],
            rows_per_group: int = ROWS_PER_GROUP, sizes_from: DataFrame | None = None) -> DataFrame:
    """Values of the row ``offset`` places later (negative: earlier): LEAD and LAG.

    ``values`` maps a new column to (existing column, offset). Groups without a hot key use the built-in
    window functions as they are; otherwise they run in blocks with their neighbours' border rows."""
    shift = lambda w: [(F.lead(src, off) if off >= 0 else F.lag(src, -off)).over(w).alias(name) for name, (src, off) in values.items()]
    offsets = [off for _, off in values.values()]
    blocks = _blocks(df, keys, order, max(0, *[-o for o in offsets], 0), max(0, *offsets, 0), rows_per_group, sizes_from)
    if blocks is None:
        return df.select("*", *shift(Split(df, tuple(keys), order, 0).window()))
    lent, parts = blocks
    w = Window.partitionBy(*parts).orderBy(*order.columns(), "__rn")
    return lent.select("*", *shift(w)).where("__block = __home").select(*df.columns, *values)


def trailing_sums(df: DataFrame, keys: list[str], order: Order, sums: dict[str, Column], rows: int,
                  rows_per_group: int = ROWS_PER_GROUP, sizes_from: DataFrame | None = None) -> DataFrame:
    """Sums over the current row and the ``rows`` rows before it, and ``__frame_rows``, the number
    of rows in that frame. Hot groups run in blocks that are lent the ``rows`` rows before them."""
    framed = lambda w: [*[F.sum(e).over(w).alias(n) for n, e in sums.items()], F.count(F.lit(1)).over(w).alias("__frame_rows")]
    blocks = _blocks(df, keys, order, rows, 0, rows_per_group, sizes_from)
    if blocks is None:
        return df.select("*", *framed(Split(df, tuple(keys), order, 0).window().rowsBetween(-rows, 0)))
    lent, parts = blocks
    w = Window.partitionBy(*parts).orderBy(*order.columns(), "__rn").rowsBetween(-rows, 0)
    return lent.select("*", *framed(w)).where("__block = __home").select(*df.columns, *sums, "__frame_rows")


#: what a RANGE frame can compute, as the parts that are kept of it
FRAME_PARTS = {"count": ("count",), "sum": ("sum",), "min": ("min",), "max": ("max",), "avg": ("sum", "count")}


def _whole(kind: str, expr: Column | None) -> Column:
    if kind == "count":
        return F.count(F.lit(1) if expr is None else expr)
    return {"sum": F.sum, "min": F.min, "max": F.max, "avg": F.avg}[kind](expr)


def _joined(kind: str, *parts: Column) -> Column:
    """Partial results of parts of a frame, NULL where a part has none, as one."""
    if kind in ("min", "max"):
        return (F.least if kind == "min" else F.greatest)(*parts)
    total = reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0)) for p in parts])
    return total if kind == "count" else F.when(F.coalesce(*parts).isNotNull(), total)


def trailing_range(df: DataFrame, keys: list[str], order: Order, aggs: dict[str, tuple[str, Column | None]], span: float,
                   rows_per_group: int = ROWS_PER_GROUP, block: int = FRAME_BLOCK) -> DataFrame:
    """Aggregates over the rows at most ``span`` (microseconds for times) before the current row and up to its peers: a RANGE
    frame. ``aggs`` maps a name to (kind, expression); kinds are count, sum, min, max and avg.

    In hot groups a row is laid out three times, whatever the span: as itself, as a mark where its frame begins and as
    a mark where it ends. The layout is cut into blocks of ``block`` places. A frame within one block is computed there;
    any other is the rest of the block it begins in, the beginning of the block it ends in, and whole blocks between,
    which a tree of pairwise sums over the blocks supplies from a handful of its nodes. Parts are only ever added or
    compared, never subtracted, so floating values lose nothing. Equal order values may fill any number of blocks."""
    position = order.position(df)
    framed = lambda w: [_whole(kind, e).over(w).alias(n) for n, (kind, e) in aggs.items()]
    base = lambda *parts: Window.partitionBy(*parts) if parts else Window.partitionBy(F.lit(0))
    plain = df.select("*", *framed(base(*keys).orderBy(position).rangeBetween(-span, 0)))
    rows = df.count()
    hot = _hot_groups(df, keys, rows_per_group) if rows > rows_per_group else None
    if hot is None:
        return plain
    marked = staged(_marked(df, keys, hot).withColumn("__id", F.monotonically_increasing_id()), "framed")
    cold = marked.where(~F.col("__is_hot")).select(*df.columns)
    cold = cold.select("*", *framed(base(*keys).orderBy(position).rangeBetween(-span, 0)))

    large = marked.where("__is_hot").withColumn("__pos", position)
    parts = {f"__{n}_{p}": (p, e) for n, (kind, e) in aggs.items() for p in FRAME_PARTS[kind]}
    values = [(F.lit(1) if e is None else F.when(e.isNotNull(), 1) if p == "count" else e).alias(n) for n, (p, e) in parts.items()]
    nothing = [F.lit(None).alias(n) for n in parts]
    row = F.struct(*[F.col(c) for c in df.columns])
    rows_, begins, ends = (large.select(*keys, place.alias("__pos"), F.lit(side).alias("__side"), number.alias("__id"), payload.alias("__row"), *held)
                           for side, place, number, payload, held in (
        (1, F.col("__pos"), F.lit(None).cast("long"), F.lit(None), values),
        (0, F.col("__pos") - span, F.col("__id"), F.lit(None), nothing),
        (2, F.col("__pos"), F.col("__id"), row, nothing)))
    line = rows_.unionByName(begins).unionByName(ends).withColumn("__r", F.rand(11))
    by = [*keys, "__pos", "__side", "__r"]
    laid = staged(line.repartitionByRange(slice_count(df, 3 * rows, rows_per_group), *by).sortWithinPartitions(*by).drop("__r")
                  .withColumn(SLICE, F.spark_partition_id().cast("long")).withColumn("__in_slice", F.monotonically_increasing_id()), "frames")
    placed = _with_places(laid, "__g").withColumn("__block", F.floor(F.col("__g") / block))
    merge = lambda n: {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}[parts[n][0]](n)
    in_block = base(*keys, "__block")
    to_end = in_block.orderBy(F.col("__pos").desc(), F.col("__side").desc()).rowsBetween(Window.unboundedPreceding, 0)
    # at the mark of an end: the whole frame if it lies in this block, else all of the block before the mark
    here = in_block.orderBy("__pos").rangeBetween(-span, 0)
    first = placed.select(*keys, "__pos", "__side", "__id", "__block", *[merge(n).over(to_end).alias(n) for n in parts]).where("__side = 0")
    last = placed.select(*keys, "__pos", "__side", "__id", "__row", "__block", *[merge(n).over(here).alias(n) for n in parts]).where("__side = 2")
    frames = last.select(*keys, "__id", "__row", F.col("__block").alias("__to"), *[F.col(n).alias(f"{n}_last") for n in parts]).join(
        first.select("__id", F.col("__block").alias("__from"), *[F.col(n).alias(f"{n}_first") for n in parts]), "__id")

    # whole blocks: sums of 2, 4, 8 ... neighbouring ones, and of those the few nodes that make up a stretch
    blocks = placed.where("__side = 1").groupBy(*keys, "__block").agg(*[merge(n).alias(n) for n in parts])
    top = max(1, (-(-3 * rows // block)).bit_length())
    level = F.explode(F.sequence(F.lit(0), F.lit(top))).alias("__level")
    nodes = (blocks.select("*", level).groupBy(*keys, "__level", F.expr("shiftright(__block, __level)").alias("__node"))
             .agg(*[merge(n).alias(n) for n in parts]))
    spans = frames.where("__to - __from > 1").select(*keys, "__from", "__to").distinct()
    low, high = F.expr("shiftright(__from + shiftleft(1L, __level), __level)"), F.expr("shiftright(__to, __level)")
    wanted = (spans.select("*", level).withColumn("__low", low).withColumn("__high", high).where("__low < __high")
              .select(*[F.col(k).alias(f"__s_{k}") for k in keys], "__from", "__to", F.col("__level").alias("__at_level"), F.explode(F.array_compact(F.array(
                  F.when(F.col("__low") % 2 == 1, F.col("__low")), F.when(F.col("__high") % 2 == 1, F.col("__high") - 1)))).alias("__wanted")))
    same = (F.col("__level") == F.col("__at_level")) & (F.col("__node") == F.col("__wanted"))
    between = (wanted.join(nodes, meets(keys, "__s_", same) if keys else same)
               .groupBy(*[f"__s_{k}" for k in keys], F.col("__from").alias("__s_from"), F.col("__to").alias("__s_to")).agg(*[merge(n).alias(n) for n in parts]))
    same = (F.col("__from") == F.col("__s_from")) & (F.col("__to") == F.col("__s_to"))
    whole = frames.join(between, meets(keys, "__s_", same) if keys else same, "left")

    def result(name: str, kind: str) -> Column:
        got = {p: F.when(F.col("__from") == F.col("__to"), _joined(p, *[F.col(f"__{name}_{p}_last")] * (2 if p in ("min", "max") else 1))).otherwise(
            _joined(p, F.col(f"__{name}_{p}_first"), F.col(f"__{name}_{p}"), F.col(f"__{name}_{p}_last"))) for p in FRAME_PARTS[kind]}
        return F.try_divide(got["sum"], got["count"]) if kind == "avg" else got[kind]

    out = whole.select("__row.*", *[result(n, kind).cast(plain.schema[n].dataType).alias(n) for n, (kind, _) in aggs.items()])
    return cold.unionByName(out)
