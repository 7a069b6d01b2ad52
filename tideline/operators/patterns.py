"""Row pattern matching: sequences of rows per key described by a regular expression over symbols.

Two cuts make the work parallel inside a key. Rows that meet no symbol's condition end every match, so
they split the key into parts. And every match must fit into ``within``: time is cut into cells, each
cell also sees the following ``within`` of rows, and a start row is tried in its own cell only.

Matches are first found as places only: where they start, end and let matching resume. Inside a cell only starts are
tried that some match before them can lead to. Of matches that overlap, those that stay are found by linking each to the
first start after it and doubling the links. Row ids, classifiers and measures are computed for these alone.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..plans.durations import at, micros
from ..plans.sizes import broadcast_if_small
from ..plans.skew import ROWS_PER_GROUP, hot_keys, meets
from ..plans.slices import Order, Running, running, shifted, with_row_numbers
from ..plans.staging import staged

#: a row's conditions are the bits of one long, of as many hexadecimal digits where there are more
LONG_BITS = 62
FIRST = 0x10000
#: rows taken by a symbol between {- and -}
LEFT_OUT = "__left_out"


@dataclass(frozen=True)
class Measure:
    """first, last, sum, min, max or count of a numeric column over the rows matched as ``symbol``
    (None: over all rows of the match)."""
    kind: str
    column: str | None = None
    symbol: str | None = None


def _spelled_out(pattern: str) -> str:
    """PERMUTE (x, y) as the orders of its items."""
    def orders(m: re.Match) -> str:
        items = [x.strip() for x in m.group(1).split(",")]
        return "(" + " | ".join("(" + " ".join(o) + ")" for o in itertools.permutations(items)) + ")"
    return re.sub(r"\bPERMUTE\s*\(([^()]*)\)", orders, pattern)


def _compile(pattern: str, symbols: list[str], sets: tuple[int, ...] = ()):
    """A row is one character that stands for the set of conditions it meets, so a row
    may meet several. A symbol becomes the class of all of ``sets`` that hold it; the two bits after the
    symbols' say whether the row is the first or the last of its key."""
    import regex
    members = lambda bit: "[" + ("".join(chr(FIRST + i) for i, s in enumerate(sets) if s >> bit & 1) or chr(FIRST - 1)) + "]"
    classes = {name: members(bit) for bit, name in enumerate(symbols)}
    out, left_out = [], False
    for token in re.findall(r"\{-|-\}|[A-Za-z_]\w*|\{[\d,\s]*\}|\S", _spelled_out(pattern)):
        if token[0].isalpha() or token[0] == "_":
            if token not in classes:
                raise ValueError(f"{token} has no definition")
            out.append(f"(?P<{token}{LEFT_OUT if left_out else ''}>{classes[token]})")
        elif token in ("{-", "-}"):
            if left_out == (token == "{-"):
                raise ValueError("{- and -} must alternate")
            left_out = not left_out
            out.append("(?:" if left_out else ")")
        elif token == "^":
            out.append(f"(?={members(len(symbols))})")
        elif token == "$":
            out.append(f"(?<={members(len(symbols) + 1)})")
        elif token in "()|*+?" or token[0] == "{":
            out.append("(?:" if token == "(" else token)
        else:
            raise ValueError(f"{token} is not supported in a pattern")
    if left_out:
        raise ValueError("{- without -}")
    return regex.compile("".join(out), flags=regex.V1)


PLACES = ["__start", "__start_id", "__end", "__end_id", "__resume", "__resume_id"]


def _finder(pattern: str, symbols: list[str], keys: list[str], measures: dict[str, Measure], within: int,
            resume_symbol: str | None, resume_last: bool, chosen: bool, subsets: dict[str, list[str]]):
    """Matcher over Arrow batches sorted by (keys, part, cell, time): whole groups are matched together, the
    last, perhaps unfinished group of a batch waits for the next one. With ``chosen`` the starts marked so are matched
    and described; otherwise places are found, and only of starts that can be reached."""
    names = [*PLACES, *(["n_rows", "row_ids", "classifiers", *measures] if chosen else [])]
    kinds = [pa.int64()] * len(PLACES) + ([pa.int32(), pa.list_(pa.int64()), pa.list_(pa.string()), *[pa.float64()] * len(measures)] if chosen else [])
    programs: dict[tuple, object] = {}

    def group_numbers(rows: pa.Table) -> np.ndarray:
        """Keys stay Arrow values: a NULL among them makes no other key inexact and equals itself."""
        change = np.zeros(rows.num_rows, dtype=bool)
        for name in [*keys, "__part", "__cell"]:
            codes = rows.column(name).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
            change[1:] |= codes[1:] != codes[:-1]
        return np.cumsum(change)

    def match(rows: pa.Table, groups: np.ndarray) -> pa.RecordBatch:
        column = lambda name: rows.column(name).to_numpy()
        at_us, ids = column("__at"), column("__id")
        first = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
        passed = at_us - at_us[first][groups - groups[0]]
        # one rising time line for all groups, far enough apart that no frame reaches the next group
        apart, number = int(passed.max()) + within + 1, groups - groups[0]
        if apart * (int(number[-1]) + 2) < 2**63:
            line = passed + number * apart
            ends = np.searchsorted(line, line + within, side="right")
        else:
            stops = np.r_[first[1:], rows.num_rows]
            ends = np.concatenate([lo + np.searchsorted(passed[lo:hi], passed[lo:hi] + within, side="right")
                                   for lo, hi in zip(first, stops)])
        sets, codes = np.unique(column("__set"), return_inverse=True)
        text = "".join(map(chr, (codes + FIRST).tolist()))
        known = tuple(int(s, 16) if isinstance(s, str) else s for s in sets.tolist())
        if known not in programs:
            programs[known] = _compile(pattern, symbols, known)
        compiled = programs[known]
        values = {m.column: column(f"__m_{m.column}") for m in measures.values() if m.column} if chosen else {}
        out, starts = [], []
        own = column("__own")

        def tried(i: int) -> int | None:
            """Match at row i; the row at which matching resumes, or None."""
            m = compiled.match(text, i, int(ends[i]))
            if not m or m.end() == i:
                return None
            last, resume = m.end() - 1, None
            spots = None
            if resume_symbol or chosen:
                taken = {g: [p for p, _ in m.spans(g)] for g in compiled.groupindex}
                spots = {s: sorted(taken.get(s, []) + taken.get(s + LEFT_OUT, [])) for s in symbols}
                spots |= {name: sorted(p for s in some for p in spots[s]) for name, some in subsets.items()}
            if resume_symbol and spots.get(resume_symbol):
                resume = spots[resume_symbol][-1 if resume_last else 0]
            row = [at_us[i], ids[i], at_us[last], ids[last], None if resume is None else at_us[resume], None if resume is None else ids[resume]]
            if chosen:
                label = {p: s for s in symbols for p in taken.get(s, [])}
                shown = sorted(label)
                row += [m.end() - i, ids[shown], [label[p] for p in shown]]
                for spec in measures.values():
                    picked = spots.get(spec.symbol, []) if spec.symbol else list(range(i, m.end()))
                    row.append(_measure(spec, values, picked))
            starts.append(i)
            out.append(row)
            return resume if resume is not None and resume > i else m.end()

        if chosen:
            for i in np.flatnonzero(own & column("__chosen")).tolist():
                tried(i)
        else:
            # a match of an earlier cell can end, and so lead on, up to one row beyond ``within`` of this cell; where the part begins
            # in this cell there is none, and its first row alone leads to all others
            entry = own & (column("__inherits") & (at_us <= column("__cell_lo") + within))
            beyond = own & ~entry
            follows = np.r_[True, entry[:-1] | ~own[:-1] | (groups[1:] != groups[:-1])]
            entry |= beyond & follows
            stops = np.append(first[1:], rows.num_rows)[groups - groups[0]]
            seen = np.zeros(rows.num_rows, bool)
            for i in np.flatnonzero(entry).tolist():
                stop = stops[i]
                while i < stop and own[i] and not seen[i]:
                    seen[i] = True
                    led = tried(i)
                    i = i + 1 if led is None else led
        held = rows.select(keys).take(pa.array(starts, pa.int64())).combine_chunks()
        columns = list(zip(*out)) if out else [()] * len(names)
        return pa.RecordBatch.from_arrays(
            [*[c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in held.columns],
             *[pa.array(list(c), kind) for c, kind in zip(columns, kinds)]], names=[*keys, *names])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            batch = pa.Table.from_batches([batch])
            if waiting:
                edge = pa.concat_tables([waiting[-1].slice(waiting[-1].num_rows - 1), batch])
                if group_numbers(edge)[-1] == 0:
                    waiting.append(batch)
                    continue
            rows = pa.concat_tables([*waiting, batch])
            groups = group_numbers(rows)
            cut = int(np.searchsorted(groups, groups[-1]))
            if cut:
                yield match(rows.slice(0, cut), groups[:cut])
            waiting = [rows.slice(cut)]
        if waiting:
            rows = pa.concat_tables(waiting)
            yield match(rows, group_numbers(rows))
    return find


def _measure(spec: Measure, columns: dict[str, np.ndarray], picked: list[int]):
    if spec.kind == "count":
        return float(len(picked))
    if not picked:
        return None
    values = columns[spec.column][picked]
    return float({"first": lambda v: v[0], "last": lambda v: v[-1], "sum": np.sum, "min": np.min, "max": np.max}[spec.kind](values))


def match_rows(df: DataFrame, keys: list[str], time: str, row_id: str, pattern: str, define: dict[str, Column],
               within: str, measures: dict[str, Measure] | None = None, skip: str = "past last row",
               neighbours: dict[str, tuple[str, int]] | None = None, cell: str | None = None, subsets: dict[str, list[str]] | None = None,
               rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """One row per match: keys, match_number, start/end ids, n_rows, row_ids, classifiers, measures.

    pattern: symbols with ( ) | * + ? {n,m} and their reluctant forms, PERMUTE (x, y), the anchors ^ and $ for the first
    and last row of a key, and {- x -} for rows that belong to the match but are left out of row_ids and classifiers.
    define: condition per symbol over the row's columns and ``neighbours``, which names values of other rows by offset
    (PREV = -1, NEXT = 1). A symbol without a condition is F.lit(True). subsets: names for several symbols, for measures and
    for skip. skip: "past last row", "to next row", "to first X" or "to last X". Conditions over aggregates of the match
    are not offered.
    """
    measures, subsets = measures or {}, subsets or {}
    symbols = list(define)
    _compile(pattern, symbols)
    unknown = [x for x in [s for some in subsets.values() for s in some] + [m.symbol for m in measures.values() if m.symbol and m.symbol not in subsets] if x not in define]
    if unknown:
        raise ValueError(f"{unknown[0]} has no definition")
    words = skip.split()
    aim = len(words) == 3 and words[1] in ("first", "last") and (words[2] in define or words[2] in subsets)
    if skip not in ("past last row", "to next row") and not aim:
        raise ValueError(f"cannot skip {skip}")
    target = words[2] if aim else None
    order = Order(time, (row_id,))
    rows = shifted(df, keys, order, neighbours, rows_per_group) if neighbours else df
    anchored = bool(set("^$") & set(pattern))
    long_of = lambda conditions: sum((F.when(c, F.lit(1 << i).cast("long")).otherwise(0) for i, c in enumerate(conditions)), F.lit(0).cast("long"))
    ends_of_key = [F.col("__nth") == 1, F.col("__nth") == F.col("__all")] if anchored else []

    def set_of(conditions: list[Column]) -> Column:
        if len(conditions) <= LONG_BITS:
            return long_of(conditions)
        # most significant digits first
        return F.concat(*[F.lpad(F.lower(F.hex(long_of(conditions[at:at + 32]))), 8, "0") for at in range(0, len(conditions), 32)][::-1])

    needed = list(dict.fromkeys(m.column for m in measures.values() if m.column))
    within_us = micros(within)
    width = max(micros(cell) if cell else within_us, within_us, 1)
    hit = F.coalesce(reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in define.values()]), F.lit(False))
    placed = rows.select(*keys, at(time).alias("__at"), F.col(row_id).cast("long").alias("__id"), hit.alias("__hit"),
                         F.array(*[F.coalesce(c, F.lit(False)) for c in define.values()]).alias("__met") if anchored else set_of(list(define.values())).alias("__set"),
                         *[F.col(c).cast("double").alias(f"__m_{c}") for c in needed])
    # a row no symbol takes ends every match before it: such rows cut their key into parts and go
    breaks = F.when(F.col("__hit"), 0).otherwise(1)
    placed = running(placed, keys, Order("__at", ("__id",)), [
        Running("__part", "sum", breaks), Running("__broken", "max", F.when(~F.col("__hit"), F.col("__at"))), Running("__opened", "min", F.col("__at")),
        *([Running("__nth", "count"), Running("__all", "total_count")] if anchored else [])],
        rows_per_group, sizes_from=df.select(*keys, at(time).alias("__at"))).where("__hit").drop("__hit")
    if anchored:
        met = [F.col("__met")[i] for i in range(len(symbols))]
        placed = placed.withColumn("__set", set_of([*met, *ends_of_key])).drop("__met", "__nth", "__all")
    placed = staged(placed, "pattern-rows")
    own = F.floor(F.col("__at") / width)
    lent = F.floor((F.col("__at") - within_us) / width)
    # whether an earlier cell may hold rows of the same part
    inherits = F.coalesce("__broken", F.col("__opened")) < F.col("__cell_lo")

    def cells(rows: DataFrame) -> DataFrame:
        spread = (rows.withColumn("__home", own)
                  .withColumn("__cell", F.explode(F.array_distinct(F.array(own, F.greatest(lent, own - 1)))))
                  .withColumn("__own", F.col("__cell") == F.col("__home")).withColumn("__cell_lo", F.col("__cell") * width)
                  .withColumn("__inherits", inherits).drop("__broken", "__opened", "__home"))
        chunk = [*keys, "__part", "__cell"]
        return spread.repartition(*chunk).sortWithinPartitions(*chunk, "__at", "__id")

    kinds = "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)
    places = kinds + ", ".join(f"{c} BIGINT" for c in PLACES)
    described = places + ", n_rows INT, row_ids ARRAY<BIGINT>, classifiers ARRAY<STRING>" + "".join(f", `{m}` DOUBLE" for m in measures)
    finder = lambda chosen: _finder(pattern, symbols, keys, measures, within_us, target, words[1] == "last", chosen, subsets)
    if skip == "to next row":
        kept = staged(cells(placed.withColumn("__chosen", F.lit(True))).mapInArrow(finder(True), described), "matches")
    else:
        found = staged(cells(placed.drop(*[f"__m_{c}" for c in needed])).mapInArrow(finder(False), places), "places")
        starts = _without_overlaps(found, keys, rows_per_group).select(
            *[F.col(k).alias(f"__k_{k}") for k in keys], "__start", "__start_id", F.lit(True).alias("__chosen")).distinct()
        here = (F.col("__at") == F.col("__start")) & (F.col("__id") == F.col("__start_id"))
        marked = (placed.join(starts, meets(keys, "__k_", here) if keys else here, "left").drop("__start", "__start_id", *[f"__k_{k}" for k in keys])
                  .withColumn("__chosen", F.coalesce("__chosen", F.lit(False))))
        kept = staged(cells(marked).mapInArrow(finder(True), described), "matches")
    numbered = running(kept, keys, Order("__start", ("__start_id",)), [Running("match_number", "count")], rows_per_group)
    return numbered.select(*keys, "match_number", F.col("__start_id").alias("start_id"), F.col("__end_id").alias("end_id"),
                           "n_rows", "row_ids", "classifiers", *measures)


def _without_overlaps(found: DataFrame, keys: list[str], rows_per_group: int) -> DataFrame:
    """Keep a match if it starts where the last kept one lets matching resume. Matches that touch no other are told
    apart first. Clumps of overlapping ones are read in order; one above ``rows_per_group`` matches is linked instead."""
    end = F.struct("__end", "__end_id")
    reach = running(found, keys, Order("__start", ("__start_id",)), [
        Running("__reach", "max", end, exclusive=True)], rows_per_group)
    opens = F.when(F.coalesce(F.struct("__start", "__start_id") > F.col("__reach"), F.lit(True)), 1).otherwise(0)
    clumps = running(reach.withColumn("__opens", opens), keys, Order("__start", ("__start_id",)), [
        Running("__clump", "sum", F.col("__opens"))], rows_per_group, sizes_from=found).drop("__reach", "__opens")
    if found.count() <= rows_per_group:
        return _read_in_order(clumps, keys)
    clumps = staged(clumps, "clumps")
    large = hot_keys(clumps, [*keys, "__clump"], rows_per_group).select(*[F.col(k).alias(f"__h_{k}") for k in [*keys, "__clump"]])
    large = staged(large, "large-clumps")
    if large.isEmpty():
        return _read_in_order(clumps, keys)
    # at most as many as the matches have multiples of the limit
    among = broadcast_if_small(large)
    on = meets([*keys, "__clump"], "__h_")
    return _read_in_order(clumps.join(among, on, "left_anti"), keys).unionByName(_linked(clumps.join(among, on, "left_semi"), keys, rows_per_group))


def _linked(clumps: DataFrame, keys: list[str], rows_per_group: int) -> DataFrame:
    """Pointer jumping: every match points to the first start after it; links are doubled while the matches reached from
    the first one of each clump are gathered. The rounds are the logarithm of the most matches kept of a clump."""
    clump = [*keys, "__clump"]
    rows = staged(with_row_numbers(clumps, [*clump, "__start", "__start_id"], "__no", rows_per_group), "numbered")
    jumps = F.coalesce(F.struct(F.col("__resume").alias("a"), F.col("__resume_id").alias("b")) > F.struct(F.col("__start").alias("a"), F.col("__start_id").alias("b")), F.lit(False))
    spots = rows.select(*clump, F.col("__start").alias("__p"), F.col("__start_id").alias("__pid"), F.lit(1).alias("__side"), F.col("__no").alias("__spot"),
                        F.lit(None).cast("long").alias("__from"))
    # where a match lets matching resume: at its resume row itself, or after its end
    frees = rows.select(*clump, F.when(jumps, F.col("__resume")).otherwise(F.col("__end")).alias("__p"), F.when(jumps, F.col("__resume_id")).otherwise(F.col("__end_id")).alias("__pid"),
                        F.when(jumps, 0).otherwise(2).alias("__side"), F.lit(None).cast("long").alias("__spot"), F.col("__no").alias("__from"))
    seen = running(spots.unionByName(frees), clump, Order("__p", ("__pid", "__side")), [Running("__last", "max", F.col("__spot"))], rows_per_group)
    ends = rows.groupBy(*clump).agg(F.min("__no").alias("__first_no"), F.max("__no").alias("__last_no"))
    named = ends.select(*[F.col(k).alias(f"__e_{k}") for k in clump], "__first_no", "__last_no")
    # as many rows as there are large clumps
    links = (seen.where("__from IS NOT NULL").join(broadcast_if_small(named), meets(clump, "__e_"))
             .where("__last < __last_no").select(F.col("__from").alias("a"), (F.col("__last") + 1).alias("b")))
    links, reached = staged(links, "links"), staged(ends.select(F.col("__first_no").alias("a")), "reached")
    while True:
        further = staged(reached.join(links, "a").select(F.col("b").alias("a")), "reached")
        if further.isEmpty():
            break
        reached = reached.unionByName(further)
        links = staged(links.join(links.select(F.col("a").alias("b"), F.col("b").alias("c")), "b").select("a", F.col("c").alias("b")), "links")
    return rows.join(reached.select(F.col("a").alias("__no")), "__no", "left_semi").drop("__no", "__clump").select(*[c for c in clumps.columns if c != "__clump"])


def _read_in_order(clumps: DataFrame, keys: list[str]) -> DataFrame:
    """Clumps read one match after the other, with constant memory."""
    schema = clumps.schema

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, free, inclusive = None, None, False
        for batch in batches:
            keep = []
            # Arrow's own values: exact integers, and None equals None
            columns = [batch.column(c).to_pylist() for c in [*keys, "__clump", "__start", "__start_id", "__end", "__end_id", "__resume", "__resume_id"]]
            for mark in zip(*columns):
                clump = tuple("NaN" if v != v else v for v in mark[:len(keys) + 1])
                start, start_id, stop, stop_id, resume, resume_id = mark[len(keys) + 1:]
                spot = (start, start_id)
                if clump != current:
                    current, free = clump, None
                ok = free is None or spot > free or (inclusive and spot == free)
                if ok:
                    jumps = resume is not None and (resume, resume_id) > spot
                    free, inclusive = ((resume, resume_id), True) if jumps else ((stop, stop_id), False)
                keep.append(ok)
            yield batch.filter(pa.array(keep, pa.bool_()))

    parts = clumps.repartition(*keys, "__clump").sortWithinPartitions(*keys, "__clump", "__start", "__start_id")
    return parts.mapInArrow(scan, schema).drop("__clump")


def all_rows(matches: DataFrame, keys: list[str]) -> DataFrame:
    """ALL ROWS PER MATCH: one row per matched row with its classifier."""
    flat = matches.select(*keys, "match_number", F.explode(F.arrays_zip("row_ids", "classifiers")).alias("__r"))
    return flat.select(*keys, "match_number", F.col("__r.row_ids").alias("row_id"), F.col("__r.classifiers").alias("classifier"))
