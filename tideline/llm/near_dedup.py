"""MinHash near-duplicates from bottom-k sketches of one hash function.

1. One pass over the texts gives per document the size and a 128-bit signature of its shingle set and a
   sketch: the k smallest shingle hashes. Documents with equal sets form a class (map-side combined).
2. Inverted lists: classes by retained value. A class enters the lists of the PREFIX least frequent values of its
   whole sketch (values of no other class come first), so that a text with much of its own enters few lists or
   none and common shingles seldom pair unrelated texts. A list of more than ``long_list`` classes is long.
3. First every class meets a few hubs of its lists (the smallest id, the most central classes), linear in
   the list. Then classes of short lists that share ``OVERLAPS`` values (one, for sets below K) and are still in
   different components meet each other, and last the classes of long lists that hubs left in
   different components and whose shared shingles allow a link at all; sketches of WIDE values judge these in the join.
4. The sketch of the union estimates the similarity; pairs far below the limit go. Exact Jaccard on the full
   sets decides: first the most similar partner of each class, then only pairs that would still join two components.

At most a fifth of either set is not shared at Jaccard 0.8. Two sketches that lack u values of each other have their
least frequent common values among the u + 1 (u + 2, u + 3) least frequent of both, however common those are. For sets
below K, whose sketches are complete, a fifth of the set and one more is therefore exact, and nothing is left to
chance. For larger sets u is at most Bin(K, 0.2), the worst case being a text that contains the other; OVERLAPS common
lists are missed for u > PREFIX - OVERLAPS = 17 only, as is the estimate of step 4: 7 pairs in 1,000,000 at the very limit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..plans.staging import staged
from .graph import components
from .rows import numbered
from .text import mix, pieces, shingle_sets, word_hashes

K = 32
PREFIX = 20
OVERLAPS = 3
LONG_LIST = 40
#: five standard deviations of an estimate from K values at a similarity of 0.8
MARGIN = 0.35
#: values of the sketches that judge pairs of long lists, and five standard deviations of an estimate from them
WIDE = 256
WIDE_MARGIN = 0.125
#: shingles that a task gathers before it combines them, and about as many as one part of all of them holds
PART_SHINGLES = 500_000
#: document ids that may be broadcast to pick texts out of a scan (16 bytes each)
BROADCAST_IDS = 500_000


def _sketches(size: int):
    def run(batches):
        for batch in batches:
            n, a, b, held = [], [], [], []
            for p in pieces(batch.column("text"), lower=True):
                for s in shingle_sets(p, word_hashes(p), size):
                    u = s.view(np.uint64)
                    n.append(len(s))
                    a.append(int(mix(u ^ np.uint64(0x5851F42D4C957F2D)).sum().view(np.int64)) if len(s) else 0)
                    b.append(int(np.bitwise_xor.reduce(mix(u + np.uint64(0x14057B7EF767814F))).view(np.int64)) if len(s) else 0)
                    held.append(s[:K])
            ends = np.concatenate([[0], np.cumsum([len(s) for s in held])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*held, np.zeros(0, np.int64)])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), lists],
                names=["doc_id", "n", "sig_a", "sig_b", "sketch"])
    return run


def _wide_sketches(size: int):
    """(id, wide): the WIDE smallest shingle hashes, ascending."""
    def run(batches):
        for batch in batches:
            for p in pieces(batch.column("text"), lower=True):
                held = [s[:WIDE] for s in shingle_sets(p, word_hashes(p), size)]
                ends = np.concatenate([[0], np.cumsum([len(s) for s in held])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(p.first, len(p)),
                                                  pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(held)))], names=["id", "wide"])
    return run


def _exact(size: int, threshold: int):
    """Pairs with both texts in, pairs that are similar out. Neighbouring rows share their first text."""
    def sets(column):
        return [s for p in pieces(column, lower=True) for s in shingle_sets(p, word_hashes(p), size)]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = part.column("a").to_pylist()
                new = [i for i, x in enumerate(ids) if i == 0 or ids[i - 1] != x]
                firsts = sets(part.column("text_a").take(pa.array(new)))
                which = np.cumsum([i == 0 or ids[i - 1] != x for i, x in enumerate(ids)]) - 1
                keep = []
                for i, y in enumerate(sets(part.column("text_b"))):
                    x = firsts[which[i]]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= threshold * (len(x) + len(y) - both))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"]).filter(pa.array(keep))
    return run


def _similar(pairs: DataFrame, texts: DataFrame, size: int, threshold: int) -> DataFrame:
    one = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    full = pairs.select("a", "b").join(two, "b").join(one, "a").select("a", "b", "text_a", "text_b")
    return full.mapInArrow(_exact(size, threshold), "a long, b long")


def _fits(threshold: int):
    """Sizes that a similarity of ``threshold`` percent allows."""
    return (100 * F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b"))


def _estimated(pairs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """Pairs whose union sketch does not rule the limit out; ``known`` where it is the full set."""
    one = classes.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    two = classes.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
    full = pairs.select("a", "b").join(one, "a").join(two, "b").where(_fits(threshold))
    union = F.slice(F.sort_array(F.array_union("s_a", "s_b")), 1, K)
    complete = (F.col("n_a") <= K) & (F.col("n_b") <= K)
    union = F.when(complete, F.array_union("s_a", "s_b")).otherwise(union)
    shared = F.size(F.array_intersect(F.array_intersect("s_a", "s_b"), union))
    return (full.select("a", "b", complete.alias("known"), shared.alias("shared"), F.size(union).alias("of"))
            .where(F.when(F.col("known"), 100 * F.col("shared") >= threshold * F.col("of"))
                   .otherwise(F.col("shared") >= (threshold / 100 - MARGIN) * F.col("of")))
            .select("a", "b", "known", (F.col("shared") / F.col("of")).alias("estimate")))


def _lists(classes: DataFrame, threshold: int) -> DataFrame:
    """(v, n_list, id, n) of the lists each class enters."""
    values = classes.select("id", "n", F.explode("sketch").alias("v"))
    sizes = values.groupBy("v").agg(F.count(F.lit(1)).alias("n_list")).where("n_list > 1")
    held = values.join(sizes, "v")
    # at most K rows of each class, least frequent first
    mine = held.groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("n_list", "v"))).alias("held"))
    alone = F.least("n", F.lit(K)) - F.size("held")
    prefix = F.when(F.col("n") < K, F.floor(F.col("n") * (100 - threshold) / 100) + 1).otherwise(PREFIX)
    entered = F.slice("held", F.lit(1), F.greatest(prefix - alone, F.lit(0)).cast("int"))
    # a text that others were copied from holds more of what they share than any copy does
    central = F.struct(F.size("held").alias("many"), F.aggregate("held", F.lit(0).cast("long"), lambda total, x: total + x["n_list"]).alias("sum"))
    return (mine.select("id", "n", central.alias("central"), F.explode(entered).alias("x"))
            .select("id", "n", "central", F.col("x.v").alias("v"), F.col("x.n_list").alias("n_list")))


def _spokes(lists: DataFrame, threshold: int, long_list: int) -> DataFrame:
    """(a, b): every class with a few hubs of each list it is in, if their sizes allow a link; linear in the list."""
    hub = F.struct("id", "n")
    hubs = lists.groupBy("v").agg(F.min(hub).alias("h1"), F.max_by(hub, F.struct("central", "id")).alias("h2"),
                                  F.max_by(hub, F.struct("central.many", F.xxhash64("id", "v"))).alias("h3"))
    rows = (lists.join(hubs, "v").select("id", F.col("n").alias("n_a"), (F.col("n_list") > long_list).alias("long"),
                                         F.explode(F.array_distinct(F.array("h1", "h2", "h3"))).alias("hub"))
            .select("id", "long", "n_a", F.col("hub.id").alias("h"), F.col("hub.n").alias("n_b"))
            .where(_fits(threshold)).withColumn("n", F.col("n_a")))
    return (rows.where("id != h").groupBy(F.least("id", "h").alias("a"), F.greatest("id", "h").alias("b"))
            .agg(F.count(F.lit(1)).alias("overlaps"), F.min("n").alias("n"), F.max("long").alias("long"))
            .where((F.col("overlaps") >= OVERLAPS) | (F.col("n") * 4 < K * 5) | F.col("long")).select("a", "b"))


def _gathered(size: int, parts: int):
    """Shingles of a task's classes by hash, a row for each part: those of one class with that class, and those of several."""
    def rows(s, ids):
        order = np.argsort(s, kind="stable")
        s, ids = s[order], ids[order]
        starts = np.flatnonzero(np.append(True, s[1:] != s[:-1])[:len(s)])
        s, ids, single = s[starts], ids[starts], np.diff(np.append(starts, len(s))) == 1
        part = (s.view(np.uint64) % np.uint64(parts)).astype(np.int32)
        columns = []
        for values, of in ((s[single], part[single]), (ids[single], part[single]), (s[~single], part[~single])):
            ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=parts))]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(values[np.argsort(of, kind="stable")])))
        return pa.RecordBatch.from_arrays([pa.array(np.arange(parts, dtype=np.int32)), *columns], names=["part", "s", "id", "several"])

    def run(batches):
        held, ids, n = [], [], 0
        for batch in batches:
            for p in pieces(batch.column("text"), lower=True):
                sets = list(shingle_sets(p, word_hashes(p), size))
                own = batch.column("id").slice(p.first, len(p)).to_numpy(zero_copy_only=False)
                held += sets
                ids.append(np.repeat(own, [len(s) for s in sets]))
                n += len(ids[-1])
                if n >= PART_SHINGLES:
                    yield rows(np.concatenate(held), np.concatenate(ids))
                    held, ids, n = [], [], 0
        if n:
            yield rows(np.concatenate(held), np.concatenate(ids))
    return run


def _alone(table: pa.Table) -> pa.Table:
    """(id, alone): how many shingles of a part only this class has."""
    flat = lambda name: pa.chunked_array(table.column(name).chunks, table.column(name).type).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    s, first, c = np.unique(flat("s"), return_index=True, return_counts=True)
    own = flat("id")[first[(c == 1) & ~np.isin(s, flat("several"))]]
    ids, n = np.unique(own, return_counts=True)
    return pa.table({"id": pa.array(ids, pa.int64()), "alone": pa.array(n, pa.int64())})


def _can_link(members: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(id, shared): how many shingles of a class stand in another class of ``members`` at all. A pair of
    sizes n and m with the similarity t shares t / (1 + t) * (n + m), so this bounds what a class can link with.
    Shingles travel in parts by hash, each task's combined, as many parts as keep each small."""
    ids = members.select("id", "n").distinct()
    parts = 1 + (ids.agg(F.sum("n")).first()[0] or 0) // PART_SHINGLES
    rows = texts.join(ids.select("id"), "id", "left_semi").mapInArrow(
        _gathered(size, parts), "part int, s array<long>, id array<long>, several array<long>")
    alone = rows.groupBy("part").applyInArrow(_alone, "id long, alone long").groupBy("id").agg(F.sum("alone").alias("alone"))
    return members.join(alone, "id", "left").withColumn("shared", F.col("n") - F.coalesce("alone", F.lit(0))).drop("alone")


def linked(docs: DataFrame, size: int = 2, threshold: int = 80, long_list: int = LONG_LIST) -> tuple[DataFrame, DataFrame]:
    """(rows, links): per document doc_id, n, id (class: smallest doc_id of equal sets) and component;
    and the verified links between classes that the components were built from. Each doc_id stands in one row."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketched = staged(base.mapInArrow(_sketches(size), "doc_id long, n long, sig_a long, sig_b long, sketch array<long>"), "sketches")
    key = ["n", "sig_a", "sig_b"]
    classes = staged(sketched.where("n > 0 and doc_id is not null").groupBy(*key)
                     .agg(F.min("doc_id").alias("id"), F.first("sketch").alias("sketch")), "classes")
    lists = staged(_lists(classes, threshold), "lists")

    def texts_of(ids: DataFrame) -> DataFrame:
        ids = staged(ids.distinct(), "involved")
        few = ids.count() <= BROADCAST_IDS
        return staged(base.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(ids) if few else ids, "id", "left_semi"), "texts")

    def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
        return staged(pairs.where("known").select("a", "b").unionByName(
            _similar(pairs.where("not known"), texts, size, threshold)), "links")

    def open_texts(pairs: DataFrame) -> DataFrame:
        return texts_of(pairs.where("not known").select(F.explode(F.array("a", "b")).alias("id")))

    # every class with the hubs of its lists
    tried = staged(_estimated(_spokes(lists, threshold, long_list), classes, threshold), "pairs")
    texts = open_texts(tried)
    # first each class with its most similar partner, then only the pairs that would still join two components
    best = tried.where("not known").groupBy("b").agg(F.max_by("a", F.struct("estimate", "a")).alias("a")).select("a", "b")
    found = verified(tried.where("known").select("a", "b", "known").unionByName(best.withColumn("known", F.lit(False))), texts)
    comps = components(found)
    rest = _apart(tried.where("not known").select("a", "b").join(best, ["a", "b"], "left_anti"), comps)
    more = verified(rest.withColumn("known", F.lit(False)), texts)
    if not more.isEmpty():
        found, comps = found.unionByName(more), components(more, comps)

    # short lists: all pairs whose classes are still apart
    marked = staged(_labelled(lists.drop("central"), comps), "marked")
    split = marked.groupBy("v", "n_list").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("v", "n_list")
    short = marked.join(split.where(F.col("n_list") <= long_list).select("v"), "v")
    near = (_meeting(short, threshold).groupBy("a", "b", F.least("n_a", "n_b").alias("n")).agg(F.count(F.lit(1)).alias("overlaps"))
            .where(F.col("overlaps") >= F.when(F.col("n") < K, 1).otherwise(OVERLAPS)).select("a", "b")
            .join(tried.select("a", "b"), ["a", "b"], "left_anti"))
    near = staged(_estimated(near, classes, threshold), "pairs")
    if not near.isEmpty():
        more = verified(near, open_texts(near))
        found, comps = found.unionByName(more), components(more, comps)

    # long lists that hubs left in several components: only classes that can link, against the whole list
    far = _labelled(lists.where(F.col("n_list") > long_list).select("id", "n", "v"), comps)
    split = far.groupBy("v").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("v")
    far = staged(far.join(split, "v"), "unresolved")
    if not far.isEmpty():
        texts = texts_of(far.select("id"))
        # a link shares at least ``threshold`` percent of either set; what only classes without a partner held is counted again
        able = staged(_can_link(far, texts, size).where(100 * F.col("shared") >= threshold * F.col("n")).drop("shared"), "unresolved")
        able = staged(_can_link(able, texts, size).where(100 * F.col("shared") >= threshold * F.col("n")), "unresolved")
        # the largest component of a list has found its hub; the others meet it and each other
        largest = able.groupBy("v", "component").agg(F.count(F.lit(1)).alias("c")).groupBy("v").agg(
            F.max_by("component", F.struct("c", "component")).alias("largest"))
        wide = (texts.join(able.select("id").distinct(), "id", "left_semi").mapInArrow(_wide_sketches(size), "id long, wide array<long>")
                .join(able.groupBy("id").agg(F.collect_list("v").alias("held")), "id"))  # at most K lists
        rows = staged(able.join(largest, "v").join(wide, "id"), "unresolved")
        cross = _crossing(rows, threshold).join(tried.select("a", "b"), ["a", "b"], "left_anti")
        cross = staged(cross, "pairs")
        if not cross.isEmpty():
            more = verified(cross, texts)
            found, comps = found.unionByName(more), components(more, comps)

    of_class = (_labelled(classes.select(*key, "id"), comps))
    rows = sketched.select("doc_id", *key).join(of_class, key, "left").select(
        "doc_id", "n", F.coalesce("id", "doc_id").alias("id"), F.coalesce("component", "doc_id").alias("component"))
    return rows, found


def _sides(rows: DataFrame, *columns: str) -> list[DataFrame]:
    return [rows.select("v", *[F.col(c).alias(f"{c}_{x}") for c in columns]) for x in "ab"]


def _meeting(rows: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a < b) of one list, of different components, that their sizes allow, once for each list they share."""
    one, two = _sides(rows, "id", "n", "component")
    return (one.join(two, "v").where((F.col("component_a") != F.col("component_b")) & (F.col("id_a") < F.col("id_b")) & _fits(threshold))
            .select(F.col("id_a").alias("a"), F.col("id_b").alias("b"), "n_a", "n_b"))


def _crossing(rows: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a < b) of one list and different components that their sizes, their shared shingles and their wide
    sketches allow; ``known`` where these are the full sets. The join itself judges all that, and only in the first
    list that two classes share."""
    one, two = _sides(rows, "id", "n", "component", "largest", "shared", "held", "wide")
    once = (F.col("component_b") == F.col("largest_b")) | (F.col("id_a") < F.col("id_b"))
    able = (100 + threshold) * F.least("shared_a", "shared_b") >= threshold * (F.col("n_a") + F.col("n_b"))
    first = F.array_min(F.array_intersect("held_a", "held_b")) == F.col("v")
    known = (F.col("n_a") <= WIDE) & (F.col("n_b") <= WIDE)
    both = F.array_intersect("wide_a", "wide_b")
    least = (threshold / 100 - WIDE_MARGIN) * WIDE
    union = F.slice(F.sort_array(F.array_union("wide_a", "wide_b")), 1, WIDE)
    similar = F.when(known, (100 + threshold) * F.size(both) >= threshold * (F.col("n_a") + F.col("n_b"))).otherwise(
        (F.size(both) >= least) & (F.size(F.array_intersect(both, union)) >= least))
    pairs = one.where("component_a != largest_a").join(two.withColumnRenamed("v", "w"), (F.col("v") == F.col("w")) & (
        F.col("component_a") != F.col("component_b")) & once & _fits(threshold) & able & first & similar)
    return pairs.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"), known.alias("known"))


def _repeated(docs: DataFrame) -> bool:
    """Whether a doc_id stands in several rows."""
    seen = docs.agg(F.count("doc_id").alias("rows"), F.count_distinct("doc_id").alias("ids")).first()
    return seen["rows"] > seen["ids"]


def _labelled(df: DataFrame, comps: DataFrame) -> DataFrame:
    return (df.join(comps.select(F.col("node").alias("id"), F.col("root")), "id", "left")
            .withColumn("component", F.coalesce("root", "id")).drop("root"))


def _apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    one = comps.select(F.col("node").alias("a"), F.col("root").alias("c_a"))
    two = comps.select(F.col("node").alias("b"), F.col("root").alias("c_b"))
    return (pairs.join(one, "a", "left").join(two, "b", "left")
            .where(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b"))


def _by_row(docs: DataFrame) -> DataFrame:
    """``docs`` with a number ``__row_id`` of each row that has an id, growing with the ids, instead of ids that repeat."""
    known = docs.where("doc_id is not null").withColumn("__text_hash", F.xxhash64("text"))
    return numbered(known, ["doc_id", "__text_hash"], "__row_id")[0].drop("__text_hash")


def near_duplicates(docs: DataFrame, size: int = 2, threshold: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept.

    Null and empty texts have no shingles and link with nothing. Rows that repeat a doc_id are compared row by row: each
    has the component of its own text. A null doc_id links with nothing, its component
    is null and the row is kept. Other columns of ``docs`` are ignored. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    columns = ["doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("component")).alias("kept")]
    if not _repeated(docs):
        return linked(docs, size, threshold)[0].select(*columns)
    rows = staged(_by_row(docs), "rows")
    found = linked(rows.select(F.col("__row_id").alias("doc_id"), "text"), size, threshold)[0]
    names = rows.select(F.col("__row_id").alias("doc_id"), F.col("doc_id").alias("name"))
    found = (found.join(names, "doc_id").join(names.select(F.col("doc_id").alias("component"), F.col("name").alias("component_name")), "component")
             .select(F.col("name").alias("doc_id"), "n", F.col("component_name").alias("component")))
    without = linked(docs.where("doc_id is null"), size, threshold)[0].select("doc_id", "n", F.lit(None).cast("long").alias("component"))
    return found.unionByName(without).select(*columns)


def one_of_each_group(docs: DataFrame, size: int = 5, threshold: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: of each group of near-duplicates the row with the smallest
    doc_id. Rows that repeat a doc_id are rows of their own: one stays unless its text is near that of an earlier
    row. Rows with a null doc_id stay."""
    if not _repeated(docs):
        kept = near_duplicates(docs.select("doc_id", "text"), size, threshold).where("kept and doc_id is not null").select("doc_id")
        known = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi")
    else:
        rows = staged(_by_row(docs), "rows")
        kept = linked(rows.select(F.col("__row_id").alias("doc_id"), "text"), size, threshold)[0].where("doc_id = component").select(F.col("doc_id").alias("__row_id"))
        known = rows.join(kept, "__row_id", "left_semi").drop("__row_id")
    return known.unionByName(docs.where("doc_id is null")).select(*docs.columns)
