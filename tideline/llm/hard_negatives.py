"""Hard negatives by exact inner-product search in cover trees.

1. Vectors become integer vectors. They are laid out by label in blocks of at most ``BLOCK`` rows, and every block is
   written with a cover tree. A tree works on norm-augmented vectors: a further component sqrt(M^2 - |x|^2), M the largest
   norm of the block, puts all rows on one sphere, where an inner product with an anchor is an angle. Nodes of a level
   cover their rows within an angle that shrinks from level to level; each keeps the covering angle it really has.
2. Anchors, a bounded group at a time, go to all blocks. From the angle to a node's centre and the node's covering
   angle follow an upper and a lower bound of all inner products below it. Level by level, nodes that no window of an
   anchor reaches, or that cannot beat the rows already found, are left out. The leaf of the highest bound is
   verified first, then the others that still can hold a better row. Verification computes exact integers.
3. A task keeps the best rows per anchor and window over all its blocks and sends only those on; the first of all
   tasks' rows are the result. Positives come first and define the windows of the negatives.

Nothing is approximate and no candidate is dropped: the trees only leave out rows that cannot be among the first.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..plans.staging import staged
from .rows import numbered

#: rows of a tree, and bytes of its vectors
BLOCK, BLOCK_BYTES = 2048, 16 << 20
#: a node of at most so many rows, or one that would fall into pieces of fewer than so many on average, is a leaf
LEAF, LEAST_CHILD = 24, 3
#: the covering angle of a child is at most its parent's by this
SHRINK = 1.5
#: anchors that meet the blocks in one pass, and bytes of their vectors
ANCHORS, ANCHOR_BYTES = 8192, 64 << 20
NONE = np.iinfo(np.int64).min
EXACT = 1 << 53


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, each different row once. Components are whole doubles."""
    whole = F.transform(F.col(vector), lambda x: F.lit(256.0) * x.cast("double"))
    known = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    label = F.col("label").cast("long")
    return (rows.where(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.col(vector).isNotNull()).where(known)
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.when(F.col("vec_id").cast("long") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), whole.alias("vector"))
            .dropDuplicates())


def matrix(column: pa.ListArray, width: int | None = None) -> np.ndarray:
    """Floored vectors as rows of doubles; shorter ones are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(column.value_lengths())
    flat = np.floor(np.asarray(column.flatten(), np.float64))
    width = max(int(sizes.max(initial=0)), 1) if width is None else width
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


# ---- the tree of one block ------------------------------------------------------------------------------------

def cover_tree(points: np.ndarray) -> dict[str, np.ndarray]:
    """The cover tree of some vectors: ``order`` of the rows so that every node holds a run of them, and per node, level by
    level, ``center`` (place in the order), covering ``angle``, ``parent``, ``first`` and ``stop`` of its run, ``leaf`` and ``level``."""
    if not len(points):
        return {c: np.zeros(0, {"angle": float, "leaf": bool}.get(c, np.int64)) for c in ("order", *TREE)}
    norms = np.sqrt((points * points).sum(axis=1))
    top = max(float(norms.max(initial=0.0)), 1.0)
    sphere = np.column_stack([points, np.sqrt(np.maximum(top * top - norms * norms, 0))]) / top
    angles = lambda some, center: np.arccos(np.clip(sphere[some] @ sphere[center], -1, 1))
    everything = np.arange(len(points))
    start = int(np.argmax(sphere @ sphere.mean(axis=0)))
    # a node: rows with the centre first, covering angle, parent, level
    level, done, order_of = [(np.concatenate([[start], np.delete(everything, start)]), -1)], [], {}
    number, depth = 0, 0
    while level:
        below = []
        for members, parent in level:
            away = angles(members, members[0])
            reach = float(away.max(initial=0.0))
            children = []
            if len(members) > LEAF and reach > 1e-7:
                limit, rest, left = reach / SHRINK, members, away
                center = members[0]
                while len(rest) and len(children) * LEAST_CHILD <= len(members):
                    near = left <= limit
                    near[rest == center] = True
                    held = rest[near]
                    children.append(np.concatenate([[center], held[held != center]]))
                    rest, left = rest[~near], left[~near]
                    if len(rest):
                        center = rest[int(np.argmax(left))]
                        left = angles(rest, center)
                if len(rest):  # too many pieces: the rows do not lie in groups at this scale
                    children = []
            done.append((members, reach, parent, not children, depth))
            below += [(c, number) for c in children]
            number += 1
        level, depth = below, depth + 1
    # runs: a depth-first walk puts the rows of every node side by side
    kids: dict[int, list[int]] = {}
    for i, node in enumerate(done):
        kids.setdefault(node[2], []).append(i)
    first, order, stack, at = np.zeros(len(done), np.int64), [], [0], 0
    while stack:
        i = stack.pop()
        first[i] = at
        if done[i][3]:
            order.append(done[i][0])
            at += len(done[i][0])
        else:
            stack += kids[i][::-1]
    order = np.concatenate(order)
    place = np.empty(len(points), np.int64)
    place[order] = everything
    return {"order": order, "center": np.array([place[n[0][0]] for n in done], np.int64),
            "angle": np.array([n[1] for n in done]), "parent": np.array([n[2] for n in done], np.int64), "first": first,
            "stop": first + np.array([len(n[0]) for n in done], np.int64), "leaf": np.array([n[3] for n in done], bool),
            "level": np.array([n[4] for n in done], np.int64)}


TREE = ("center", "angle", "parent", "first", "stop", "leaf", "level")
BLOCKS = ("label long, width int, ids array<long>, points binary, center array<long>, angle array<double>, parent array<long>, "
          "first array<long>, stop array<long>, leaf array<boolean>, level array<long>")


def blocks(rows: DataFrame) -> DataFrame:
    """Blocks of rows of one label, each with its tree, written. A label of any size has as many blocks as it needs."""
    names = [part.split()[0] for part in BLOCKS.split(", ")]

    def build(label, ids, points):
        tree = cover_tree(points)
        raw = points[tree["order"]].tobytes()
        values = [label, points.shape[1], ids[tree["order"]], raw, *[tree[c] for c in TREE]]
        kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), *[pa.list_({"angle": pa.float64(), "leaf": pa.bool_()}.get(c, pa.int64())) for c in TREE]]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

    def run(batches):
        waiting = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if waiting is None else pa.concat_tables([waiting, table])
            labels, ids, points = table["label"].to_numpy(), table["vec_id"].to_numpy(), matrix(table["vector"])
            size = max(1, min(BLOCK, BLOCK_BYTES // (8 * points.shape[1])))
            stops = [*(np.flatnonzero(labels[1:] != labels[:-1]) + 1).tolist(), len(labels)]
            at = 0
            for stop in stops:
                while stop - at >= size or (stop < len(labels) and stop > at):
                    end = min(stop, at + size)
                    yield build(int(labels[at]), ids[at:end], points[at:end])
                    at = end
            waiting = table.slice(at) if at < len(labels) else None
        if waiting is not None:
            yield build(int(waiting["label"][0].as_py()), waiting["vec_id"].to_numpy(), matrix(waiting["vector"]))

    # a given number of partitions, so that they are not joined into one again
    many = max(1, -(-rows.count() // (4 * BLOCK)))
    spread = rows.withColumn("__h", F.xxhash64("vec_id", "vector")).repartitionByRange(many, "label", "__h")
    return staged(spread.sortWithinPartitions("label", "__h").select("vec_id", "label", "vector").mapInArrow(run, BLOCKS), "trees")


# ---- search ---------------------------------------------------------------------------------------------------

class Best:
    """The first ``k`` rows per anchor and window: higher scores first, then smaller ids."""

    def __init__(self, anchors: int, windows: int, k: int):
        self.k = k
        self.scores = np.full((anchors * windows, k), NONE)
        self.ids = np.zeros((anchors * windows, k), np.int64)

    def worst(self) -> np.ndarray:
        """A score that a further row must reach, per anchor and window."""
        return self.scores[:, -1]

    def add(self, flat: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(flat):
            return
        touched = np.unique(flat)
        old_s, old_i = self.scores[touched].ravel(), self.ids[touched].ravel()
        held = old_s != NONE
        flat = np.concatenate([flat, np.repeat(touched, self.k)[held]])
        scores, ids = np.concatenate([scores, old_s[held]]), np.concatenate([ids, old_i[held]])
        order = np.lexsort((ids, ~scores, flat))
        flat, scores, ids = flat[order], scores[order], ids[order]
        begin = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
        rank = np.arange(len(flat)) - np.repeat(begin, np.diff(np.append(begin, len(flat))))
        keep = rank < self.k
        self.scores[touched], self.ids[touched] = NONE, 0
        self.scores[flat[keep], rank[keep]] = scores[keep]
        self.ids[flat[keep], rank[keep]] = ids[keep]


def products(anchors: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact integer inner products. Doubles are exact below 2^53; larger ones go through whole numbers and end at 64 bits."""
    width = min(anchors.shape[1], points.shape[1])
    a, p = anchors[:, :width], points[:, :width]
    if np.abs(a).max(initial=0) * np.abs(p).max(initial=0) * width < EXACT:
        return (a @ p.T).astype(np.int64)
    exact = np.array([[int(v) for v in row] for row in a.tolist()], object) @ np.array([[int(v) for v in row] for row in p.tolist()], object).T
    return np.clip(exact, -(1 << 62), 1 << 62).astype(np.int64)


def search_block(best: Best, anchors: dict[str, np.ndarray], block: dict, same_label: bool) -> tuple[int, int]:
    """Add a block's rows to the best ones. Returns how many (anchor, row) pairs were verified, and how many there are."""
    taking = np.flatnonzero((anchors["label"] == block["label"]) == same_label)
    points, n_windows = block["points"], anchors["low"].shape[1]
    if not len(taking) or not len(points):
        return 0, 0
    vectors, low, high = anchors["vectors"][taking], anchors["low"][taking], anchors["high"][taking]
    size = np.maximum(np.sqrt((vectors * vectors).sum(axis=1)), 1e-300)
    radius = max(float(np.sqrt((points * points).sum(axis=1)).max()), 1.0)
    width = min(vectors.shape[1], points.shape[1])
    slack = 1e-7 * size * radius + 0.5

    def floors() -> np.ndarray:
        return np.maximum(low, best.worst().reshape(-1, n_windows)[taking])

    def reached(upper, lower, least) -> np.ndarray:
        """(anchor, node): some window can still gain from the node."""
        return np.any((upper[:, :, None] >= least[:, None, :]) & (lower[:, :, None] <= high[:, None, :]), axis=2)

    # level by level: bounds of the nodes whose parents are still of interest
    masks, uppers, lowers, leaves = [], [], [], []
    of_level, mask = {-1: 0}, np.ones((len(taking), 1), bool)
    least = floors()
    for depth in range(int(block["level"].max()) + 1):
        nodes = np.flatnonzero(block["level"] == depth)
        parents = np.array([of_level[p] for p in block["parent"][nodes].tolist()])
        angle = np.arccos(np.clip((vectors[:, :width] @ points[block["center"][nodes], :width].T) / (size[:, None] * radius), -1, 1))
        scale = (size * radius)[:, None]
        upper = scale * np.cos(np.maximum(angle - block["angle"][nodes], 0)) + slack[:, None]
        lower = scale * np.cos(np.minimum(angle + block["angle"][nodes], np.pi)) - slack[:, None]
        mask = mask[:, parents] & reached(upper, lower, least)
        is_leaf = block["leaf"][nodes]
        leaves.append(nodes[is_leaf])
        masks.append(mask[:, is_leaf])
        uppers.append(upper[:, is_leaf])
        lowers.append(lower[:, is_leaf])
        of_level = {n: i for i, n in enumerate(nodes.tolist())}
    leaves, mask = np.concatenate(leaves), np.concatenate(masks, axis=1)
    upper, lower = np.concatenate(uppers, axis=1), np.concatenate(lowers, axis=1)

    verified = 0
    def verify(wanted: np.ndarray) -> None:
        nonlocal verified
        found, least = [], floors()
        for i in np.flatnonzero(wanted.any(axis=0)).tolist():
            who = np.flatnonzero(wanted[:, i])
            a, b = block["first"][leaves[i]], block["stop"][leaves[i]]
            scores = products(vectors[who], points[a:b])
            verified += scores.size
            ids = block["ids"][a:b]
            other = ids[None, :] != anchors["id"][taking[who]][:, None]
            for w in range(n_windows):
                hit = (scores >= least[who, w][:, None]) & (scores <= high[who, w][:, None]) & other
                at, row = np.nonzero(hit)
                found.append((taking[who[at]] * n_windows + w, scores[at, row], ids[row]))
        if found:
            best.add(*[np.concatenate(c) for c in zip(*found)])

    first = np.zeros_like(mask)
    if mask.shape[1]:
        highest = np.argmax(np.where(mask, upper, -np.inf), axis=1)
        first[np.arange(len(mask)), highest] = mask[np.arange(len(mask)), highest]
        verify(first)
        verify(mask & ~first & reached(upper, lower, floors()))
    return verified, len(taking) * len(points)


def read_block(row: dict) -> dict:
    out = {c: np.asarray(row[c]) for c in TREE}
    out |= {"label": row["label"], "ids": np.asarray(row["ids"], np.int64), "points": np.frombuffer(row["points"], np.float64).reshape(-1, row["width"])}
    return out


def _searched(trees: DataFrame, anchors: dict[str, np.ndarray], k: int, same_label: bool) -> DataFrame:
    """(anchor, window, score, id, rank): the first k rows of each anchor and window; ``anchor`` is a place in the group."""
    held = trees.sparkSession.sparkContext.broadcast(anchors)
    n_windows = anchors["low"].shape[1]

    def run(batches):
        best = Best(len(held.value["id"]), n_windows, k)
        for batch in batches:
            for at in range(batch.num_rows):
                search_block(best, held.value, read_block(batch.slice(at, 1).to_pylist()[0]), same_label)
        flat, rank = np.nonzero(best.scores != NONE)
        yield pa.RecordBatch.from_arrays([pa.array(flat // n_windows), pa.array(flat % n_windows), pa.array(best.scores[flat, rank]), pa.array(best.ids[flat, rank])],
                                         names=["anchor", "window", "score", "id"])

    found = trees.mapInArrow(run, "anchor long, window long, score long, id long")
    # a task sends k rows per anchor and window, and a partition of this window keeps k before the exchange as well
    w = Window.partitionBy("anchor", "window").orderBy(F.col("score").desc(), F.col("id").asc())
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low_tenths: int = 3, high_tenths: int = 9,
                   vector: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are rows whose vec_id is divisible by ``every``. For each and each of its first ``positives`` rows of the same
    label, the first ``negatives`` rows of other labels with a score of ``low_tenths`` to ``high_tenths`` tenths of the
    positive's. Rows with a null id, label, vector or component, or a component that is not finite, take no part. Equal
    rows count once; different rows that share an id each count, but never for an anchor of that id. Vectors of different
    lengths meet in the components both have; an empty vector scores 0. Scores beyond 62 bits end there. Other columns are
    ignored. An empty table, or one without anchors, gives no rows."""
    spark = rows.sparkSession
    good = staged(usable(rows, vector), "vectors")
    ordered, total = numbered(good.where(F.col("vec_id") % every == 0).withColumn("__h", F.xxhash64("label", "vector")), ["vec_id", "__h"], "__anchor")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not total:
        return spark.createDataFrame([], schema)
    ordered = staged(ordered, "anchors")
    trees = blocks(good)
    width = max(ordered.agg(F.max(F.size("vector"))).first()[0], 1)
    step, out = max(1, min(ANCHORS, ANCHOR_BYTES // (8 * width))), []
    # a bounded group of anchors at a time against all blocks
    for at in range(0, total, step):
        table = ordered.where((F.col("__anchor") >= at) & (F.col("__anchor") < at + step)).orderBy("__anchor").toArrow()
        group = {"id": table["vec_id"].to_numpy(), "label": table["label"].to_numpy(), "vectors": matrix(table["vector"], width)}
        none = np.full((len(group["id"]), 1), NONE + 1)
        near = _searched(trees, {**group, "low": none, "high": ~none}, positives, True).collect()
        # windows of the negatives, one per positive: ceil(low * score / 10) to floor(high * score / 10)
        # a positive that is missing has an empty window
        low, high = (np.full((len(group["id"]), positives), x, np.int64) for x in (1 << 62, -1))
        for r in near:
            low[r.anchor, r.rank - 1], high[r.anchor, r.rank - 1] = -(-low_tenths * r.score // 10), high_tenths * r.score // 10
        known = spark.createDataFrame([(r.anchor, r.rank - 1, int(group["id"][r.anchor]), r.id, r.score) for r in near],
                                      "anchor long, window long, anchor_id long, positive_id long, positive_score long")
        far = _searched(trees, {**group, "low": low, "high": high}, negatives, False)
        # positives of one group of anchors: at most ANCHORS times the positives asked for
        named = far.join(F.broadcast(known), ["anchor", "window"])
        out.append(staged(named.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                                       "positive_score", F.col("score").alias("negative_score")), "hard-negatives"))
    return reduce(DataFrame.unionByName, out)
