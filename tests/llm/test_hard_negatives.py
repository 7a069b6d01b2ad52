"""Hard negatives against plain loops: grouped, even, repeated, odd and huge vectors."""

import math

import numpy as np
import pytest

from tideline.llm import hard_negatives
from tideline.llm.hard_negatives import cover_tree

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, every, k_pos=5, k_neg=10):
    good = sorted({(i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v, label in rows
                   if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for i, label, v in good:
        if i % every:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in good if j != i))
        for s, j, _ in [x for x in scored if x[2] == label][:k_pos]:
            hits = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:k_neg]
            out += [(i, j, r + 1, x[1], -s, -x[0]) for r, x in enumerate(hits)]
    return sorted(out)


def groups(seed, n, dims, centers, noise):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(centers, dims))
    which = draw.integers(0, centers, n)
    vectors = middle[which] + noise * draw.normal(size=(n, dims))
    return [(i, [float(x) for x in v], int(c % 6)) for i, (v, c) in enumerate(zip(vectors.astype(np.float32), which))]


def test_cover_tree_holds_what_it_says():
    for points in (np.zeros((0, 3)), np.zeros((40, 3)), np.floor(256 * np.array([v for _, v, _ in groups(1, 900, 5, 12, 0.05)]))):
        tree = cover_tree(points)
        assert sorted(tree["order"].tolist()) == list(range(len(points)))
        if not len(points):
            continue
        rows = points[tree["order"]]
        norms = (rows ** 2).sum(axis=1)
        top = max(norms.max(), 1.0)
        sphere = np.column_stack([rows, np.sqrt(np.maximum(top - norms, 0))]) / np.sqrt(top)
        for node in range(len(tree["center"])):
            some = sphere[tree["first"][node]:tree["stop"][node]]
            away = np.arccos(np.clip(some @ sphere[tree["center"][node]], -1, 1))
            assert away.max() <= tree["angle"][node] + 1e-7
            assert tree["first"][node] <= tree["center"][node] < tree["stop"][node]
            if tree["parent"][node] >= 0:
                p = tree["parent"][node]
                assert tree["level"][node] == tree["level"][p] + 1 and tree["first"][p] <= tree["first"][node] and tree["stop"][node] <= tree["stop"][p]
    assert tree["level"].max() >= 2
    leaves = np.flatnonzero(tree["leaf"])
    assert sum(tree["stop"][leaves] - tree["first"][leaves]) == len(points)


@pytest.mark.parametrize("noise, block, anchors", [(0.05, 2048, 8192), (0.05, 64, 7), (3.0, 100, 8192)])
def test_against_plain_loops(spark, monkeypatch, noise, block, anchors):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)
    rows = groups(7, 600, 6, 12, noise)
    got = hard_negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(5), every=20)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, 20)


def test_trees_leave_rows_out():
    """On grouped vectors most rows are never verified, and the result is that of all of them."""
    rows = groups(3, 4000, 8, 60, 0.03)
    points = np.floor(256 * np.array([v for _, v, _ in rows]))
    tree = cover_tree(points)
    block = {**tree, "label": 1, "ids": tree["order"], "points": points[tree["order"]]}
    some = points[:50]
    low = np.array([[int(0.5 * (p @ p))] for p in some])
    anchors = {"id": np.full(50, -1), "label": np.zeros(50), "vectors": some, "low": low, "high": np.array([[int(0.9 * (p @ p))] for p in some])}
    best = hard_negatives.Best(50, 1, 10)
    verified, pairs = hard_negatives.search_block(best, anchors, block, same_label=False)
    assert pairs == 200_000 and verified < pairs / 4
    for i in range(50):
        scores = (points @ some[i]).astype(int)
        inside = np.flatnonzero((scores >= low[i, 0]) & (scores <= anchors["high"][i, 0]))
        order = sorted(inside, key=lambda j: (-scores[j], j))[:10]
        assert [(s, j) for s, j in zip(best.scores[i], best.ids[i]) if s != hard_negatives.NONE] == [(scores[j], j) for j in order]


def test_odd_rows(spark):
    """Rows that take no part, repeated rows, shared ids, ties, other lengths, empty and huge vectors, extra columns."""
    nan, inf = float("nan"), float("inf")
    base = [1.0, 0.5, 0.25]
    rows = [(0, base, 1), (0, base, 1), (100, base, 1), (1, base, 1), (2, base, 1), (3, [1.0, nan, 0.0], 1), (4, [1.0, inf, 0.0], 2), (5, None, 2), (6, base, None),
            (7, [0.5, 0.25, 0.125], 9), (8, [0.5, 0.25, None], 2), (None, base, 2), (9, [0.5, 0.25, 0.125], 2), (10, [0.5, 0.25, 0.125], 2), (10, [0.5, 0.25, 0.125], 2),
            (10, [0.75, 0.25, 0.125], 2), (11, [0.75, 0.25], 3), (12, [], 3), (13, [0.5] * 5, 3), (200, [], 4), (16, [], 4), (300, [3e38, 0.0, 0.0], 5), (15, [3e37, 0.0, 0.0], 5)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as score", "2 as `rank`", "'x' as anchor", "3 as anchor_id", "4 as __h", "5 as vector")
    got = sorted(tuple(r) for r in hard_negatives.hard_negatives(df).collect())
    assert [r for r in got if r[0] != 300] == [r for r in plain(rows, 100) if r[0] != 300]
    assert any(r[0] == 200 for r in got) and {r[4] for r in got if r[0] == 300} <= {1 << 62}
    for none in (df.where("false"), df.where("vec_id = 1"), df.where("vec_id = 0")):
        assert hard_negatives.hard_negatives(none).collect() == []
