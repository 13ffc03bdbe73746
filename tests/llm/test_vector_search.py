"""Exact top-k search and hard negatives against brute force, and on odd vectors."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluiceway.llm import bond, mtree
from sluiceway.llm.bond import mine_negatives
from sluiceway.llm.mtree import exact_top

ROWS = "vec_id long, embedding array<float>, label int, v string, pack int, route string"


def frame(spark, rows):
    """Rows of id, vector and label, with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], ROWS)


def clustered(rng, n, width=8, spread=0.2):
    centres = rng.normal(size=(5, width))
    return (centres[rng.integers(0, 5, n)] + spread * rng.normal(size=(n, width))).astype(np.float32)


def whole(v, factor):
    return [math.floor(factor * float(x)) for x in v]


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def top_by_hand(rows, asked, k):
    """All products, of distinct rows."""
    kept = {(i, tuple(whole(v, 1024))) for i, v in rows if i is not None and usable(v)}
    out = set()
    for own, q in {r for r in kept if r[0] in asked}:
        scores = sorted({(-sum(a * b for a, b in zip(q, x)), i) for i, x in kept if i != own})
        out |= {(own, rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:k])}
    return out


@pytest.mark.parametrize("tree_rows, routes, hot", [(60, 8, 0), (60, 4, 700), (10_000, 8, 0)])
def test_top_is_exact(spark, monkeypatch, tree_rows, routes, hot):
    monkeypatch.setattr(mtree, "PACK", 7)
    rng = np.random.default_rng(tree_rows + hot)
    x = clustered(rng, 1_500)
    x[:hot] = x[0]
    rows = [(i, [float(e) for e in v], 0) for i, v in enumerate(x)]
    got = exact_top(frame(spark, rows).repartition(3), frame(spark, rows).where("vec_id % 50 = 0"), 10, tree_rows=tree_rows, routes=routes)
    assert {tuple(r) for r in got.collect()} == top_by_hand([r[:2] for r in rows], set(range(0, 1_500, 50)), 10)
    assert dict(got.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}


def test_bounds_save_products():
    rng = np.random.default_rng(1)
    x = np.floor(1024 * clustered(rng, 6_000, spread=0.05)).astype(np.float64)
    metric = mtree.Metric(float((x * x).sum(1).max()), np.float64)
    ids = np.arange(len(x))
    pivot = metric.lifted(x[:1])[0]
    pages = dict(enumerate(mtree.build(x, ids, pivot, metric)))
    assert sum(len(p.ids) for p in pages.values()) == len(x) and max(len(p.objects) for p in pages.values()) <= mtree.PAGE
    computed = []
    for own in range(0, 6_000, 300):
        scores = x @ x[own]
        scores[own] = -np.inf
        order = np.lexsort((ids, -scores))[:10]
        near = float(metric.to_products(float((x[own] ** 2).sum()), scores[:1] if own else np.array([x[0] @ x[0]]))[0])
        best, n = mtree.search(pages, x[own], near, own, mtree.NO_FLOOR, 10, metric)
        assert best == [(int(scores[i]), int(i)) for i in order]
        computed.append(n)
    assert np.mean(computed) < 0.5 * len(x)


def test_radii_cover_what_lies_below():
    rng = np.random.default_rng(2)
    x = np.floor(1024 * clustered(rng, 2_000)).astype(np.float64)
    metric = mtree.Metric(float((x * x).sum(1).max()), np.float64)
    pages = mtree.build(x, np.arange(len(x)), metric.lifted(x[:1])[0], metric, 16)

    def below(at):
        page = pages[at]
        return page.objects if page.leaf else np.concatenate([below(c) for c in page.child])

    for page in pages:
        if not page.leaf:
            for o, r, c in zip(page.objects, page.radius, page.child):
                far = metric.lifted(below(int(c))) - metric.lifted(o[None])
                assert np.sqrt((far**2).sum(1)).max() <= r + 1e-6


ODD = [
    (1, None), (2, []), (3, [0.5, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (None, [1.0, 1.0]), (0, [1.0, 2.0]), (0, [1.0, 2.0]),
    (100, [0.0, 0.0]), (6, [1.0, 2.0]), (6, [2.0, 1.0]), (7, [-1.0, 0.5]), (8, [1.0, 2.0]), (9, [1.0, 2.0, 3.0]), (200, [2.0e5, -2.0e5]),
]


def test_top_of_odd_rows(spark):
    rows = [(i, v, 0) for i, v in ODD]
    kept = [(i, v) for i, v in ODD if v is None or len(v) != 3]
    data = frame(spark, rows)
    got = {tuple(r) for r in exact_top(data, data.where("vec_id % 100 = 0")).collect()}
    assert got == top_by_hand(kept, {0, 100, 200}, 10)
    none = data.where("false")
    assert exact_top(none, none).collect() == [] and exact_top(data, none).collect() == [] and exact_top(data.where("vec_id < 6 and vec_id > 0"), none).collect() == []


def negatives_by_hand(rows, asked, factor=256):
    kept = sorted({(i, lab, tuple(whole(v, factor))) for i, v, lab in rows if i is not None and lab is not None and usable(v)})
    out = []
    for own, label, q in kept:
        if own not in asked:
            continue
        scores = sorted((-sum(a * b for a, b in zip(q, x)), i, lab == label) for i, lab, x in kept if i != own)
        for s, i, same in [r for r in scores if r[2]][:5]:
            low, high = 50 * -s, 95 * -s
            far = [(t, j) for t, j, alike in scores if not alike and low <= 100 * -t <= high][:3]
            out += [(own, i, rank + 1, j, -s, -t) for rank, (t, j) in enumerate(far)]
    return sorted(out)


def mined(data, **more):
    return sorted(tuple(r) for r in mine_negatives(data, F.col("vec_id") % 50 == 0, **more).collect())


@pytest.mark.parametrize("hot", [0, 500])
def test_negatives_are_exact(spark, hot):
    rng = np.random.default_rng(hot)
    x = clustered(rng, 1_200, 12, 0.6)
    x[:hot] = x[0]
    labels = rng.integers(0, 4, 1_200)
    rows = [(i, [float(e) for e in v], int(lab)) for i, (v, lab) in enumerate(zip(x, labels))]
    assert mined(frame(spark, rows).repartition(5), block_rows=150, pack_anchors=5) == negatives_by_hand(rows, set(range(0, 1_200, 50)))


def test_bounds_save_values():
    rng = np.random.default_rng(6)
    x = np.floor(256 * clustered(rng, 2_000, 64, 0.1)).astype(np.float64).T
    row = type("Row", (), {})()
    row.ids, row.labels = np.arange(2_000).tobytes(), np.zeros(2_000, np.int64).tobytes()
    row.columns, row.least, row.most = [c.tobytes() for c in x], x.min(1).tobytes(), x.max(1).tobytes()
    block = bond.Block(row, np.float64)
    read = []

    def keep(low, high):
        return high >= np.partition(low, len(low) - 5)[len(low) - 5]

    for own in range(0, 2_000, 200):
        alive, scores, n = block.scan(x[:, own].copy(), np.arange(2_000), keep)
        want = np.sort(x.T @ x[:, own])[-5:]
        assert np.sort(scores)[-5:].tolist() == want.tolist()
        read.append(n)
    assert np.mean(read) < 0.9 * x.size


def test_negatives_of_odd_rows(spark):
    rng = random.Random(9)
    rows = [(i, v, rng.choice([0, 1, None])) for i, v in ODD if v is None or len(v) != 3] * 2 + [(50, [1.0, 1.0], 0), (51, [2.0, 1.0], 0), (52, [1.0, 0.5], 1), (50, [0.5, 0.25], 1)]
    assert mined(frame(spark, rows)) == negatives_by_hand(rows, {0, 50, 100, 200})
    none = frame(spark, rows).where("false")
    assert mined(none) == [] and mined(frame(spark, [(50, [1.0], 1)])) == []
    # below zero no score lies in the window; at zero the score itself does
    signs = [(50, [1.0, 0.0], 0), (1, [-1.0, 0.0], 0), (2, [-0.6, 0.0], 1), (3, [0.0, 1.0], 0), (4, [0.0, -1.0], 1)]
    assert mined(frame(spark, signs)) == negatives_by_hand(signs, {50})
