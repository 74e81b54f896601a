from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelight.operators.components import components
from parcelight.operators.rangesort import running_sums
from parcelight.operators.suppress import blobs, dilated_area, dissolved, nms


def labels(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in parent}


def test_components(spark, ws):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(1000, 1060)]
    ids = list(range(2000, 2060))
    rng.shuffle(ids)
    mixed = list(zip(ids, ids[1:]))
    edges = [*chain, *mixed, (5, 5), (None, 1), (7, None), (9, 8), (8, 9), (9, 8), *[(50, i) for i in range(51, 90)]]
    got = components(ws, spark.createDataFrame(edges, "u long, v long"))
    assert {r.id: r.group_id for r in got.collect()} == labels(edges)
    assert components(ws, spark.createDataFrame([], "u long, v long")).collect() == []


def test_running_sums(spark, ws):
    rng = random.Random(2)
    rows = [(g, v, rng.randint(1, 5), 0) for g in ("hot", "b", None) for v in range(300 if g == "hot" else 20)]
    df = spark.createDataFrame(rows, "g string, v int, n long, running_ int").repartition(5)
    got = {(r.g, r.v): (r.running, r.total) for r in running_sums(ws, df, ["g"], ["v"], "n", "sums").collect()}
    assert len(got) == len(rows)
    for g in ("hot", "b", None):
        own, total = sorted((v, n) for k, v, n, _ in rows if k == g), 0
        for v, n in own:
            total += n
            assert got[g, v][0] == total
        assert all(got[g, v][1] == total for v, _ in own)


BOXES = "id long, tile int, x0 double, y0 double, x1 double, y1 double, score double"


def iou(a, b):
    w, h = min(a[4], b[4]) - max(a[2], b[2]), min(a[5], b[5]) - max(a[3], b[3])
    inter = max(0, w) * max(0, h)
    return inter, (a[4] - a[2]) * (a[5] - a[3]) + (b[4] - b[2]) * (b[5] - b[3]) - inter


def greedy(boxes, thr, guard=False):
    kept = []
    for b in sorted(boxes, key=lambda b: (-(b[6] if b[6] is not None else -1e300), b[0])):
        above = [k for k in kept if k[1] == b[1] and iou(k, b)[0] > thr * iou(k, b)[1] and (not guard or k[0] < b[0])]
        if not above:
            kept.append(b)
    return {b[0] for b in kept}


@pytest.mark.parametrize("mode", ["greedy", "index_guard"])
def test_suppression_is_greedy(spark, ws, mode):
    rng = random.Random(7)
    boxes = []
    for i in range(220):
        x, y = rng.randrange(40) / 4, rng.randrange(40) / 4
        boxes.append((i, i % 2, x, y, x + rng.randint(4, 12) / 4, y + rng.randint(4, 12) / 4, rng.choice([0.25, 0.5, 0.75, None])))
    df = spark.createDataFrame(boxes, BOXES)
    for thr in (0.0, 0.3):
        assert {r.id for r in nms(ws, df, thr, ["tile"], mode).collect()} == greedy(boxes, thr, mode == "index_guard")


def test_suppression_fixtures(spark, ws):
    same = spark.createDataFrame([(1, 0, 0.0, 0.0, 2.0, 2.0, 0.5), (2, 0, 0.0, 0.0, 2.0, 2.0, 0.9)], BOXES)
    assert [r.id for r in nms(ws, same, 0.3).collect()] == [2]
    assert sorted(r.id for r in nms(ws, same, 0.3, mode="index_guard").collect()) == [1, 2]
    third = spark.createDataFrame([(1, 0, 0.0, 0.0, 2.0, 1.0, 0.5), (2, 0, 1.0, 0.0, 3.0, 1.0, 0.9)], BOXES)  # an IoU of a third
    assert nms(ws, third, 1 / 3).count() == 2
    assert nms(ws, third, 0.33).count() == 1
    assert nms(ws, same.limit(0), 0.3).count() == 0
    with pytest.raises(ValueError):
        nms(ws, same, 0.3, mode="other")


def test_dissolving(spark, ws):
    df = spark.createDataFrame([(1, 0, 0.0, 0.0, 1.0, 1.0, 0.5), (2, 0, 2.5, 0.0, 3.5, 1.0, 0.9), (3, 0, 50.0, 0.0, 51.0, 1.0, None)], BOXES)
    found = lambda d: {r.id: r.blob_id for r in dissolved(ws, df, d).collect()}
    assert found(1.0) == {1: 1, 2: 1, 3: 3}  # gap 1.5 <= 2 x 1
    assert found(0.5) == {1: 1, 2: 2, 3: 3}
    assert found(0.0) == {1: 1, 2: 2, 3: 3}
    rows = {r.blob_id: r for r in blobs(dissolved(ws, df, 1.0), 1.0).collect()}
    assert rows[1].n == 2 and rows[1].score == 0.9 and (rows[1].x0, rows[1].x1) == (-1.0, 4.5)
    assert abs(rows[3].area - (1 + 4 + np.pi)) < 1e-9
    assert blobs(dissolved(ws, df, 1.0), 1.0, min_area=10).count() == 1


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(*[st.integers(0, 20)] * 2, *[st.integers(1, 8)] * 2), min_size=1, max_size=6), st.sampled_from([0.0, 0.5, 1.5]))
def test_dilated_area_against_a_raster(boxes, d):
    a = np.array([(x / 2, y / 2, (x + w) / 2, (y + h) / 2) for x, y, w, h in boxes])
    step = 0.05
    g = np.arange(-2, 16, step) + step / 2
    x, y = np.meshgrid(g, g)
    inside = np.zeros(x.shape, bool)
    for x0, y0, x1, y1 in a:
        inside |= np.maximum(np.maximum(x0 - x, 0), x - x1) ** 2 + np.maximum(np.maximum(y0 - y, 0), y - y1) ** 2 <= d * d
    assert abs(dilated_area(*a.T, d) - inside.sum() * step**2) < 0.02 * inside.sum() * step**2 + 0.05


@pytest.mark.parametrize("limit", [5_000_000, 20])
def test_a_chain_of_2000_boxes(spark, ws, monkeypatch, limit):
    """Each box overlaps the next and ranks above it, so every second one is kept; also where groups are too large for a task."""
    from parcelight.operators import suppress

    n = 2_000 if limit > 2_000 else 24  # rounds take a job for every second box
    monkeypatch.setattr(suppress, "GROUP_PAIRS", limit)
    boxes = spark.range(n).selectExpr("id", "id * 1.0 as x0", "0.0 as y0", "id + 1.5 as x1", "1.0 as y1", "1 - id / 10000 as score").selectExpr("id", *[f"double({c}) as {c}" for c in ("x0", "y0", "x1", "y1", "score")])
    assert sorted(r.id for r in nms(ws, boxes, 0.1).select("id").collect()) == list(range(0, n, 2))
    assert dissolved(ws, boxes, 0.1).select("blob_id").distinct().count() == 1
