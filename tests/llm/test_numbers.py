"""Percentiles, cutoffs and groups."""

from __future__ import annotations

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from parcelight.llm import cutoff, groups, percentiles

DAY = datetime(2025, 3, 1)
AREAS = "detection_id long, tile_id string, area_m2 double, detected_at timestamp_ntz, ingested_at timestamp_ntz, g string, value int"


def areas(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], AREAS)


@pytest.mark.parametrize("knots", [100, 200])
def test_rank_error_is_bounded(spark, ws, knots):
    rng = random.Random(1)
    rows = []
    for i in range(12_000):
        tile = "hot" if i % 3 else f"t{i % 7}"
        rows.append((i, tile, round(rng.lognormvariate(2, 1.5), 2), DAY + timedelta(days=i % 5), DAY))
    got = percentiles.percentiles(ws, areas(spark, rows), knots=knots).collect()
    for r in got:
        own = sorted(a for _, t, a, _, _ in rows if t == r.tile_id)
        assert r.n == len(own)
        for name, q in percentiles.TARGETS.items():
            low, high = sum(a < r[name] for a in own) / len(own), sum(a <= r[name] for a in own) / len(own)
            assert low - 1 / knots - 1 / len(own) <= q <= high + 1 / knots + 1 / len(own)


def test_summaries_of_days_combine(spark, ws):
    rng = random.Random(2)
    rows = [(i, "a", float(rng.randint(1, 40)), DAY + timedelta(days=i % 3), DAY) for i in range(300)]
    whole = percentiles.measured(areas(spark, rows))
    parts = [percentiles.day_summaries(percentiles_ws(ws, d), whole.filter(F.col("day") == (DAY + timedelta(days=d)).date()), "tile_id") for d in range(3)]
    merged = percentiles.combine(percentiles_ws(ws, 9), parts[0].unionByName(parts[1]).unionByName(parts[2]), "tile_id").first()
    own = sorted(r[2] for r in rows)
    assert merged.n == 300 and merged.p50 == own[149] and merged.p90 == own[269] and merged.p99 == own[296]  # few values: exact


def percentiles_ws(ws, n):
    from parcelight.runtime import Workspace

    return Workspace(ws.spark, f"day{n}")


def test_what_is_counted(spark, ws):
    nan, inf = float("nan"), float("inf")
    rows = [(1, "a", 5.0, DAY, DAY), (1, "a", 5.0, DAY, DAY + timedelta(days=9)), (2, "a", nan, DAY, DAY), (3, "a", inf, DAY, DAY), (4, "a", 0.0, DAY, DAY), (5, "a", -1.0, DAY, DAY), (6, "a", None, DAY, DAY), (7, "a", 7.0, None, None), (8, None, 9.0, DAY, DAY), (9, None, 9.0, None, DAY), (None, "a", 6.0, DAY, DAY), (None, "a", 6.0, DAY, DAY), (10, "b", -3.0, DAY, DAY)]
    got = {r.tile_id: (r.n, r.p50, r.p99) for r in percentiles.percentiles(ws, areas(spark, rows)).collect()}
    assert got == {"a": (3, 6.0, 7.0), None: (2, 9.0, 9.0)}
    assert percentiles.percentiles(ws, areas(spark, rows).limit(0)).collect() == []


SCORES = "detection_id long, prompt string, score double, ingested_at timestamp_ntz, source string, id int"


def exact(scores, permille):
    k = max(1, math.ceil(len(scores) * permille / 1000))
    return sorted(scores, reverse=True)[k - 1]


def test_cutoffs_are_exact(spark, ws):
    rng = random.Random(3)
    kinds = {"ties": lambda: rng.choice([0.25, 0.5, 0.75]), "fine": rng.random, "one": lambda: 0.5, "low": lambda: rng.random() ** 12, "edges": lambda: rng.choice([0.0, 1.0])}
    scores = {k: [f() for _ in range(60 if k != "fine" else 1500)] for k, f in kinds.items()}
    rows = [(i, p, s) for i, (p, s) in enumerate((p, s) for p, own in scores.items() for s in own)]
    data = spark.createDataFrame(rows, "id long, source string, score double")
    asked = [0, 1, 333, 500, 999, 1000]
    targets = spark.createDataFrame([(p, t) for p in [*scores, "absent"] for t in asked] + [("fine", None), ("fine", 1001), ("fine", -1), ("fine", 500)], "source string, permille int")
    got = {(r.source, r.permille): r for r in cutoff.cutoffs(ws, data, targets).collect()}
    assert len(got) == 6 * 6 + 3
    for p, own in scores.items():
        for t in asked:
            r = got[p, t]
            assert (r.n, r.cutoff) == (len(own), exact(own, t))
            assert r.kept == sum(s >= r.cutoff for s in own)
    assert (got["absent", 500].n, got["absent", 500].cutoff, got["absent", 500].kept) == (0, None, 0)
    for t in (None, 1001, -1):
        assert (got["fine", t].cutoff, got["fine", t].kept, got["fine", t].n) == (None, 0, 1500)


def test_scored_rows(spark):
    at = lambda n: DAY + timedelta(days=n)
    rows = [(1, " Dark  roof panel. ", 0.5, at(1)), (1, "dark roof panel", 0.5, at(2)), (2, "DARK ROOF PANEL", 1.5, at(1)), (3, "x", float("nan"), at(1)), (4, "x", None, at(1)), (5, None, 0.5, at(1)), (None, "x", 0.5, at(1)), (6, "x..", -0.0, None), (7, "x", -0.1, at(1)), (8, "", 1.0, at(1)), (9, "y" * 100_000 + ".", 0.0, at(1))]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCORES)
    got = {r.id: (r.source[:20], r.score) for r in cutoff.scored(df).collect()}
    assert got == {1: ("dark roof panel", 0.5), 6: ("x.", 0.0), 8: ("", 1.0), 9: ("y" * 20, 0.0)}
    assert cutoff.scored(df.limit(0)).count() == 0


def test_kept_and_no_records(spark, ws):
    data = spark.createDataFrame([(1, "a", 0.9), (2, "a", 0.1), (3, "b", 0.2)], "id long, source string, score double")
    targets = spark.createDataFrame([("a", 500), ("c", 100)], "source string, permille int")
    assert [r.id for r in cutoff.kept(data, cutoff.cutoffs(ws, data, targets)).collect()] == [1]
    none = cutoff.cutoffs(ws, data.limit(0), targets)
    assert none.count() == 2 and cutoff.kept(data.limit(0), none).count() == 0


def labels(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in parent}


def graph(seed):
    rng = random.Random(seed)
    long = list(range(10_000, 10_400))
    rng.shuffle(long)
    star = [(500, i) for i in range(600, 800)]
    tail = [(799 + i, 800 + i) for i in range(60)]  # a chain behind the star, longer than the search goes
    return [*zip(long, long[1:]), *star, *tail, *[(i, i + 1) for i in range(20_000, 20_100)], *[(rng.randrange(30_000, 30_060), rng.randrange(30_000, 30_060)) for _ in range(40)]]


@pytest.mark.parametrize("seed", [1, 2])
def test_groups(spark, ws, seed):
    edges = [(min(e), max(e)) for e in graph(seed) if e[0] != e[1]]
    got = groups.groups(ws, spark.createDataFrame(sorted(set(edges)), "u long, v long")).collect()
    assert len(got) == len({r.id for r in got})
    assert {r.id: r.group_id for r in got} == labels(edges)


def test_what_links(spark, ws):
    rows = [(2, 1, "u"), (1, 2, "u"), (1, 2, None), (3, 3, "u"), (4, None, "u"), (None, None, "u"), (1, 99, "u"), (5, 6, "u")]
    matches = spark.createDataFrame(rows, "a long, b long, u string")
    known = spark.createDataFrame([(i, 0) for i in (1, 2, 3, 4, 5, 6, 6)], "id long, v int")
    edges = groups.clean_edges(matches, known, "a", "b", "id")
    assert sorted(map(tuple, edges.collect())) == [(1, 2), (5, 6)]
    assert {(r.id, r.group_id) for r in groups.groups(ws, edges).collect()} == {(1, 1), (2, 1), (5, 5), (6, 5)}
    assert groups.groups(ws, edges.limit(0)).count() == 0
    assert groups.clean_edges(matches, known.limit(0), "a", "b", "id").count() == 0
