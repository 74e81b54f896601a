from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelight.functions import polygons as P

SQUARE = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))"
TURNED = "POLYGON((0 0,0 4,4 4,4 0,0 0))"
HOLE = "POLYGON ((0 0, 6 0, 6 6, 0 6, 0 0), (1 1, 1 5, 5 5, 5 1, 1 1))"
CONCAVE = "POLYGON ((0 0, 6 0, 6 6, 3 1, 0 6, 0 0))"
TWO = "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 1, 0 0)), ((5 5, 8 5, 8 7, 5 7, 5 5)))"
TILTED = "POLYGON ((3 -1, 7 3, 5 5, 1 1, 3 -1))"
SHAPES = [SQUARE, TURNED, HOLE, CONCAVE, TWO, TILTED]


def rings(text):
    import re

    return [[[tuple(map(float, c.split()[:2])) for c in r.split(",")] for r in re.findall(r"\(([^()]+)\)", p)] for p in re.findall(r"\(\s*\([^()]*\)(?:\s*,\s*\([^()]*\))*\s*\)", text)]


def covered(text, x, y):
    """Even-odd rule on a grid of points."""
    out = np.zeros(x.shape, bool)
    for ring in (r for p in rings(text) for r in p):
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            if ay != by:
                out ^= ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay) + ax)
    return out


def ask(spark, rows, schema, **columns):
    df = spark.createDataFrame(rows, schema)
    return df.select(*[c.alias(n) for n, c in columns.items()]).collect()


@pytest.mark.parametrize("text", [None, "", "POLYGON EMPTY", "MULTIPOLYGON EMPTY", "POINT (1 2)", "POLYGON ((0 0, 1 1))", "POLYGON ((0 0, x 1, 2 2, 0 0))", "POLYGON ((0 0, 1 NaN, 2 2, 0 0))", "nonsense", '{"type":"Point","coordinates":[1,2]}', '{"type":"Polygon"}', "(" * 50_000])
def test_what_has_no_area_is_null(spark, text):
    assert ask(spark, [(text,)], "g string", p=P.polygons(F.col("g")))[0].p is None


def test_forms_of_one_geometry(spark):
    forms = [SQUARE, "SRID=25831;POLYGON Z ((0 0 9, 4 0 9, 4 4 9, 0 4 9, 0 0 9))", "multipolygon(((0 0,4 0,4 4,0 4)))", '{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,4],[0,0]]]}', '{"coordinates":[[[[0,0],[4,0],[4,4],[0,4],[0,0]]]],"type":"MultiPolygon"}', TURNED]
    e = P.edges(P.polygons(F.col("g")))
    got = ask(spark, [(f,) for f in forms], "g string", a=P.area(e, F.lit(0.0), F.lit(0.0)), n=F.size(e), w=P.bounds(e).width)
    assert {(r.a, r.n, r.w) for r in got} == {(16.0, 4, 4.0)}


def test_area_and_centroid(spark):
    e = P.edges(P.polygons(F.col("g")))
    got = ask(spark, [(s,) for s in SHAPES], "g string", a=P.area(e, F.lit(1.0), F.lit(1.0)), c=F.struct(*P.centroid(e, F.lit(1.0), F.lit(1.0))))
    assert [r.a for r in got] == [16, 16, 20, 21, 7, 16]
    assert tuple(got[0].c) == (2, 2) and tuple(got[2].c) == (3, 3)


@pytest.mark.parametrize("text", SHAPES)
def test_points_in_rings(spark, text):
    points = [(text, i / 2 + 0.25, j / 2 + 0.25) for i in range(-3, 18) for j in range(-3, 16)]
    e = P.edges(P.polygons(F.col("g")))
    got = ask(spark, points, "g string, x double, y double", i=P.inside(e, F.col("x"), F.col("y")), d=P.distance(e, F.col("x"), F.col("y")))
    x, y = (np.array([p[k] for p in points]) for k in (1, 2))
    want = covered(text, x, y)
    on = np.array([g.d == 0 and not g.i for g in got])  # on an edge
    assert [g.i for g, o in zip(got, on) if not o] == list(want[~on])
    segments = [(a, b) for p in rings(text) for r in p for a, b in zip(r, r[1:] + r[:1]) if a != b]
    for (_, px, py), g, w in zip(points, got, want):
        if not w:
            t = [max(0, min(1, ((px - a[0]) * (b[0] - a[0]) + (py - a[1]) * (b[1] - a[1])) / math.dist(a, b) ** 2)) for a, b in segments]
            assert abs(g.d - min(math.hypot(px - a[0] - k * (b[0] - a[0]), py - a[1] - k * (b[1] - a[1])) for (a, b), k in zip(segments, t))) < 1e-9


def test_a_point_on_an_edge_is_not_inside(spark):
    e = P.edges(P.polygons(F.col("g")))
    got = ask(spark, [(SQUARE, 0.0, 2.0), (SQUARE, 4.0, 4.0), (SQUARE, 2.0, 4.0), (SQUARE, 2.0, 2.0)], "g string, x double, y double", i=P.inside(e, F.col("x"), F.col("y")))
    assert [r.i for r in got] == [False, False, False, True]


def test_overlap_matches_a_raster(spark):
    step = 1 / 64
    x, y = np.meshgrid(np.arange(-2, 9, step) + step / 2, np.arange(-2, 9, step) + step / 2)
    pairs = [(a, b) for a in SHAPES for b in SHAPES]
    a, b = P.edges(P.polygons(F.col("a"))), P.edges(P.polygons(F.col("b")))
    got = ask(spark, pairs, "a string, b string", o=P.overlap(a, b, F.lit(-2.0), F.lit(-2.0)), m=P.meets(a, b), g=P.gap(a, b))
    for (s, t), r in zip(pairs, got):
        want = (covered(s, x, y) & covered(t, x, y)).sum() * step * step
        assert abs(r.o - want) < 0.1, (s, t, r.o, want)
        assert r.m == (r.g == 0) and (r.m or want == 0)


def test_gap(spark):
    a, b = P.edges(P.polygons(F.col("a"))), P.edges(P.polygons(F.col("b")))
    far = "POLYGON ((7 8, 9 8, 9 9, 7 9, 7 8))"
    inner = "POLYGON ((2 2, 3 2, 3 3, 2 3, 2 2))"
    got = ask(spark, [(SQUARE, far), (HOLE, inner), (SQUARE, inner), (SQUARE, "POLYGON ((4 4, 5 4, 5 5, 4 4))")], "a string, b string", g=P.gap(a, b))
    assert [r.g for r in got] == [5.0, 1.0, 0.0, 0.0]


def test_writing(spark):
    p = P.polygons(F.col("g"))
    got = ask(spark, [(s,) for s in (SQUARE, HOLE, TWO)], "g string", same=P.polygons(P.to_wkt(p)) == p, json=P.polygons(P.to_json(p)) == p, moved=P.to_wkt(P.moved(p, F.lit(1.0), F.lit(2.0))))
    assert all(r.same and r.json for r in got)
    assert got[0].moved == "POLYGON ((1.0 2.0, 5.0 2.0, 5.0 6.0, 1.0 6.0, 1.0 2.0))"
