from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelight.functions.points import point_srid, point_xy
from parcelight.operators import near

SCHEMA = "id long, geometry string, loaded_at timestamp_ntz, x string, cell int"


def brute(points, radius):
    return {(min(a, b), max(a, b)) for i, (a, ax, ay) in enumerate(points) for b, bx, by in points[i + 1 :] if (ax - bx) ** 2 + (ay - by) ** 2 <= radius * radius}


@pytest.mark.parametrize(
    "text, xy",
    [
        ("POINT (1.5 -2)", (1.5, -2.0)),
        ("SRID=25831;POINT(3 4)", (3.0, 4.0)),
        ("Point ( 1.250000  2.500000 )", (1.25, 2.5)),
        ("POINT Z (1 2 3)", (1.0, 2.0)),
        ("MULTIPOINT ((7 8))", (7.0, 8.0)),
        ("MULTIPOINT (7 8)", (7.0, 8.0)),
        ('{"type":"Point","coordinates":[1e2, 5.5, 3]}', (100.0, 5.5)),
        ('{"coordinates": [1, 2], "type": "Point"}', (1.0, 2.0)),
        ("POINT EMPTY", None),
        ("POINT (0 0)", None),
        ("POINT (0.0 0)", None),
        ("POINT (NaN 1)", None),
        ("", None),
        ("nonsense", None),
        (None, None),
        ("x" * 100_000, None),
    ],
)
def test_point_texts(spark, text, xy):
    x, y = point_xy(F.col("g"))
    r = spark.createDataFrame([(text,)], "g string").select(x.alias("x"), y.alias("y"), point_srid(F.col("g")).alias("s")).first()
    assert ((r.x, r.y) if r.x is not None else None) == xy
    assert r.s == (25831 if text and text.startswith("SRID") else None)


def test_locations_take_the_latest_located_delivery(spark):
    from datetime import datetime

    day = lambda n: datetime(2024, 1, n)
    rows = [(1, "POINT (1 1)", day(1), "q", 1), (1, "POINT (2 2)", day(2), None, 2), (1, None, day(3), None, None), (2, "POINT EMPTY", day(1), None, None), (None, "POINT (5 5)", day(1), None, None), (3, "POINT (4 4)", None, None, None), (3, "POINT (4 4)", None, None, None)]
    assert sorted(map(tuple, near.locations(spark.createDataFrame(rows, SCHEMA)).collect())) == [(1, 2.0, 2.0), (3, 4.0, 4.0)]


@pytest.mark.parametrize("cell_points", [20, 60, 10_000])
def test_pairs_match_brute_force(spark, ws, cell_points):
    rng = np.random.default_rng(3)
    spread = rng.integers(0, 800, (150, 2)) / 4
    crowd = 40 + rng.integers(0, 60, (250, 2)) / 4  # a third and more of all points in one place
    line = np.column_stack([rng.integers(0, 4000, 60) / 4, np.full(60, 100.0)])
    xy = np.vstack([spread, crowd, line, crowd[:5]])
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(xy)]
    df = spark.createDataFrame([(*p, "extra") for p in points], "id long, x double, y double, cell string")
    got = [tuple(r) for r in near.pairs_within(ws, df, 10.0, cell_points).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(points, 10.0)


def test_distance_counts_exactly_at_the_radius(spark, ws):
    df = spark.createDataFrame([(1, 0.0, 10.0), (2, 10.0, 10.0), (3, 0.0, 20.0), (4, 0.0, 20.0625)], "id long, x double, y double")
    assert {tuple(r) for r in near.pairs_within(ws, df, 10.0).collect()} == {(1, 2), (1, 3), (3, 4)}


def test_no_and_single_points(spark, ws):
    df = spark.createDataFrame([], "id long, x double, y double")
    assert near.pairs_within(ws, df, 10.0).collect() == []
    df = spark.createDataFrame([(1, 0.0, 1.0)], "id long, x double, y double")
    assert near.pairs_within(ws, df, 10.0).collect() == []
