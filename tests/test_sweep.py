from __future__ import annotations

import random

import pytest

from parcelight.operators import sweep
from parcelight.plans import detection_queries, source_queries, vector_queries
from parcelight.plans.domain import Domain

from .conftest import DATA

RUNS = {k: v for m in (vector_queries, detection_queries, source_queries) for k, v in m.queries().items()}

BOXES = "id long, tile string, x0 double, y0 double, x1 double, y1 double"


def boxes(seed: int, n: int, first: int = 0) -> list[tuple]:
    """Small boxes in a hot tile, some of hundreds of metres and a few of many kilometres, across the bounds of cells."""
    rng = random.Random(seed)
    out = []
    for i in range(first, first + n):
        w = rng.choice([0.0, 2.0, 6.0, 6.0, 20.0, 400.0 if i % 11 == 0 else 4.0, 9_000.0 if i % 43 == 0 else 3.0])
        x, y = rng.randrange(-200, 900) / 2, rng.randrange(-200, 900) / 2
        out.append((i, rng.choice(["a", "a", "b", None]), x, y, x + w, y + rng.choice([w, 3.0])))
    return [*out, (first + n, "a", None, 0.0, 1.0, 1.0), (first + n + 1, "a", float("-inf"), 0.0, float("inf"), 1.0), (first + n + 2, "a", float("nan"), 0.0, 1.0, 1.0)]


def touching(a: list[tuple], b: list[tuple], grow: float, same: bool) -> list[tuple]:
    ok = [r for r in a if r[2] is not None and abs(r[2]) < float("inf")], [r for r in b if r[2] is not None and abs(r[2]) < float("inf")]
    near = lambda p, q: all(p[k] - grow <= q[k + 2] + grow and q[k] - grow <= p[k + 2] + grow for k in (2, 3))
    return sorted((p[0], q[0]) for p in ok[0] for q in ok[1] if near(p, q) and (not same or p[1] == q[1] is not None))


def ids(rows, i, j):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([rows.column("id").take(pa.array(k)) for k in (i, j)], ["i", "j"])


@pytest.mark.parametrize(("grow", "within", "few"), [(0.0, [], 10_000), (1.0, ["tile"], 10_000), (1.0, [], 0)])
def test_pairs_of_two_tables(spark, monkeypatch, grow, within, few):
    monkeypatch.setattr(sweep, "FEW", few)
    a, b = boxes(1, 300), boxes(2, 250, 1000)
    got = sweep.near_pairs(spark.createDataFrame(a, BOXES), spark.createDataFrame(b, BOXES), ids, "i long, j long", within, grow)
    assert sorted(map(tuple, got.collect())) == touching(a, b, grow, bool(within))


@pytest.mark.parametrize(("grow", "within"), [(0.0, ["tile"]), (1.0, [])])
def test_pairs_of_a_table_with_itself(spark, grow, within):
    a = boxes(3, 400)
    got = sweep.near_pairs(spark.createDataFrame(a, BOXES), None, ids, "i long, j long", within, grow)
    assert sorted(tuple(sorted(p)) for p in got.collect()) == [(p, q) for p, q in touching(a, a, grow, bool(within)) if p < q]


@pytest.mark.parametrize("name", ["agg_intersect_count", "pipeline_phase4", "semi_building", "filter_building", "pipeline_phase3"])
def test_buildings_are_not_broadcast(spark, name):
    """Rows spread over cells are more than the files' sizes tell, so a join of them may not be one with a broadcast side."""
    plan = RUNS[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "_cell" in line]
    assert joins == []


def test_a_large_box_makes_no_square_of_small_ones(spark, ws):
    """30000 small boxes in one tile beside one of 500 m: only pairs of the large one are found in its cells."""
    import time

    from parcelight.operators.suppress import nms

    rows = spark.range(30_000).selectExpr("id", "'a' as tile", "2.5D * (id % 200) as x0", "2.5D * floor(id / 200) as y0", "2.5D * (id % 200) + 2 as x1", "2.5D * floor(id / 200) + 2 as y1", "0.5D as score")
    large = spark.createDataFrame([(30_000, "a", 0.0, 0.0, 500.0, 375.0, 0.4)], rows.schema)
    began = time.time()
    assert nms(ws, rows.unionAll(large), 0.5, ["tile"]).count() == 30_001
    assert time.time() - began < 20


@pytest.mark.parametrize("distance", [0.0, 2.0])
def test_buildings_near_masks_are_not_broadcast(spark, distance):
    plan = vector_queries.buildings_of(Domain(spark, DATA), distance)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [_cell" not in plan and "BroadcastHashJoin [knownfloatingpointnormalized(_cell" not in plan and "_cell" not in "".join(line for line in plan.splitlines() if "Join" in line)


def test_joined_boxes_are_not_compared_again(spark, ws, monkeypatch):
    """Polygons over each other have a square of pairs, of which those that join the blob are enough."""
    from parcelight.operators import suppress

    compared = []
    inner = suppress.within_distance
    rows = spark.range(300).selectExpr("id", "1 as tile", "id / 100 as x0", "0.0D as y0", "id / 100 + 5 as x1", "5.0D as y1", "0.5D as score").repartition(1)
    batches = []

    def near_pairs(left, right, compare, schema, within, grow):
        batches.append(compare)
        return spark.createDataFrame([], schema)

    monkeypatch.setattr(suppress, "near_pairs", near_pairs)
    suppress.dissolved(ws, rows, 0.5, ["tile"])
    monkeypatch.setattr(suppress, "within_distance", lambda r, i, j, *a: compared.append(len(i)) or inner(r, i, j, *a))
    i, j = (k for k in __import__("numpy").triu_indices(300, 1))
    out = batches[0](rows.toArrow().to_batches()[0], i, j)
    assert sum(compared) < len(i) / 4 and {0, *out.column("v").to_pylist()} == set(range(300))


def test_a_crowded_blob_takes_no_square(spark, ws):
    """A blob of 40000 boxes over several cells: strips over all of its boxes would take minutes."""
    import time

    from parcelight.operators.suppress import blobs, dissolved

    rows = spark.range(40_000).selectExpr("id", "cast(1 as int) as tile", "1.0D * (id % 200) as x0", "1.0D * floor(id / 200) as y0", "1.0D * (id % 200) + 1.5 as x1", "1.0D * floor(id / 200) + 1.5 as y1", "0.5D as score")
    began = time.time()
    (row,) = blobs(dissolved(ws, rows, 0.25, ["tile"]), 0.25, ["tile"]).collect()
    w = 200.5
    assert (row.blob_id, row.n) == (0, 40_000) and abs(row.area - (w * w + w + 3.141592653589793 / 16)) < 1e-6
    assert time.time() - began < 60


def test_shapes_come_with_the_pairs(spark, monkeypatch):
    """The sink of buildings joins its hits with no table of all masks, which would be shuffled once more."""
    from parcelight.sources import geojson

    features = []
    inner = geojson.documents
    monkeypatch.setattr(geojson, "documents", lambda rows, key: features.append(rows) or inner(rows, key))
    RUNS["sink_geojson_building"](spark, DATA)
    plan = features[0]._jdf.queryExecution().optimizedPlan().toString()
    assert [line for line in plan.splitlines() if "Join" in line and "LeftSemi" not in line] == []


def test_pairs_by_shapes_are_those_by_edges(spark):
    """Parts and holes too: a footprint in the middle of a hole of 8 m is 3.5 m from the area, and touches a second part."""
    from pyspark.sql import functions as F

    from parcelight.functions import polygons

    ring = lambda x, y, w: "(" + ", ".join(f"{a} {b}" for a, b in ((x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y))) + ")"
    texts = [(1, f"POLYGON ({ring(0, 0, 20)}, {ring(6, 6, 8)})"), (2, f"MULTIPOLYGON (({ring(0, 0, 2)}), ({ring(9, 9, 2)}))"), (3, f"POLYGON ({ring(300, 0, 2)})")]
    cut = spark.createDataFrame(texts, "id long, t string").withColumn("shape", polygons.polygons(F.col("t"))).withColumn("edges", polygons.edges(F.col("shape")))
    box = polygons.bounds(F.col("edges"))
    left = cut.select("id", "shape", "edges", *box.columns())
    right = spark.createDataFrame([(7, f"POLYGON ({ring(9.5, 9.5, 1)})"), (8, f"POLYGON ({ring(303, 0, 1)})")], "id long, t string").withColumn("shape", polygons.polygons(F.col("t"))).withColumn("edges", polygons.edges(F.col("shape")))
    right = right.select("id", "shape", "edges", *box.columns())
    for distance, pairs in ((2.0, [(2, 7), (3, 8)]), (4.0, [(1, 7), (2, 7), (3, 8)])):
        got = sweep.row_pairs(left.drop("edges"), right, distance, "shape").collect()
        assert sorted((r.id, r.other) for r in got) == sorted(map(tuple, sweep.near_shapes(left, right, distance, "edges").collect())) == pairs
        assert {r.id: r.shape for r in got} == {r.id: r.shape for r in left.collect() if r.id in {r.id for r in got}}


def test_found_rows_come_in_small_batches(spark, monkeypatch):
    """A crowded cell gives many whole rows at once, which the JVM would get as one batch."""
    rows = spark.range(60).selectExpr("id", "0.0D as x0", "0.0D as y0", "1.0D as x1", "1.0D as y1")
    monkeypatch.setattr(sweep, "ROWS", 100)
    monkeypatch.setattr(type(rows), "mapInArrow", lambda df, run, schema: (run, df.toArrow().combine_chunks().to_batches()))
    run, batches = sweep.near_pairs(rows, rows, ids, "i long, j long")
    sizes = [len(b) for b in run(iter(batches))]
    assert sum(sizes) == 3600 and max(sizes) <= 100
