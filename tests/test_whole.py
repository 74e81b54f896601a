"""Queries give all rows of their input, over whole tables and against plain Python."""

from __future__ import annotations

import pytest

from parcelight.plans import detection_queries, source_queries, vector_queries
from parcelight.plans.domain import Domain

from .conftest import DATA

RUNS = {k: v for m in (vector_queries, detection_queries, source_queries) for k, v in m.queries().items()}


@pytest.fixture(scope="module")
def masks(spark):
    return Domain(spark, DATA).detections.filter("edges is not null").select("id", "tile", "region", "prompt", "score").collect()


def test_every_supplier_is_a_plot(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("suppliers"))
    spark.range(250).selectExpr("id as s_suppkey", "cast(id % 25 as int) as s_nationkey", "cast(id as double) as s_acctbal").write.parquet(f"{folder}/supplier.parquet")
    assert sorted({r.id for r in RUNS["raster_rasterize"](spark, folder).select("id").collect()}) == list(range(250))


@pytest.mark.parametrize(("name", "each"), [("cross_model_input", 4), ("skip_list", 3), ("scan_wms_building", 1)])
def test_every_located_prosumer_has_a_building(spark, name, each):
    want = sorted(r.pid for r in Domain(spark, DATA).prosumers.select("pid").collect())
    got = sorted(r.fid for r in RUNS[name](spark, DATA).select("fid").collect())
    assert got == sorted(want * each)


@pytest.mark.parametrize("name", ["sort_score", "sort_score_np"])
def test_sort_score_places_every_box(spark, masks, name):
    rows = RUNS[name](spark, DATA).collect()
    want = sorted(((m.id, m.score) for m in masks), key=lambda b: (b[1] is None, -(b[1] or 0), b[0]))
    assert [(r.id, r.score) for r in rows] == want and [r.place for r in rows] == list(range(1, len(want) + 1))


def test_sort_files_gives_every_file(spark):
    tiles = [r.coord_1k for r in spark.read.parquet(f"{DATA}/tiles.parquet").collect()]
    assert [r.file for r in RUNS["sort_files"](spark, DATA).collect()] == sorted(f"{t}_core" for t in tiles)


def test_union_features_appends_every_tile(spark, masks):
    assert sorted(r.id for r in RUNS["union_features"](spark, DATA).collect()) == sorted(m.id for m in masks)


def test_deliveries_count_once_and_dirt_has_its_meaning(spark):
    from datetime import datetime

    from parcelight.plans.domain import masks_of

    day = lambda n: datetime(2025, 1, n)
    square = "POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))"
    rows = [
        (1, "T", "CORE ", 4.0, 0.5, "A  b.", "f", square, day(1), day(2)),
        (1, "T", "CORE ", 4.0, 0.5, "A  b.", "g", square, day(1), day(9)),
        (2, None, None, float("nan"), 1.5, None, None, "POLYGON EMPTY", day(1), day(2)),
        (3, "T", "core", -1.0, float("nan"), "x", "f", None, None, None),
        (4, "T", "core", float("inf"), -0.1, "x", "f", "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 7 5, 7 7, 5 7)))", day(1), day(2)),
        (None, "T", "core", 1.0, 0.5, "x", "f", square, day(1), day(2)),
    ]
    schema = "detection_id long, tile_id string, region string, area_m2 double, score double, prompt string, source_file string, geometry string, detected_at timestamp_ntz, ingested_at timestamp_ntz"
    df = masks_of(spark.createDataFrame(rows, schema))
    got = {r.id: (r.tile, r.region, r.prompt, r.score, r.area_m2, r.source_file, r.area) for r in df.collect()}
    assert got == {1: ("T", "core", "a b", 0.5, 4.0, "f", 4.0), 2: ("none", None, None, None, None, None, None), 3: ("T", "core", "x", None, None, "f", None), 4: ("T", "core", "x", None, None, "f", 4.5)}
    assert masks_of(spark.createDataFrame([], schema)).count() == 0
