from __future__ import annotations

import json

import pytest

from parcelight.operators import compact
from parcelight.runtime import exists

RING = [[0, 0], [2, 0], [2, 1.5], [0, 1.5], [0, 0]]
TURNED = [[2, 1.50], [0, 1.5], [0, 0], [2.0, 0], [2, 1.5]]
BACK = RING[::-1]


def feature(ring=RING, **props):
    return {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [ring]}, "properties": {"tile_id": "A", "region": "core", "detection_id": 0, "area_m2": 3.0, "score": 0.5, "prompt": "p"} | props}


def body(*features):
    return json.dumps({"type": "FeatureCollection", "features": list(features)})


def run(spark, ws, files):
    df = spark.createDataFrame([(i, b, "x", True) for i, b in files], "file_id long, body string, same string, repeated boolean")
    kept, repeats = compact.compact(ws, df, ws.path("target"))
    assert spark.read.parquet(ws.path("target")).count() == kept.count()  # the folder holds each feature once
    return sorted((r.file_id, r.feature_no) for r in kept.collect()), sorted((r.file_id, r.feature_no) for r in repeats.collect())


def test_repeats_are_found_across_and_within_files(spark, ws):
    files = [
        (5, body(feature(), feature(score=None), feature(area_m2=3))),
        (2, body(feature(TURNED), feature(BACK))),
        (7, body(feature(score=None), feature(score=0.6), feature(tile_id=None), feature(tile_id=None))),
    ]
    kept, repeats = run(spark, ws, files)
    assert repeats == [(5, 0), (5, 2), (7, 0), (7, 3)]
    assert kept == [(2, 0), (2, 1), (5, 1), (7, 1), (7, 2)]


@pytest.mark.parametrize("bad", [None, "", "  ", "{", body(feature())[:-1], body(feature()) + "x", body(feature()) * 2, "[]", "3", '{"features": null}', '{"features": {}}', '{"features": [NaN]}'])
def test_unreadable_bodies_hold_no_features(spark, ws, bad):
    assert run(spark, ws, [(1, bad), (2, body(feature()))]) == ([(2, 0)], [])


def test_spelling_of_numbers_and_members(spark, ws):
    one = '{"features":[{"properties":{"prompt":"p","score":5e-1,"area_m2":3.00,"detection_id":0.0,"region":"core","tile_id":"A"},"geometry":{"coordinates":[[[0,0],[2.0,0],[2,1.50],[0,1.5],[0,0]]],"type":"Polygon"}}]}'
    assert run(spark, ws, [(1, body(feature())), (2, one)]) == ([(1, 0)], [(2, 0)])


def test_odd_features_are_kept(spark, ws):
    odd = body({}, None, feature(ring=[]), {"geometry": {"type": "Point", "coordinates": [1, 2]}, "properties": None}, {"geometry": {"coordinates": [1, 2], "type": "Point"}})
    kept, repeats = run(spark, ws, [(1, odd)])
    assert len(kept) + len(repeats) == 5
    assert repeats == [(1, 1), (1, 4)]


def test_values_of_other_types_are_other_values(spark, ws):
    odd = [feature(score="0.5"), feature(score=None), feature(score=True), feature(tile_id=1), feature(tile_id="1"), feature(detection_id=2**60), feature(detection_id=2**60 + 1), feature(score="0.5")]
    kept, repeats = run(spark, ws, [(1, body(*odd))])
    assert repeats == [(1, 7)] and len(kept) == 7


def test_no_files_and_no_features(spark, ws):
    assert run(spark, ws, []) == ([], [])
    assert run(spark, ws, [(1, body()), (2, None)]) == ([], [])


def test_files_have_about_the_target_size(spark, ws):
    files = spark.createDataFrame([(i, body(*[feature(area_m2=i + k / 100, tile_id="hot" if i % 3 else f"t{i}") for k in range(50)])) for i in range(60)], "file_id long, body string")
    kept, repeats = compact.compact(ws, files, ws.path("sized"), target_bytes=20_000)
    names = [r[0] for r in kept.select("_metadata.file_name").distinct().collect()]
    assert kept.count() == 3000 and repeats.count() == 0
    assert 2 <= len(names) <= 12
    assert kept.filter("tile_id = 'hot'").select("_metadata.file_name").distinct().count() > 1  # a hot tile is spread


def test_a_mismatch_keeps_the_old_folder(spark, ws, monkeypatch):
    target = ws.path("guarded")
    first = spark.createDataFrame([(1, body(feature()))], "file_id long, body string")
    compact.compact(ws, first, target)
    monkeypatch.setattr(compact, "reconcile", lambda loaded, written: (_ for _ in ()).throw(compact.CountMismatch("off")))
    with pytest.raises(compact.CountMismatch):
        compact.compact(ws, spark.createDataFrame([(2, body(feature(), feature(score=1.0)))], "file_id long, body string"), target)
    assert exists(spark, target)
    assert spark.read.parquet(target).count() == 1


def test_reconcile(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,)], "file_id long")
    compact.reconcile(rows, rows)
    with pytest.raises(compact.CountMismatch):
        compact.reconcile(rows, rows.limit(2))
    with pytest.raises(compact.CountMismatch):  # as many rows, but of other files
        compact.reconcile(rows, spark.createDataFrame([(1,), (2,), (2,)], "file_id long"))


def test_all_members_are_kept(spark, ws):
    odd = feature(colour="red", crs={"name": "x"}) | {"id": 7, "bbox": [0, 0, 2, 1.5]}
    odd["geometry"]["note"] = "n"
    plain = feature()
    kept, _ = compact.compact(ws, spark.createDataFrame([(1, body(odd, feature(detection_id=3), 5))], "file_id long, body string"), ws.path("whole"))
    rest = {r.feature_no: r.rest and json.loads(r.rest) for r in kept.collect()}
    assert rest == {0: {"id": 7, "bbox": [0, 0, 2, 1.5], "properties": {"colour": "red", "crs": {"name": "x"}}, "geometry": {"note": "n"}}, 1: None, 2: {"feature": 5}}
    kept, repeats = run(spark, ws, [(1, body(odd)), (2, body(plain))])  # other members don't make another feature
    assert (kept, repeats) == ([(1, 0)], [(2, 0)])


def test_a_stop_between_the_renames(spark, ws, monkeypatch):
    target = ws.path("stopped")
    files = lambda *ids: spark.createDataFrame([(i, body(feature(score=i / 10), feature(score=i / 10))) for i in ids], "file_id long, body string")
    compact.compact(ws, files(1), target)
    real, calls = compact.rename, []

    for stop in (2, 3, 4, 5):
        calls.clear()

        def stopping(spark, a, b):
            calls.append(b)
            if len(calls) == stop:
                raise KeyboardInterrupt
            real(spark, a, b)

        monkeypatch.setattr(compact, "rename", stopping)
        with pytest.raises(KeyboardInterrupt):
            compact.compact(ws, files(2, 3), target)
        monkeypatch.setattr(compact, "rename", real)
        compact.swap(spark, target)
        assert sorted(r.file_id for r in spark.read.parquet(target).collect()) == [2, 3]
        assert sorted(r.file_id for r in spark.read.parquet(f"{target}.repeats").collect()) == [2, 3]
        assert not any(exists(spark, target + s) for s in (".old", ".swap", ".staging", ".repeats.old"))
        compact.compact(ws, files(1), target)


def test_a_third_of_all_rows_are_copies(spark, ws):
    files = [(i, body(feature(), *[feature(area_m2=i + k / 8) for k in range(2)])) for i in range(5, 900)] + [(4, body(feature(TURNED)))]
    df = spark.createDataFrame(files, "file_id long, body string")
    kept, repeats = compact.compact(ws, df, ws.path("copies"), target_bytes=10_000)
    assert [(r.file_id, r.feature_no) for r in kept.filter("area_m2 = 3.0").collect()] == [(4, 0)]
    assert kept.count() == 1 + 2 * 895 and repeats.count() == 895
    assert repeats.select("_metadata.file_name").distinct().count() > 1
