from __future__ import annotations

import json
import struct

import pytest
from pyspark.sql import functions as F

from parcelight.functions import utm, wkb
from parcelight.functions.classes import power_class
from parcelight.operators import metrics
from parcelight.sources import config, geojson, geopackage, shapefile, sinks, styles, wms
from parcelight.streaming import ingest

SQUARE = [[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]]]
HOLED = [*SQUARE, [[1.0, 1.0], [1.0, 2.0], [2.0, 2.0], [2.0, 1.0], [1.0, 1.0]]]


@pytest.mark.parametrize("geometry", [("Point", [1.0, 2.0]), ("LineString", [[0.0, 0.0], [1.0, 1.0]]), ("Polygon", HOLED), ("MultiPolygon", [SQUARE, HOLED]), ("MultiPoint", [[1.0, 2.0], [3.0, 4.0]])])
def test_wkb_round_trip(geometry):
    assert wkb.read(wkb.write(geometry)) == geometry


def test_wkb_figures():
    assert wkb.area(("Polygon", HOLED)) == 15.0 and wkb.bounds(("MultiPolygon", [SQUARE, HOLED])) == (0.0, 0.0, 4.0, 4.0)
    z = struct.pack("<BI3d", 1, 1001, 1.0, 2.0, 3.0)
    assert wkb.read(z) == ("Point", [1.0, 2.0])
    with pytest.raises(ValueError):
        wkb.read(b"\x01\x99")


def test_geojson_folder(spark, tmp_path):
    def write(name, *features, **more):
        (tmp_path / name).write_text(json.dumps({"type": "FeatureCollection", "features": list(features)} | more))

    feature = lambda **p: {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": SQUARE}, "properties": p}
    write("T1_core.geojson", feature(detection_id=0, score=0.5, area_m2=16, prompt="p"), feature(mask_id=1, avg_score=0.25), crs={"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::25830"}})
    write("T1_donut.geojson", feature(detection_id=0))
    write("T2_core.geojson")
    write("all_merged.geojson", feature(detection_id=7))
    (tmp_path / "broken_core.geojson").write_text("{")
    rows = geojson.read_masks(spark, str(tmp_path)).orderBy("source_file", "feature_no").collect()
    assert [(r.source_file, r.file_tile, r.file_region, r.detection_id, r.score, r.srid) for r in rows] == [("T1_core.geojson", "T1", "core", 0, 0.5, 25830), ("T1_core.geojson", "T1", "core", 1, 0.25, 25830), ("T1_donut.geojson", "T1", "donut", 0, None, 25831)]
    assert json.loads(rows[0].geometry)["coordinates"] == SQUARE
    assert geojson.read_masks(spark, str(tmp_path), merged=True).count() == 4
    assert geojson.read_masks(spark, str(tmp_path), tile_id="donut").count() == 1
    done = geojson.outputs(spark, str(tmp_path))
    tiles = spark.createDataFrame([("T1",), ("T2",), ("T3",)], "tile_id string")
    assert sorted(r.tile_id for r in geojson.pending(tiles, done, donuts=True).collect()) == ["T2", "T3"]
    assert [r.tile_id for r in geojson.pending(tiles, done, donuts=False).collect()] == ["T3"]


def test_geojson_is_written_per_tile_and_read_again(spark, ws, tmp_path):
    shape = json.dumps({"type": "Polygon", "coordinates": SQUARE})
    masks = spark.createDataFrame([("T1", "core", 1, 16.004, 0.1234, "p", shape), ("T1", "core", 2, 1.0, 0.9, "q", None), ("T1", "donut", 3, 2.0, None, None, shape)], "tile_id string, region string, id long, area_m2 double, score double, prompt string, geometry string")
    written = {r.file: r.features for r in geojson.write_tiles(geojson.numbered(ws, masks), str(tmp_path / "out")).collect()}
    assert written == {"T1_core.geojson": 1, "T1_donut.geojson": 1}
    back = {r.source_file: r for r in geojson.read_masks(spark, str(tmp_path / "out")).collect()}
    core = back["T1_core.geojson"]
    assert (core.detection_id, core.area_m2, core.score, core.prompt, core.crs) == (1, 16.0, 0.123, "p", "EPSG:25831")  # the empty one kept its number
    assert back["T1_donut.geojson"].score is None


def test_building_documents(spark):
    shape = json.dumps({"type": "Point", "coordinates": [1, 2]})
    rows = lambda n: spark.createDataFrame([(i, shape, 0.5) for i in range(n)], "no int, geometry string, score double")
    made = geojson.building_features(rows(2), "B7", rows(1))
    assert [(r.id, r.type) for r in made.orderBy("id").collect()] == [("B7_0000", "pv"), ("B7_0001", "pv"), ("B7_0002", "negative_mask")]
    document = json.loads(geojson.documents(made.withColumn("b", F.lit("B7")), ["b"]).first().document)
    assert [f["properties"]["id"] for f in document["features"]] == ["B7_0000", "B7_0001", "B7_0002"] and document["features"][0]["geometry"]["coordinates"] == [1, 2]


def test_grid(spark, tmp_path):
    path = tmp_path / "grid.geojson"
    tile = lambda kind, c, **p: {"type": "Feature", "geometry": {"type": kind, "coordinates": c}, "properties": p}
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [tile("Polygon", SQUARE, COORD_1K="A", COORD_10K="B"), tile("MultiPolygon", [SQUARE], COORD_1K="C")]}))
    rows = geojson.read_grid(spark, str(path)).orderBy("coord_1k").collect()
    assert [(r.coord_1k, r.coord_10k, r.geom_type, r.x0, r.y1) for r in rows] == [("A", "B", "Polygon", 0.0, 4.0), ("C", None, "MultiPolygon", 0.0, 4.0)]
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [tile("Polygon", SQUARE, OTHER="A")]}))
    with pytest.raises(ValueError):
        geojson.read_grid(spark, str(path))


def test_geopackage(spark, tmp_path):
    path = str(tmp_path / "a.gpkg")
    rows = [{"geom": wkb.write(("Polygon", SQUARE)), "name": "x", "n": 3}, {"geom": None, "name": None, "n": None}, {"geom": wkb.write(("Point", [7.0, 8.0])), "name": "ü", "n": 5}]
    assert geopackage.write(rows, path, "masks", [("name", "TEXT"), ("n", "INTEGER")], srid=25830) == 3
    geopackage.write(rows[:1], path, "other layer", [("name", "TEXT")])
    spark.dataSource.register(geopackage.GeoPackage)
    df = spark.read.format("geopackage").option("layer", "masks").load(path)
    got = {r.fid: r for r in df.collect()}
    assert (got[1].name, got[1].n, got[1].srid, got[1].x1) == ("x", 3, 25830, 4.0) and wkb.read(bytes(got[3].geom)) == ("Point", [7.0, 8.0])
    assert got[2].geom is None and got[2].x0 is None
    assert df.filter("n = 5").select("name").collect()[0].name == "ü"
    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)
    try:
        pushed = spark.read.format("geopackage").option("layer", "masks").option("pushdown", True).load(path).filter("n = 5")
        assert [r.name for r in pushed.collect()] == ["ü"]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    with pytest.raises(Exception, match="name one"):
        spark.read.format("geopackage").load(path).count()


def _shapefile(folder, shapes, names):
    body, index, at = b"", b"", 50
    for i, s in enumerate(shapes, 1):
        body += struct.pack(">2i", i, len(s) // 2) + s
        index += struct.pack(">2i", at, len(s) // 2)
        at += 4 + len(s) // 2
    (folder / "s.shp").write_bytes(b"\0" * 100 + body)
    (folder / "s.shx").write_bytes(b"\0" * 100 + index)
    field = lambda n, t, size, k: n.encode().ljust(11, b"\0") + t.encode() + b"\0" * 4 + bytes([size, k]) + b"\0" * 14
    records = b"".join(b" " + n.encode().ljust(6) + v.encode().rjust(5) for n, v in names)
    (folder / "s.dbf").write_bytes(struct.pack("<4BIHH", 3, 124, 1, 1, len(names), 32 + 64 + 1, 12) + b"\0" * 20 + field("NAME", "C", 6, 0) + field("KW", "N", 5, 1) + b"\r" + records)
    (folder / "s.prj").write_text('PROJCS["ETRS_1989_UTM_Zone_31N",GEOGCS["x"]]')


def test_shapefile(spark, tmp_path):
    flat = lambda rings: b"".join(struct.pack("<2d", *p) for r in rings for p in r)
    outer, hole = SQUARE[0][::-1], HOLED[1][::-1]  # clockwise outside, counter-clockwise inside
    polygon = struct.pack("<i4d3i", 5, 0, 0, 4, 4, 2, 10, 0) + struct.pack("<i", 5) + flat([outer, hole])
    _shapefile(tmp_path, [struct.pack("<i2d", 1, 3.0, 4.0), polygon, struct.pack("<i", 0)], [("a", "1.5"), ("b", ""), ("ü"[:0], "7.0")])
    spark.dataSource.register(shapefile.Shapefile)
    rows = spark.read.format("shapefile").option("rows", 1).load(str(tmp_path / "s.shp")).collect()
    assert [(r.NAME, r.KW, r.srid) for r in rows] == [("a", 1.5, 25831), ("b", None, 25831), (None, 7.0, 25831)]
    assert wkb.read(bytes(rows[0].geometry)) == ("Point", [3.0, 4.0]) and rows[2].geometry is None
    assert wkb.area(wkb.read(bytes(rows[1].geometry))) == 15.0


SLD = """<sld:StyledLayerDescriptor xmlns:sld="s" xmlns:ogc="o"><sld:Rule><sld:Title>small</sld:Title><ogc:Filter><ogc:And><ogc:PropertyIsGreaterThanOrEqualTo><ogc:PropertyName>POT_KW</ogc:PropertyName><ogc:Literal>0</ogc:Literal></ogc:PropertyIsGreaterThanOrEqualTo><ogc:PropertyIsLessThanOrEqualTo><ogc:PropertyName>POT_KW</ogc:PropertyName><ogc:Literal>5</ogc:Literal></ogc:PropertyIsLessThanOrEqualTo></ogc:And></ogc:Filter></sld:Rule>
<sld:Rule><sld:Title>open</sld:Title><ogc:Filter><ogc:Or><ogc:PropertyIsEqualTo><ogc:PropertyName>ESTAT</ogc:PropertyName><ogc:Literal>A</ogc:Literal></ogc:PropertyIsEqualTo><ogc:Not><ogc:PropertyIsNotEqualTo><ogc:PropertyName>ESTAT</ogc:PropertyName><ogc:Literal>B</ogc:Literal></ogc:PropertyIsNotEqualTo></ogc:Not></ogc:Or></ogc:Filter></sld:Rule></sld:StyledLayerDescriptor>"""


def test_styles(spark):
    df = spark.createDataFrame([(0.0, "Z"), (5.0, "A"), (5.01, "A"), (9.0, "B"), (9.0, "C"), (None, None)], "POT_KW double, ESTAT string")
    assert [r[0] for r in df.select(styles.classified(SLD)).collect()] == ["small", "small", "open", "open", None, None]


def test_power_classes(spark):
    values = [0.0, 5.0, 5.01, 25.0, 100.0, 100.01, -1.0, None]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(power_class(F.col("v"))).collect()]
    assert got == ["0-5", "0-5", "5-25", "5-25", "25-100", ">100", None, None]


def test_magic_bytes(spark):
    files = [(str(i), bytes.fromhex(h)) for i, h in enumerate(["ffd8ffe0", "49492a00", "4d4d002a", "89504e47", "0000", ""])] + [("6", b"<?xml?><ServiceExceptionReport>"), ("7", None)]
    rows = wms.validated(spark.createDataFrame(files, "path string, content binary")).orderBy("path").collect()
    assert [r.format for r in rows] == ["JPEG", "GeoTIFF", "GeoTIFF", "PNG", "unknown", "unknown", "WMS Error", "unknown"]
    assert [r.valid for r in rows] == [True] * 4 + [False] * 4


def _answer(url, timeout):
    if "LAYERS=bad" in url:
        raise OSError("refused")
    return b"II*\0" + b"x" * 2000 if "LAYERS=ortho" in url else b"<ServiceException/>"


def test_map_requests(spark):
    services = wms.registry(spark, {"wms_services": {"icgc": {"url": "http://a", "default_layer": "ortho", "crs": "EPSG:25831", "resolution_cm": 25, "extent": {"minx": 260000, "miny": 4488000, "maxx": 528000, "maxy": 4748000}}, "ign": {"url": "http://b", "default_layer": "small", "crs": "EPSG:25830", "resolution_cm": 25}}})
    centres = spark.createDataFrame([(1, 1.1, 41.15), (2, -3.7, 40.4)], "id long, lon double, lat double")
    asked = wms.requests(centres, services, 1000).orderBy("id")
    rows = asked.collect()
    assert [r.service for r in rows] == ["icgc", "ign"] and rows[0].file == "ortho_icgc_41.1500_1.1000_1000m.tif"
    assert "WIDTH=4000&HEIGHT=4000&FORMAT=image/tiff&TRANSPARENT=FALSE" in rows[0].request and "CRS=EPSG:25830" in rows[1].request
    got = wms.fetched(asked, _answer).orderBy("id").collect()
    assert got[0].content[:4] == b"II*\0" and got[0].error is None and got[1].content is None and "ServiceException" in got[1].error


def test_capabilities(spark):
    text = '<WMS xmlns="http://www.opengis.net/wms"><Layer><Name>a</Name><BoundingBox CRS="EPSG:25831" minx="1" miny="2" maxx="3"/><Layer><Title>no name</Title><BoundingBox CRS="x"/></Layer><Layer><Name>no box</Name></Layer></Layer></WMS>'
    rows = wms.layers(spark.createDataFrame([(text,), ("<broken",), (None,)], "content string")).collect()
    assert [tuple(r) for r in rows] == [("a", "EPSG:25831", 1.0, 2.0, 3.0, 0.0)]


def test_utm_there_and_back(spark):
    df = spark.createDataFrame([(1.1, 41.15, 25831), (-3.7, 40.4, 25830), (151.2, -33.9, 32756)], "lon double, lat double, epsg int")
    x, y = utm.to_utm(F.col("lon"), F.col("lat"), F.col("epsg"))
    back = utm.from_utm(df.withColumns({"x": x, "y": y}), "x", "y", F.col("epsg"), "lon2", "lat2").collect()
    for r in back:
        assert abs(r.lon - r.lon2) < 1e-8 and abs(r.lat - r.lat2) < 1e-8
    assert back[2].y > 6_000_000
    assert df.select(utm.zone_of(F.lit(4326))).first()[0] is None


def test_proximity_figures(spark):
    masks = spark.createDataFrame([(1, 0.0, 0.0, 2.0, 2.0), (2, 100.0, 0.0, 102.0, 2.0)], "id long, x0 double, y0 double, x1 double, y1 double")
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 5.0, 1.0), (3, 132.0, 1.0), (4, 900.0, 1.0)], "pid long, x double, y double")
    rows = {r.id: r for r in metrics.mask_proximity(masks, points, 10.0, 50.0).collect()}
    assert (rows[1].points_inside, rows[1].has_match, rows[2].points_inside, rows[2].points_in_buffer) == (2, True, 0, 1)
    s = metrics.proximity_summary(masks, points, 10.0).first()
    assert (s.true_positives, s.false_positives, s.false_negatives, s.precision, s.recall, s.f1) == (1, 1, 2, 0.5, 0.333, 0.4)
    none = metrics.proximity_summary(masks.limit(0), points, 10.0).first()
    assert (none.true_positives, none.false_negatives, none.f1) == (0, 4, 0.0)


def test_tile_figures(spark):
    df = spark.createDataFrame([(0, 0, 0), (5, 0, 3)], "matched int, total int, masks int")
    got = [r.asDict() for r in df.select(*metrics.tile_metrics(F.col("matched"), F.col("total"), F.col("masks"))).collect()]
    assert got[0] == {"true_positives": 0, "false_positives": 0, "precision": 0.0, "recall": 0.0, "f1": 0.0}
    assert got[1] == {"true_positives": 5, "false_positives": 0, "precision": 1.0, "recall": 1.0, "f1": 1.0}


def test_configuration(spark, tmp_path):
    (tmp_path / "config.yaml").write_text("project_name: x\nversion: '1'\ndefault_module: owlv2\nnms_iou: 0.4\nwms: {a: {b: 2}}\n")
    (tmp_path / "m" / "owlv2").mkdir(parents=True)
    (tmp_path / "m" / "owlv2" / "__init__.py").touch()
    (tmp_path / "m" / "owlv2" / "config.yaml").write_text("nms_iou: 0.3\n")
    c = config.load(tmp_path / "config.yaml")
    assert config.modules(tmp_path / "m") == ["owlv2"] and config.load_module(tmp_path / "m", "none") == {}
    s = config.settings(c, config.load_module(tmp_path / "m", "owlv2"), merge_distance_m=2.0, max_area_m2=None)
    assert (s["nms_iou"], s["merge_distance_m"], s["max_area_m2"]) == (0.3, 2.0, 50000.0)
    assert config.check(c, ["owlv2"]) == [] and len(config.check({"default_module": "z"}, ["owlv2"])) == 3
    assert config.parameters(["a= b=c ", "d=1"]) == {"a": "b=c", "d": "1"}
    with pytest.raises(config.ConfigError):
        config.load(tmp_path / "none.yaml")
    with pytest.raises(config.ConfigError):
        config.parameters(["x"])
    (tmp_path / "p.txt").write_text("one.\n\n  two.  \n")
    assert [r.prompt for r in config.prompts(spark, str(tmp_path / "p.txt")).collect()] == ["one.", "two."]
    assert {r.key: r.value for r in config.as_table(spark, c).collect()}["wms.a.b"] == "2"


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b", None), (2, None, 2.5)], "k int, t string, v double")
    assert sinks.single(df, str(tmp_path / "r.csv")) == 2 and (tmp_path / "r.csv").read_text().splitlines() == ["k,t,v", '1,"a,b",', "2,,2.5"]
    sinks.single(df, str(tmp_path / "r.json"), "json")
    assert json.loads((tmp_path / "r.json").read_text())[1] == {"k": 2, "t": None, "v": 2.5}
    sinks.single(df.select("k"), str(tmp_path / "r.txt"), "lines")
    assert (tmp_path / "r.txt").read_text() == "1\n2\n"
    sinks.write_metadata({"model": "x", "params": {"a": 1}}, str(tmp_path / "m.yaml"))
    assert "params:" in (tmp_path / "m.yaml").read_text()
    sinks.write_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2
    sinks.write_lines(df, "k", str(tmp_path / "lines"))
    sinks.write_json(df, str(tmp_path / "json"))
    assert [r.line for r in sinks.console(df, {"k": 3, "t": 4}).collect()] == ["  1 a,b ", "  2 N/A "]
    images = spark.createDataFrame([("a.png", b"12"), ("b.png", None)], "file string, content binary")
    assert [tuple(r) for r in sinks.write_images(images, str(tmp_path / "im")).collect()] == [("a.png", 2)]


def test_stream_of_results(spark, tmp_path):
    from datetime import datetime

    schema = "detection_id long, tile_id string, area_m2 double, detected_at timestamp"
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ck"))
    day = datetime(2025, 3, 1)
    spark.createDataFrame([(1, "A", 2.0, day), (1, "A", 2.0, day), (2, "B", 1.0, day)], schema).coalesce(1).write.parquet(source)
    run = lambda: ingest.keep_summary(ingest.fresh(ingest.read_results(spark, source, schema)), out, checkpoint).awaitTermination()
    run()
    spark.createDataFrame([(2, "B", 1.0, day), (3, "A", 5.0, day)], schema).coalesce(1).write.mode("append").parquet(source)
    run()
    assert {r.tile_id: (r.polygon_count, r.total_area_m2) for r in ingest.summary(spark, out).collect()} == {"A": (2, 7.0), "B": (1, 1.0)}


def test_a_document_of_several_lines(spark, tmp_path):
    document = geojson.collection([{"type": "Feature", "geometry": {"type": "Polygon", "coordinates": SQUARE}, "properties": {"tile_id": "T", "score": 0.5}}])
    (tmp_path / "T_core.geojson").write_text(json.dumps(document, indent=2))
    assert [(r.tile_id, r.score) for r in geojson.read_masks(spark, str(tmp_path)).collect()] == [("T", 0.5)]


def test_merged_files_hold_every_feature(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(geojson, "MERGED_FEATURES", 30)
    shape = json.dumps({"type": "Polygon", "coordinates": SQUARE})
    rows = spark.createDataFrame([(f"T{i % 7}", "core", i, shape if i else None) for i in range(100)], "tile_id string, region string, detection_id int, geometry string")
    assert geojson.write_merged([rows.limit(0), rows], str(tmp_path / "m")) > 1
    for p in (tmp_path / "m").glob("*.geojson"):
        json.loads(p.read_text())
    assert sorted(r.detection_id for r in geojson.read_masks(spark, str(tmp_path / "m"), merged=True).collect()) == list(range(1, 100))
