"""Queries that write the domain in the formats of the sources and sinks and read it again."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelight.functions import polygons, wkb
from parcelight.functions.boxes import Box
from parcelight.operators import metrics, raster
from parcelight.operators.rangesort import running_sums
from parcelight.operators.sweep import row_pairs
from parcelight.plans.domain import NEGATIVE, Domain, Registry
from parcelight.plans.vector_queries import NEAR_BOX, SNAP
from parcelight.runtime import ship
from parcelight.sources import config, geojson, geopackage, geotiff, sinks, wms

query = Registry()
queries, oracle_sql = query.runs.copy, query.sql.copy
BOX = Box()


def _folder(d: Domain, name: str) -> str:
    """A folder for formats that are written with plain file access; the shared folder must be mounted."""
    path = d.ws.path(name)
    if "://" in path and not path.startswith("file://"):
        raise ValueError("these formats need a mounted shared folder")
    path = path.removeprefix("file://").removeprefix("file:")
    os.makedirs(path, exist_ok=True)
    return path


def _polygon(box: Box) -> Column:
    corner = lambda x, y: F.array(x, y)
    ring = F.array(corner(box.x0, box.y0), corner(box.x1, box.y0), corner(box.x1, box.y1), corner(box.x0, box.y1), corner(box.x0, box.y0))
    return F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")))


def _masks(d: Domain) -> DataFrame:
    region = F.coalesce("region", F.lit("core"))
    return d.masks.select(F.col("tile").alias("tile_id"), region.alias("region"), "id", "area_m2", "score", "prompt", polygons.to_json(F.col("shape")).alias("geometry"))


def _written(d: Domain) -> str:
    """The detections as GeoJSON files of a tile and region each."""
    folder = _folder(d, "masks")
    geojson.write_tiles(geojson.numbered(d.ws, _masks(d)), folder).agg(F.sum("features")).collect()
    return folder


_NUMBERED = """select tile as tile_id, coalesce(region, 'core') as region, cast(row_number() over (partition by tile, coalesce(region, 'core') order by score desc nulls last, id) - 1 as int) as detection_id,
    round(area_m2, 2) as area_m2, round(score, 3) as score, prompt from boxes"""


@query(f"select *, tile_id || '_' || region || '.geojson' as source_file from ({_NUMBERED})")
def scan_masks(d: Domain) -> DataFrame:
    return geojson.read_masks(d.spark, _written(d)).select("tile_id", "region", "detection_id", "area_m2", "score", "prompt", "source_file")


@query(f"select tile_id, region, count(*) as n from ({_NUMBERED}) group by all")
def scan_core_donut(d: Domain) -> DataFrame:
    """Tile and region as the file names have them."""
    rows = geojson.read_masks(d.spark, _written(d))
    return rows.groupBy(F.col("file_tile").alias("tile_id"), F.col("file_region").alias("region")).agg(F.count("*").alias("n"))


@query(f"select region, detection_id from ({_NUMBERED}) where tile_id = '31TAF2121'")
def scan_tile_masks(d: Domain) -> DataFrame:
    return geojson.read_masks(d.spark, _written(d), tile_id="31TAF2121").select("region", "detection_id")


@query(f"select n.*, round(b.area, 1) as area from ({_NUMBERED.replace('select tile', 'select id, tile', 1)}) n join (select id, area + 0.000013::double as area from boxes) b using (id)".replace("select n.*", "select n.* exclude (id)"))
def sink_geojson_tile(d: Domain) -> DataFrame:
    """Each feature as written, with the area of the geometry that was read."""
    read = geojson.read_masks(d.spark, _written(d))
    edges = polygons.edges(polygons.polygons(F.col("geometry")))
    box = polygons.bounds(F.col("_e"))
    area = F.round(polygons.area(F.col("_e"), F.col("_x"), F.col("_y")) + 0.000013, 1)
    rows = read.withColumn("_e", edges).withColumns({"_x": box.x0, "_y": box.y0})
    return rows.select("tile_id", "region", "detection_id", "area_m2", "score", "prompt", area.alias("area"))


@query(NEAR_BOX.format(d=2) + "select fid as building, count(*) as features, min(printf('%d_%04d', fid, id)) as first from hits group by all")
def sink_geojson_building(d: Domain) -> DataFrame:
    """Masks near each building as one JSON document per building, and their ids read back."""
    hits = row_pairs(d.shapes, d.footprints.withColumnRenamed("fid", "id"), 2.0, "shape")
    features = hits.select(F.col("other").alias("building"), F.format_string("%d_%04d", "other", "id").alias("id"), polygons.to_json(F.col("shape")).alias("geometry"))
    path = d.ws.path("buildings")
    geojson.documents(features, ["building"]).write.mode("overwrite").parquet(path)
    back = d.spark.read.parquet(path).select("building", F.from_json("document", geojson.FEATURES)["features"].alias("f"))
    return back.select("building", F.size("f").cast("long").alias("features"), F.array_min(F.transform("f", lambda f: f["properties"]["id"])).alias("first"))


@query(f"""select printf('B%s_%04d', tile, row_number() over (partition by tile order by coalesce(prompt, '') in {NEGATIVE}, id) - 1) as id, case when coalesce(prompt, '') in {NEGATIVE} then 'negative_mask' else 'pv' end as type, score from boxes""")
def sink_geojson_phase(d: Domain) -> DataFrame:
    """Each tile's candidates as features, negatives numbered after the kept ones, read back from lines of JSON."""
    negative = F.coalesce(F.col("prompt").isin(*NEGATIVE), F.lit(False))
    rows = d.masks.select("tile", "id", "score", polygons.to_json(F.col("shape")).alias("geometry"), negative.alias("negative"))

    def number(kept: Column, name: str) -> DataFrame:
        placed = running_sums(d.ws, rows.filter(kept).withColumn("one", F.lit(1)), ["tile"], ["id"], "one", name)
        return placed.select("tile", (F.col("running") - 1).alias("no"), "geometry", "score")

    features = geojson.building_features(number(~F.col("negative"), "pv"), F.concat(F.lit("B"), "tile"), number(F.col("negative"), "negative"), ["tile"])
    path = d.ws.path("phase")
    features.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.try_parse_json("geometry").alias("geometry"), F.struct("id", F.col("type").alias("kind"), "score").alias("properties"))).alias("value")).write.mode("overwrite").text(path)
    got = d.spark.read.text(path).select(F.from_json("value", "properties struct<id:string,kind:string,score:double>")["properties"].alias("p"))
    return got.select("p.id", F.col("p.kind").alias("type"), "p.score")


@query(_NUMBERED)
def sink_merged_geojson(d: Domain) -> DataFrame:
    """All features in few GeoJSON files, read back."""
    rows = geojson.numbered(d.ws, _masks(d))
    path = d.ws.path("merged")
    geojson.write_merged([rows.filter("region = 'core'"), rows.filter("region <> 'core'")], path)
    return geojson.read_masks(d.spark, path, merged=True).select("tile_id", "region", "detection_id", "area_m2", "score", "prompt")


@query("select tile as coord_1k, coord_10k, x0, y0, x1, y1 from grid")
def scan_grid(d: Domain) -> DataFrame:
    """The grid as one document per 10 km square; tiles without a square are in one by their own name."""
    folder = _folder(d, "grid")
    features = d.grid.select(F.col("tile").alias("COORD_1K"), F.col("coord_10k").alias("COORD_10K"), F.col("tile").alias("id"), _polygon(BOX).alias("geometry"), F.coalesce("coord_10k", "tile").alias("k"))
    geojson.documents(features, ["k"]).select("document").write.option("maxRecordsPerFile", 1).mode("overwrite").text(f"{folder}/text")
    return geojson.read_grid(d.spark, f"{folder}/text").select("coord_1k", "coord_10k", "x0", "y0", "x1", "y1")


#: Rows of one GeoPackage.
PACKAGE_ROWS = 50_000


def _packages(d: Domain, rows: DataFrame, layer: str, fields: list[tuple[str, str]]) -> DataFrame:
    """Rows (id, geom, fields...) as GeoPackages of about PACKAGE_ROWS rows, read as one table."""
    folder = _folder(d, layer)
    names = [n for n, _ in fields]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        path = f"{folder}/{int(pdf['part'].iloc[0])}.gpkg"
        plain = lambda v: None if v is pd.NA or v != v else v.item() if hasattr(v, "item") else v
        n = geopackage.write_whole(({k: plain(v) if k != "geom" else v for k, v in r.items()} for r in pdf[["geom", *names]].to_dict("records")), path, layer, fields)
        return pd.DataFrame({"n": [n]})

    parts = max(1, -(-rows.count() // PACKAGE_ROWS))
    rows.withColumn("part", F.pmod(F.xxhash64(names[0]), F.lit(parts))).groupBy("part").applyInPandas(run, "n long").agg(F.sum("n")).collect()
    d.spark.dataSource.register(geopackage.GeoPackage)
    return d.spark.read.format("geopackage").option("layer", layer).load(f"{folder}/*.gpkg")


def _wkb_points(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield b.assign(geom=[wkb.write(("Point", [x, y])) for x, y in zip(b["x"], b["y"])])[["pid", "geom"]]


@query("select pid, x, y, cast(25831 as int) as srid from points")
def scan_points(d: Domain) -> DataFrame:
    points = d.points.select("pid", "x", "y").mapInPandas(_wkb_points, "pid long, geom binary")
    read = _packages(d, points, "points", [("pid", "INTEGER")])
    return read.select("pid", F.col("x0").alias("x"), F.col("y0").alias("y"), F.coalesce("srid", F.lit(25831)).alias("srid"))


def _wkb_masks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        shapes = [[[[p["x"], p["y"]] for p in ring] for ring in polygon] for shape in b["shape"] for polygon in [shape[0]]] if all(len(s) == 1 for s in b["shape"]) else None
        kinds = [("Polygon", s) for s in shapes] if shapes is not None else [("MultiPolygon", [[[[p["x"], p["y"]] for p in ring] for ring in polygon] for polygon in shape]) for shape in b["shape"]]
        yield b.assign(geom=[wkb.write(k) for k in kinds]).drop(columns=["shape"])


@query("select id, score, x0, y0, x1, y1 from boxes")
def sink_merged_gpkg_geojson(d: Domain) -> DataFrame:
    masks = d.masks.select("id", "score", "shape").mapInPandas(_wkb_masks, "id long, score double, geom binary")
    return _packages(d, masks, "masks", [("id", "INTEGER"), ("score", "REAL")]).select("id", "score", "x0", "y0", "x1", "y1")


@query("select b.id, count(pid) filter (distance < 10) as points_inside, count(pid) filter (distance < 10) > 0 as has_match from boxes b left join nears n on n.id = b.id group by b.id")
def sink_annotated_gpkg(d: Domain) -> DataFrame:
    """Masks written with what the proximity join found, and read back."""
    found = metrics.mask_proximity(d.masks.select("id", "shape", "edges", *BOX.columns()), d.points, SNAP, SNAP, edges="edges")
    rows = found.select("id", "points_inside", "has_match", "shape").mapInPandas(_wkb_masks, "id long, points_inside long, has_match boolean, geom binary")
    return _packages(d, rows, "masks_with_proximity", [("id", "INTEGER"), ("points_inside", "INTEGER"), ("has_match", "BOOLEAN")]).select("id", "points_inside", "has_match")


@query("select id, x0, y1 from boxes where cast(id as varchar) = '42'")
def scan_feature_by_id(d: Domain) -> DataFrame:
    masks = d.masks.select("id", "shape").mapInPandas(_wkb_masks, "id long, geom binary")
    return _packages(d, masks, "masks", [("id", "INTEGER")]).filter(F.col("id").cast("string") == "42").limit(1).select("id", "x0", "y1")


@query("select fid, (x1 - x0) * (y1 - y0) as area from plots where fid = 5")
def scan_feature_json(d: Domain) -> DataFrame:
    """One building as a Feature document."""
    feature = F.to_json(F.struct(F.lit("Feature").alias("type"), F.from_json(_polygon(BOX), "type string, coordinates array<array<array<double>>>").alias("geometry"), F.struct("fid").alias("properties")))
    path = d.ws.path("feature")
    d.plots.filter("fid = 5").select(feature.alias("value")).write.mode("overwrite").text(path)
    got = d.spark.read.text(path, wholetext=True).select(F.from_json("value", "geometry struct<coordinates:array<array<array<double>>>>, properties struct<fid:bigint>").alias("f"))
    ring = F.col("f.geometry.coordinates")[0]
    return got.filter("f is not null").select(F.col("f.properties.fid").alias("fid"), ((ring[2][0] - ring[0][0]) * (ring[2][1] - ring[0][1])).alias("area"))


def write_rasters(d: Domain) -> str:
    """The pixels as one GeoTIFF per raster, in a folder."""
    folder = _folder(d, "rasters")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        data = np.zeros((1, 8, 8), "uint16")
        data[0, pdf["r"].to_numpy(), pdf["c"].to_numpy()] = pdf["v"].to_numpy()
        name = f"{int(pdf['raster'].iloc[0])}.tif"
        with open(f"{folder}/{name}", "wb") as f:
            f.write(geotiff.write(geotiff.Raster(data, (0.25, 0.0, 340000.0, 0.0, -0.25, 4557000.0), 25831)))
        return pd.DataFrame({"name": [name]})

    ship(d.spark)
    d.pixels.groupBy("raster").applyInPandas(run, "name string").agg(F.count("*")).collect()
    return folder


def _rasters(d: Domain) -> DataFrame:
    return geotiff.read_chips(d.spark, write_rasters(d), (1,))


def _pixels_of(chips: DataFrame, rgb: bool) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parts = []
            for row in b.itertuples():
                image = np.frombuffer(row.data, row.dtype).reshape(row.bands, row.height, row.width)
                band = (raster.to_rgb_u8(image) if rgb else image)[0]
                r, c = np.indices(band.shape)
                parts.append(pd.DataFrame({"raster": int(row.raster_id[:-4]), "r": r.ravel(), "c": c.ravel(), "v": band.ravel().astype("int32")}))
            if parts:
                yield pd.concat(parts, ignore_index=True).astype({"r": "int32", "c": "int32"})

    return chips.filter("error is null").mapInPandas(run, "raster long, r int, c int, v int").filter("v > 0")


@query("select raster, r, c, v from pixels where v > 0")
def scan_raster(d: Domain) -> DataFrame:
    return _pixels_of(_rasters(d), rgb=False)


@query("select * from (select raster, r, c, cast(trunc(v::double / max(v) over (partition by raster) * 255) as int) as v from pixels) where v > 0")
def scan_raster_rgb(d: Domain) -> DataFrame:
    return _pixels_of(_rasters(d), rgb=True)


@query("select count(distinct raster) as files, cast(8 as bigint) as side from pixels")
def sink_geotiff(d: Domain) -> DataFrame:
    return _rasters(d).agg(F.count("raster_id").alias("files"), F.max("width").cast("long").alias("side"))


@query("""select tile, 'http://a?SERVICE=WMS&VERSION=1.3.0&REQUEST=GetMap&LAYERS=ortho&STYLES=&CRS=EPSG:25831&BBOX=' || cast(cast(x0 as bigint) as varchar) || ',' || cast(cast(y0 as bigint) as varchar) || ','
    || cast(cast(x1 as bigint) as varchar) || ',' || cast(cast(y1 as bigint) as varchar) || '&WIDTH=4000&HEIGHT=4000&FORMAT=image/tiff&TRANSPARENT=FALSE' as request from grid""")
def scan_wms_getmap(d: Domain) -> DataFrame:
    whole = Box.of(*[s.cast("long") for s in (BOX.x0, BOX.y0, BOX.x1, BOX.y1)])
    side = F.lit(4000)
    url = wms.map_url(F.lit("http://a"), F.lit("1.3.0"), F.lit("ortho"), F.lit("EPSG:25831"), whole, side, side, wms.mime_type(F.lit("geotiff")))
    return d.grid.select("tile", url.alias("request"))


def _small_or_large(url: str, timeout: float) -> bytes:
    return b"x" * (2000 if url.endswith("0") else 10)


@query("select fid, fid % 10 = 0 as fetched from buildings")
def scan_wms_building(d: Domain) -> DataFrame:
    """Answers of under 1000 bytes are errors; here a stand-in answers for the service."""
    asked = d.prosumers.select(F.col("pid").alias("fid")).select("fid", F.concat(F.lit("http://a/"), F.col("fid").cast("string")).alias("request"))
    return wms.fetched(asked, _small_or_large).select("fid", (F.col("content").isNotNull() & F.col("error").isNull()).alias("fetched"))


@query("select tile as name, 'EPSG:25831' as crs, x0, y0, x1, y1 from grid where geom_type = 'MultiPolygon'")
def scan_wms_capabilities(d: Domain) -> DataFrame:
    box = F.when(F.col("geom_type") == "MultiPolygon", F.format_string('<BoundingBox CRS="EPSG:25831" minx="%.1f" miny="%.1f" maxx="%.1f" maxy="%.1f"/>', "x0", "y0", "x1", "y1")).otherwise("")
    document = F.concat(F.lit('<WMS xmlns="http://www.opengis.net/wms"><Layer><Name>'), F.col("tile"), F.lit("</Name>"), box, F.lit("</Layer></WMS>"))
    ship(d.spark)
    return wms.layers(d.grid.select(document.alias("content")))


@query("select * from (values ('default_module', 'owlv2'), ('docker.gpu', 'true'), ('project_name', 'x')) t(key, value)")
def scan_config(d: Domain) -> DataFrame:
    path = f"{_folder(d, 'config')}/config.yaml"
    sinks.write_metadata({"project_name": "x", "default_module": "owlv2", "docker": {"gpu": True}}, path)
    return config.as_table(d.spark, config.load(path))


@query("select * from (values ('a'), ('b')) t(module)")
def scan_modules(d: Domain) -> DataFrame:
    folder = _folder(d, "modules")
    for name in "abc":
        os.makedirs(f"{folder}/{name}", exist_ok=True)
        if name != "c":
            open(f"{folder}/{name}/__init__.py", "w").close()
    return d.spark.createDataFrame([(m,) for m in config.modules(folder)], "module string")


@query(r"select distinct trim(prompt) as prompt from detections where trim(prompt) <> ''")
def scan_text_prompts(d: Domain) -> DataFrame:
    path = d.ws.path("prompts")
    lines = d.table("detections").filter("prompt is not null").select("prompt").distinct().select(F.explode(F.array(F.concat(F.lit("  "), F.col("prompt"), F.lit(" ")), F.lit(""))).alias("value"))
    lines.write.mode("overwrite").text(path)
    return config.prompts(d.spark, path).distinct()


@query("select tile, (x1 - x0) as w, coord_10k from grid")
def sink_csv(d: Domain) -> DataFrame:
    path = d.ws.path("csv")
    sinks.write_csv(d.grid.select("tile", BOX.width.alias("w"), "coord_10k"), path)
    return d.spark.read.option("header", True).schema("tile string, w double, coord_10k string").csv(path)


@query("select tile, (x1 - x0) as w, coord_10k from grid")
def sink_json(d: Domain) -> DataFrame:
    path = d.ws.path("json")
    sinks.write_json(d.grid.select("tile", BOX.width.alias("w"), "coord_10k"), path)
    return d.spark.read.schema("tile string, w double, coord_10k string").json(path)


@query("select tile as value from grid")
def sink_text_ids(d: Domain) -> DataFrame:
    path = d.ws.path("lines")
    sinks.write_lines(d.grid, "tile", path)
    return d.spark.read.text(path)


@query("select lpad(cast(srid as varchar), 6, ' ') || ' ' || rpad(tile, 12, ' ') || ' ' || rpad(geom_type, 8, ' ') as line from grid")
def sink_console(d: Domain) -> DataFrame:
    return sinks.console(d.grid, {"srid": 6, "tile": 12, "geom_type": 8})


@query("select 'owlv2' as model, cast(count(*) as bigint) as detections from boxes")
def sink_yaml_meta(d: Domain) -> DataFrame:
    path = f"{_folder(d, 'meta')}/run.yaml"
    sinks.write_metadata({"model": "owlv2", "detections": d.detections.filter("edges is not null").count()}, path)
    return d.spark.createDataFrame([config.load(path)], "model string, detections long")


@query("select printf('ortho_icgc_%.4f_%.4f_%dm', 40 + (y0 % 40000) / 1000000, 1 + (x0 % 50000) / 1000000, 1000) || '.tif' as file, cast(4 + length(tile) as bigint) as bytes from grid")
def sink_image_bytes(d: Domain) -> DataFrame:
    """One file per tile, named by its place and the service; its content is a TIFF's head and the tile's name."""
    lat, lon = F.lit(40.0) + (F.col("y0") % 40000) / 1000000, F.lit(1.0) + (F.col("x0") % 50000) / 1000000
    name = F.concat(wms.file_name(F.lit("icgc"), lat, lon, F.lit(1000)), wms.extension(wms.mime_type(F.lit("geotiff"))))
    return sinks.write_images(d.grid.select(name.alias("file"), F.concat(F.unhex(F.lit("49492A00")), F.encode("tile", "UTF-8")).alias("content")), _folder(d, "images"))
