"""python -m parcelight.cli COMMAND: tiles, summarize, analyze, evaluate, detect, run, fetch, validate, modules, config, compact.

Tables are read as Parquet, GeoJSON folders, GeoPackages or Shapefiles by the
form of their path.
"""

from __future__ import annotations

import argparse
import sys

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelight.functions.boxes import Box
from parcelight.operators import compact, metrics
from parcelight.plans import detectors, flow
from parcelight.runtime import Workspace, ship
from parcelight.sources import config, geojson, geotiff, sinks, wms
from parcelight.sources.geopackage import GeoPackage
from parcelight.sources.shapefile import Shapefile


def session() -> SparkSession:
    spark = SparkSession.builder.appName("parcelight").getOrCreate()
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)
    spark.dataSource.register(GeoPackage)
    spark.dataSource.register(Shapefile)
    return spark


def read(spark: SparkSession, path: str, layer: str | None = None) -> DataFrame:
    """A table by the form of its path."""
    if path.endswith(".gpkg"):
        source = spark.read.format("geopackage").option("pushdown", True)
        return (source.option("layer", layer) if layer else source).load(path)
    if path.endswith(".shp"):
        return spark.read.format("shapefile").load(path)
    if path.endswith(".geojson"):
        return geojson.read_grid(spark, path)
    return spark.read.parquet(path)


def read_feature(df: DataFrame, fid: str, column: str = "fid") -> DataFrame:
    """The row whose id is `fid` as text; none is an error."""
    found = df.filter(F.col(column).cast("string") == fid).limit(1)
    if found.isEmpty():
        raise LookupError(f"no feature {fid}")
    return found


def masks(spark: SparkSession, folder: str, tile_id: str | None = None) -> DataFrame:
    """Masks of a folder with their bounds, area and an id."""
    rows = geojson.read_masks(spark, folder, tile_id)
    flat = F.transform(F.regexp_extract_all("geometry", F.lit(r"\[\s*(-?[\d.eE+-]+\s*,\s*-?[\d.eE+-]+)")), lambda c: F.split(c, ","))
    rows = rows.withColumn("_c", flat)
    side = lambda f, i: f(F.transform("_c", lambda p: p[i].cast("double")))
    return rows.withColumns({"x0": side(F.array_min, 0), "y0": side(F.array_min, 1), "x1": side(F.array_max, 0), "y1": side(F.array_max, 1), "id": F.xxhash64("source_file", "feature_no"), "tile_id": F.coalesce("tile_id", "file_tile"), "region": F.coalesce("region", "file_region")}).drop("_c")


def points(spark: SparkSession, path: str) -> DataFrame:
    """Reference points (pid, x, y)."""
    df = read(spark, path)
    key = next((c for c in df.columns if c.lower() in ("id", "fid", "pid")), None)
    pid = F.col(key).cast("long") if key else F.monotonically_increasing_id()
    x, y = (F.col("x"), F.col("y")) if "x" in df.columns else (F.col("x0"), F.col("y0"))
    return df.select(pid.alias("pid"), x.alias("x"), y.alias("y"))


def tiles(a: argparse.Namespace) -> None:
    spark = session()
    grid = read(spark, a.grid)
    if a.bbox:
        grid = grid.filter(Box().touches(Box.of(*map(F.lit, a.bbox))))
    if a.status != "all":
        done = geojson.outputs(spark, a.results).filter("region = 'core'").select(F.col("tile_id").alias("coord_1k"))
        grid = grid.join(done, "coord_1k", "left_semi" if a.status == "processed" else "left_anti")
    ids = grid.select("coord_1k").orderBy("coord_1k")
    if a.export:
        print(sinks.single(ids, a.export, "lines"), "tiles")
    else:
        for r in ids.toLocalIterator():
            print(r.coord_1k)


def summarize(a: argparse.Namespace) -> None:
    spark = session()
    per_tile = metrics.tile_summary(masks(spark, a.masks).filter("file_region = 'core'" if not a.donut else "true").select("tile_id", "area_m2")).orderBy("tile_id")
    if a.output:
        sinks.single(per_tile, a.output)
    metrics.global_summary(per_tile).show()
    per_tile.orderBy(F.desc("total_area_m2"), "tile_id").limit(5).show()


def analyze(a: argparse.Namespace) -> None:
    spark = session()
    m, p = masks(spark, a.masks, a.tile_id), points(spark, a.reference)
    sinks.single(metrics.mask_proximity(m, p, a.snap, a.buffer).select("id", "source_file", "area_m2", "points_inside", "points_in_buffer", "has_match"), f"{a.output}.csv")
    sinks.single(metrics.proximity_summary(m, p, a.snap), f"{a.output}.json", "json")


def evaluate(a: argparse.Namespace) -> None:
    spark = session()
    m, p = masks(spark, a.masks), points(spark, a.reference)
    inside = metrics.mask_proximity(m, p, 1e-9, 1e-9)
    per_tile = inside.groupBy("tile_id").agg(F.count("*").alias("total_masks"), F.sum("points_inside").alias("matched"))
    sinks.single(per_tile.select("tile_id", "total_masks", "matched", *metrics.tile_metrics(F.col("matched"), F.lit(0), F.col("total_masks"))), a.output)


def detect(a: argparse.Namespace) -> None:
    spark = session()
    read = geotiff.read_chips(spark, a.rasters, (1,))
    bad = read.filter("error is not null").select("raster_id", "error")
    for r in bad.orderBy("raster_id").limit(20).collect():
        print(f"{r.raster_id}: {r.error}", file=sys.stderr)
    print(bad.count(), "unreadable rasters", file=sys.stderr)
    chips = read.filter("error is null").select(F.xxhash64("raster_id").alias("raster"), "width", "height", "dtype", "data")
    runs = detectors.run_models(chips, a.models.split(","), a.prompt or ["dark roof panel."], tuple((a.skip or "").split(",")))
    runs.write.mode("overwrite").parquet(a.output)
    detectors.model_table(spark.read.parquet(a.output)).show()


def run(a: argparse.Namespace) -> None:
    record = flow.run(session(), a.rasters, a.output, a.model, a.prompt or ["dark roof panel."], size=a.patch, overlap=a.overlap)
    print(yaml.safe_dump(record, sort_keys=False))


def fetch(a: argparse.Namespace) -> None:
    spark = session()
    services = wms.registry(spark, config.load(a.config))
    centre = spark.createDataFrame([(0, a.lon, a.lat)], "id long, lon double, lat double")
    asked = wms.requests(centre, services, a.size, a.format)
    if a.dry:
        asked.show(1, False)
    else:
        sinks.write_images(wms.fetched(asked), a.output).show(truncate=False)


def validate(a: argparse.Namespace) -> None:
    wms.validated(session().read.format("binaryFile").load(a.path)).show(truncate=False)


def modules(a: argparse.Namespace) -> None:
    print(*(config.modules(a.folder) if a.folder else detectors.models()), sep="\n")


def check_config(a: argparse.Namespace) -> None:
    wrong = config.check(config.load(a.config), detectors.models())
    print(*(wrong or ["sound"]), sep="\n")
    sys.exit(bool(wrong))


def compact_files(a: argparse.Namespace) -> None:
    spark = session()
    kept, repeats = compact.compact(Workspace(spark, "compact"), spark.read.parquet(a.files), a.target)
    print(kept.count(), "features,", repeats.count(), "repeats left out")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = parser.add_subparsers(required=True)

    def command(name: str, run, *options: tuple) -> None:
        p = sub.add_parser(name)
        for names, kw in options:
            p.add_argument(*names.split(), **kw)
        p.set_defaults(run=run)

    need = {"required": True}
    command("tiles", tiles, ("--grid", need), ("--bbox", {"nargs": 4, "type": float}), ("--status", {"choices": ["all", "processed", "pending"], "default": "all"}), ("--results", {"default": "."}), ("--export", {}))
    command("summarize", summarize, ("--masks", need), ("--donut", {"action": "store_true"}), ("--output", {}))
    command("analyze", analyze, ("--masks", need), ("--reference", need), ("--tile-id", {}), ("--snap", {"type": float, "default": 10.0}), ("--buffer", {"type": float, "default": 50.0}), ("--output", {"default": "proximity"}))
    command("evaluate", evaluate, ("--masks", need), ("--reference", need), ("--output", {"default": "metrics.csv"}))
    command("detect", detect, ("--rasters", need), ("--models", {"default": "langsam,owlv2,clipseg"}), ("--skip", {}), ("--prompt", {"action": "append"}), ("--output", need))
    command("run", run, ("--rasters", need), ("--output", need), ("--model", {"default": "langsam"}), ("--prompt", {"action": "append"}), ("--patch", {"type": int, "default": 512}), ("--overlap", {"type": int, "default": 64}))
    command("fetch", fetch, ("--config", need), ("--lat", {"type": float} | need), ("--lon", {"type": float} | need), ("--size", {"type": float, "default": 1000.0}), ("--format", {"default": "geotiff"}), ("--output", {"default": "."}), ("--dry", {"action": "store_true"}))
    command("validate", validate, ("path", {}))
    command("modules", modules, ("--folder", {}))
    command("config", check_config, ("--config", need))
    command("compact", compact_files, ("--files", need), ("--target", need))
    args = parser.parse_args(argv)
    args.run(args)


if __name__ == "__main__":
    main()
