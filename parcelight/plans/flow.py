"""The tile flow from rasters to GeoJSON: patches, detection, outlines on the ground, suppression, filters, files; what is done already is skipped."""

from __future__ import annotations

import time
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelight.functions import polygons
from parcelight.operators import raster
from parcelight.plans import detectors, pipelines
from parcelight.runtime import Workspace, exists, ship
from parcelight.sources import geojson, geotiff, sinks

_FOUND = "tile string, patch_no int, prompt string, no int, score double, geometry string, error string"


def _starts(length: int, size: int, overlap: int) -> list[int]:
    """Where patches begin; one that would pass the edge is pulled back, and none is repeated."""
    if length <= size:
        return [0]
    return sorted({min(x, length - size) for x in range(0, length, size - overlap)})


def _ring_text(ring: list[tuple[float, float]], t: list[float]) -> str:
    a, b, c, d, e, f = t
    return "(" + ", ".join(f"{a * x + b * y + c!r} {d * x + e * y + f!r}" for x, y in ring) + ")"


def _outlines(image: np.ndarray, box: tuple, dx: int, dy: int, t: list[float]) -> str:
    """A detection's geometry on the ground: the outline of the largest patch of bright pixels in its box."""
    x0, y0, x1, y1 = (int(round(v)) for v in box[:4])
    window = image[0, y0:y1, x0:x1].astype("float64")
    on = window >= (window.min() + window.max()) / 2 if window.size else np.zeros((0, 0), bool)
    largest = max(raster.regions(on), key=lambda r: r[2].sum(), default=None)
    rings = raster.outline(largest[2]) if largest else []
    if not rings:
        return "POLYGON (" + _ring_text([(x + dx, y + dy) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))], t) + ")"
    shift = [[(x + largest[0] + x0 + dx, y + largest[1] + y0 + dy) for x, y in r] for r in rings]
    area = lambda r: abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(r, r[1:])))
    shift.sort(key=area, reverse=True)  # the outer ring first, then holes
    return "POLYGON (" + ", ".join(_ring_text(r, t) for r in shift) + ")"


def found(chips: DataFrame, model: str, prompts: list[str], size: int = 512, overlap: int = 64) -> DataFrame:
    """Detections of a model in every patch of every raster, as polygons on the ground; errors are rows too.

    `chips` is as from geotiff.read_chips. Pixels of any type are scaled to
    0 to 255 by the raster's greatest value. A row is one raster, so a task
    holds one raster and cuts its patches from it.
    """
    ship(chips.sparkSession)
    factory = detectors._FACTORIES.get(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [f.split()[0] for f in _FOUND.split(", ")]
        for b in batches:
            for row in b.itertuples(index=False):
                tile, out = row.raster_id.rsplit(".", 1)[0], []
                if row.error is not None:
                    out.append((tile, None, None, None, None, None, row.error))
                else:
                    image = raster.to_rgb_u8(np.frombuffer(row.data, row.dtype).reshape(int(row.bands), int(row.height), int(row.width)))
                    corners = [(x, y) for y in _starts(image.shape[1], size, overlap) for x in _starts(image.shape[2], size, overlap)]
                    for patch, (x, y) in enumerate(corners):
                        part = image[:, y : y + size, x : x + size]
                        for prompt in prompts:
                            try:
                                if factory is None:
                                    raise LookupError(f"no model {model}")
                                for no, box in enumerate(detectors._loaded(model, factory)(part, prompt)):
                                    out.append((tile, patch, prompt, no, float(box[4]), _outlines(part, box, x, y, [float(v) for v in row.transform]), None))
                            except Exception as e:
                                out.append((tile, patch, prompt, None, None, None, f"{type(e).__name__}: {e}"))
                frame = pd.DataFrame(out, columns=columns)
                yield frame.astype({"patch_no": "Int32", "no": "Int32", "score": "float64"})

    return chips.mapInPandas(run, _FOUND)


def masks(rows: DataFrame) -> DataFrame:
    """Found polygons as masks: id, tile, region, prompt, score, area_m2, shape, edges, bounds and area."""
    key = F.xxhash64("tile", "patch_no", "prompt", "no")
    plain = rows.filter("geometry is not null").select(key.alias("id"), "tile", F.lit("core").alias("region"), "prompt", "score", "geometry")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield polygons.with_edges(b, "geometry")

    shaped = plain.mapInArrow(run, f"id long, tile string, region string, prompt string, score double, shape {polygons.TYPE}, edges {polygons.EDGES}, x0 double, y0 double, x1 double, y1 double, area double")
    return shaped.filter("edges is not null").withColumn("area_m2", F.col("area"))


def run(spark: SparkSession, rasters: str, output: str, model: str, prompts: list[str], limits: pipelines.Limits = pipelines.Limits(max_area=50_000.0, max_occupancy=0.25, tile_area=1e6), size: int = 512, overlap: int = 64) -> dict:
    """Runs the flow over a folder of GeoTIFFs and writes `{tile}_core.geojson` to `output` and the run's record to `run.yaml`; returns the record.

    A raster whose file exists is skipped before it is read, so a run that was
    stopped goes on where it was. Rasters that can't be read and patches on
    which the model fails are counted as errors and named in the record, ten at
    most. A raster without detections gets an empty file.
    """
    began = time.perf_counter()
    ws = Workspace(spark, "flow")
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.tif*").load(rasters).select("path")
    tiles = names.select(F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.tiff?$", "").alias("tile_id"))
    done = geojson.outputs(spark, output) if exists(spark, output) else spark.createDataFrame([], "tile_id string, region string")
    todo = geojson.pending(tiles, done, donuts=False)
    todo = ws.write(todo, "todo")
    rows = ws.write(found(geotiff.read_chips(spark, rasters, only=todo), model, prompts, size, overlap), "found")
    kept = pipelines.langsam_tile(ws, ws.write(masks(rows), "masks"), limits, ["tile"])
    features = kept.select(F.col("tile").alias("tile_id"), "region", "id", "score", "area_m2", "prompt", polygons.to_json(F.col("shape")).alias("geometry"))
    files = geojson.write_tiles(geojson.numbered(ws, features), output).agg(F.sum("features").alias("n"), F.count("*").alias("files")).first()
    errors = rows.filter("error is not null")
    empty = geojson.write_empty(todo.join(kept.select(F.col("tile").alias("tile_id")), "tile_id", "left_anti").join(errors.select(F.col("tile").alias("tile_id")), "tile_id", "left_anti"), output)
    record = {
        "model": model,
        "prompts": prompts,
        "rasters": tiles.count(),
        "skipped": tiles.count() - todo.count(),
        "detections_raw": rows.filter("geometry is not null").count(),
        "detections": int(files.n or 0),
        "files": int(files.files) + empty,
        "errors": errors.count(),
        "first_errors": [f"{r.tile}: {r.error}" for r in errors.select("tile", "error").orderBy("tile").limit(10).collect()],
        "thresholds": {"nms_iou": limits.nms_iou, "min_area_m2": limits.min_area, "max_area_m2": limits.max_area, "max_aspect_ratio": limits.max_aspect, "patch_px": size, "overlap_px": overlap},
        "processing_time_s": round(time.perf_counter() - began, 1),
    }
    sinks.write_metadata(record, f"{output.removeprefix('file://')}/run.yaml")
    return record
