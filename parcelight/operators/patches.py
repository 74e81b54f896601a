"""Overlapping patches of rasters, and the ring around a tile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelight.functions.boxes import Box


def _starts(length: Column, stride: int) -> Column:
    return F.sequence(F.lit(0), length - 1, F.lit(stride))


def patch_grid(rasters: DataFrame, size: int, overlap: int, shifted: bool = True, least: int = 1) -> DataFrame:
    """One row per patch: the raster's columns, patch_no (by rows, from 0), px, py, pw, ph.

    Patches start every size - overlap pixels. A patch that would pass the
    edge is pulled back to keep its size (`shifted`; two may then be the
    same), or cut there. Patches with a side below `least` are left out, the
    numbers of the others stay. A raster without pixels has none.
    """
    if not 0 <= overlap < size:
        raise ValueError("the overlap must be less than the size")
    stride = size - overlap
    rows = rasters.filter("w > 0 and h > 0").select("*", F.posexplode(_starts(F.col("h"), stride)).alias("_ny", "_y")).select("*", F.posexplode(_starts(F.col("w"), stride)).alias("_nx", "_x"))
    per_row = F.ceil(F.col("w") / stride)
    x2, y2 = F.least(F.col("_x") + size, F.col("w")), F.least(F.col("_y") + size, F.col("h"))
    x1 = F.greatest(F.lit(0), x2 - size) if shifted else F.col("_x")
    y1 = F.greatest(F.lit(0), y2 - size) if shifted else F.col("_y")
    out = rows.select(*rasters.columns, (F.col("_ny") * per_row + F.col("_nx")).cast("int").alias("patch_no"), x1.alias("px"), y1.alias("py"), (x2 - x1).alias("pw"), (y2 - y1).alias("ph"))
    return out.filter(F.least("pw", "ph") >= least)


def tiled(rasters: DataFrame, size: int, overlap: int, enabled: bool = True) -> DataFrame:
    """patch_grid, but a raster that fits in one patch (or any, if tiling is off) is one patch as it is."""
    whole = F.lit(True) if not enabled else (F.col("w") <= size) & (F.col("h") <= size)
    single = rasters.filter(whole).select("*", F.lit(0).alias("patch_no"), F.lit(0).alias("px"), F.lit(0).alias("py"), F.col("w").alias("pw"), F.col("h").alias("ph"))
    return single if not enabled else single.unionByName(patch_grid(rasters.filter(~whole), size, overlap))


def donut_area(tile: Box, fraction: float, side: float = 1000.0) -> Column:
    """Area of the ring that a dilation with square corners adds to a tile."""
    return tile.grown(side * fraction).area - tile.area


def in_donut(tile: Box, x: Column, y: Column, fraction: float, side: float = 1000.0) -> Column:
    """Whether a point is in the ring around a tile, its outer edge included, the tile itself excluded."""
    outer = tile.grown(side * fraction)
    inside = lambda b: x.between(b.x0, b.x1) & y.between(b.y0, b.y1)
    return inside(outer) & ~inside(tile)


def with_donuts(tiles: DataFrame, fraction: float = 0.25, side: float = 1000.0) -> DataFrame:
    """Each tile (x0, y0, x1, y1) twice: its core, and its donut with the outer box; `area` is that of the region."""
    d, box = side * fraction, Box()
    regions = F.array(F.struct(F.lit("core").alias("region"), F.lit(0.0).alias("d")), F.struct(F.lit("donut").alias("region"), F.lit(d).alias("d")))
    rows = tiles.withColumn("_r", F.explode(regions))
    outer = box.grown(F.col("_r.d"))
    area = F.when(F.col("_r.d") > 0, outer.area - box.area).otherwise(box.area)
    return rows.select(*[c for c in tiles.columns if c not in ("x0", "y0", "x1", "y1")], F.col("_r.region").alias("region"), *outer.columns(), area.alias("area"))
