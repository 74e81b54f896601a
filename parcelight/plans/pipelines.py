"""Detection pipelines: the orders in which filters, suppression and merging follow each other.

Suppression doesn't commute with the filters, so each order is a query of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelight.functions.boxes import Box
from parcelight.operators.sweep import near_pairs, near_shapes, overlaps, rows_near, shape_overlaps
from parcelight.operators.suppress import dissolved, nms
from parcelight.runtime import Workspace


@dataclass(frozen=True)
class Limits:
    """Thresholds of a pipeline; areas in m2, merge_m in m."""

    nms_iou: float = 0.3
    min_area: float = 0.5
    max_area: float = 10.0
    max_aspect: float = 4.0
    max_occupancy: float = 0.05
    tile_area: float = 512 * 512 * 0.0625
    merge_m: float = 1.0


def _area(df: DataFrame) -> Column:
    """The area inside the edges, or that of the box where a table has none."""
    return F.col("area") if "area" in df.columns else Box().area


def _edges(df: DataFrame) -> str | None:
    return "edges" if "edges" in df.columns else None


def by_area(df: DataFrame, limits: Limits) -> DataFrame:
    return df.filter(_area(df).between(limits.min_area, limits.max_area))


def by_aspect(df: DataFrame, limits: Limits) -> DataFrame:
    return df.filter(Box().aspect <= limits.max_aspect)


def by_occupancy(df: DataFrame, limits: Limits) -> DataFrame:
    return df.filter(_area(df) <= limits.tile_area * limits.max_occupancy)


def by_building(df: DataFrame, buildings: DataFrame, distance: float = 0.0) -> DataFrame:
    """Detections at most `distance` from a footprint, by the edges of both if they have them."""
    return rows_near(df, buildings, distance, _edges(df))


def langsam_tile(ws: Workspace, df: DataFrame, limits: Limits, within: list[str]) -> DataFrame:
    """Suppression, area, aspect, occupancy, suppression."""
    kept = nms(ws, df, limits.nms_iou, within, name="first", edges=_edges(df))
    kept = by_occupancy(by_aspect(by_area(kept, limits), limits), limits)
    return nms(ws, kept, limits.nms_iou, within, name="second", edges=_edges(df))


def langsam_file(ws: Workspace, df: DataFrame, limits: Limits, within: list[str]) -> DataFrame:
    """Area, aspect, merging by half the distance; each row with its blob."""
    return dissolved(ws, by_aspect(by_area(df, limits), limits), limits.merge_m / 2, within, _edges(df))


def owlv2(ws: Workspace, df: DataFrame, limits: Limits, within: list[str]) -> DataFrame:
    """Suppression, area, occupancy, aspect; also for the segmentation model."""
    return by_aspect(by_occupancy(by_area(nms(ws, df, limits.nms_iou, within, edges=_edges(df)), limits), limits), limits)


def phase2(ws: Workspace, df: DataFrame, buildings: DataFrame, limits: Limits, within: list[str]) -> DataFrame:
    """Suppression, area, aspect, at most 2 m from the building."""
    return by_building(by_aspect(by_area(nms(ws, df, limits.nms_iou, within, edges=_edges(df)), limits), limits), buildings, 2.0)


def phase3(df: DataFrame, negatives: DataFrame, buildings: DataFrame, within: list[str], most: float = 0.3) -> DataFrame:
    """Each candidate with its fate: outside the building, overlapped by a negative by more than `most` of its area, or kept."""
    slim = lambda rows: rows.select("id", *within, "x0", "y0", "x1", "y1", _area(rows).alias("area"), *([_edges(df)] if _edges(df) else []))
    edges, kind = _edges(df), dict(df.dtypes)["id"]

    def compare(rows: pa.RecordBatch, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
        common, area = overlaps(rows, i, j), rows.column("area").to_numpy()
        near = (common > 0) & (common > most * area[i] * (1 - 1e-6) - 1e-6 if edges else common > most * area[i])
        i, j = i[near], j[near]
        if edges:
            i = i[shape_overlaps(rows, edges, i, j) > most * area[i]]
        return pa.RecordBatch.from_arrays([rows.column("id").take(pa.array(np.unique(i)))], ["id"])

    overlapped = near_pairs(slim(df), slim(negatives), compare, f"id {kind}", within).distinct()
    touching = near_shapes(df, buildings.withColumnRenamed("fid", "id"), 0.0, edges).select("id").distinct()
    flags = df.join(touching.withColumn("_in", F.lit(True)), "id", "left").join(overlapped.withColumn("_neg", F.lit(True)), "id", "left")
    return flags.withColumn("fate", F.when(F.col("_in").isNull(), "outside").when(F.col("_neg"), "negative").otherwise("kept")).drop("_in", "_neg")


def phase4(ws: Workspace, df: DataFrame, buildings: DataFrame, within: list[str], iou: float = 0.5, low: float = 0.5, high: float = 2000.0) -> DataFrame:
    """Building, area, suppression."""
    near = ws.write(by_building(df.filter(_area(df).between(low, high)), buildings), "near")
    return nms(ws, near, iou, within, edges=_edges(df))
