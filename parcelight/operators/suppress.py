"""Non-maximum suppression and dissolving, over pairs of boxes or polygons."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.functions.boxes import Box, cells
from parcelight.operators.components import components, hot_keys, roots, spread_join
from parcelight.operators.sweep import CELL, ROWS, areas, near_pairs, overlaps, shape_overlaps, whole_groups, within_distance
from parcelight.operators.unions import union_areas
from parcelight.runtime import Workspace


def nms(ws: Workspace, boxes: DataFrame, threshold: float, within: list[str] = (), mode: str = "greedy", name: str = "nms", edges: str | None = None) -> DataFrame:
    """The boxes (id, x0, y0, x1, y1, score, ...) that greedy suppression keeps.

    Boxes are ranked by score, then id, in each group of `within`. A box is
    dropped if a kept one ranks above it and their IoU is above `threshold`;
    an IoU of exactly the threshold is kept. With `edges`, a column of edges,
    the IoU is that of the areas inside them. Mode `index_guard` lets a box
    drop only boxes with a greater id. A null score ranks last.

    Only pairs above the threshold take part. They are sorted into connected
    groups, and each group is decided in the order of rank as a stream of its
    pairs, so chains of any length take one pass. A group of more than
    GROUP_PAIRS pairs is decided in rounds instead: what ranks first in all its
    pairs is kept and drops the others, until no pair is left.
    """
    if mode not in ("greedy", "index_guard"):
        raise ValueError(mode)
    slim = boxes.select("id", *within, "x0", "y0", "x1", "y1", F.coalesce("score", F.lit(-math.inf)).alias("score"), *([edges] if edges else []))
    kind = dict(slim.dtypes)

    def compare(rows: pa.RecordBatch, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
        ids, score, common = rows.column("id").to_numpy(), rows.column("score").to_numpy(), overlaps(rows, i, j)
        score = np.where(np.isnan(score), np.inf, score)  # as Spark sorts it
        area = areas(rows, edges)
        # The boxes' common area is at least that of the shapes.
        near = (common > 0) & (common * (1 + 1e-6) + 1e-6 > threshold * (area[i] + area[j] - common)) if edges else common > threshold * (area[i] + area[j] - common)
        i, j = i[near], j[near]
        if edges:
            common = shape_overlaps(rows, edges, i, j)
            near = common > threshold * (area[i] + area[j] - common)
            i, j = i[near], j[near]
        turned = (score[j] > score[i]) | ((score[i] == score[j]) & (ids[j] < ids[i]))
        w, l = np.where(turned, j, i), np.where(turned, i, j)
        ranked = ids[w] < ids[l] if mode == "index_guard" else ids[w] != ids[l]
        w, l = w[ranked], l[ranked]
        return pa.RecordBatch.from_arrays([pa.array(ids[w]), pa.array(score[w]), pa.array(ids[l])], ["w", "score", "l"])

    pairs = near_pairs(slim, None, compare, f"w {kind['id']}, score {kind['score']}, l {kind['id']}", within)
    open_, n = ws.write_counting(pairs, f"{name}-pairs", "true")
    return boxes.join(_dropped(ws, open_, n, name), "id", "left_anti") if n else boxes


#: Pairs of a connected group that one task decides.
GROUP_PAIRS = 5_000_000


def _dropped(ws: Workspace, pairs: DataFrame, n: int, name: str) -> DataFrame:
    """(id): what is dropped, given n pairs (w, score, l) of which w ranks above l."""
    groups = components(ws, pairs.select(F.col("w").alias("u"), F.col("l").alias("v")), name).withColumnRenamed("id", "w")
    grouped = spread_join(pairs, groups, "w", hot_keys(pairs, "w", n))
    large = []
    if n > GROUP_PAIRS:
        grouped = ws.write(grouped, f"{name}-grouped")
        large = [r[0] for r in grouped.groupBy("group_id").agg(F.count("*").alias("n")).filter(F.col("n") > GROUP_PAIRS).collect()]  # n / GROUP_PAIRS at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, dropped = None, set()
        for b in batches:
            lost = []
            for g, w, other in zip(*(c.to_pylist() for c in b.columns)):
                if g != group:
                    group, dropped = g, set()
                if w not in dropped and other not in dropped:
                    dropped.add(other)
                    lost.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(lost, pa.int64())], ["id"])

    small = grouped.filter(~F.col("group_id").isin(large)) if large else grouped
    ordered = small.repartition("group_id").sortWithinPartitions("group_id", F.desc("score"), "w")
    lost = ordered.select("group_id", "w", "l").mapInArrow(run, "id long")
    return lost.unionAll(_in_rounds(ws, grouped.filter(F.col("group_id").isin(large)).select("w", "l"), name)) if large else lost


def _in_rounds(ws: Workspace, pairs: DataFrame, name: str) -> DataFrame:
    """(id): what is dropped, in as many rounds as the longest chain of decisions; what was found before is one written table."""
    open_, n = ws.write_counting(pairs, f"{name}-open-0", "true")
    dropped, turn = ws.write(pairs.select(F.col("l").alias("id")).limit(0), f"{name}-dropped-0"), 0
    while n:
        turn += 1
        first = open_.join(open_.select(F.col("l").alias("w")).distinct(), "w", "left_anti")
        lost = ws.write(first.select(F.col("l").alias("id")).distinct(), f"{name}-lost-{turn}")
        still = open_.join(first.select("w").distinct(), "w", "left_anti").join(lost.withColumnRenamed("id", "l"), "l", "left_anti").join(lost.withColumnRenamed("id", "w"), "w", "left_anti")
        open_, n = ws.write_counting(still, f"{name}-open-{turn}", "true")
        dropped = dropped.unionAll(lost)
        if turn % 8 == 0:
            dropped = ws.write(dropped, f"{name}-dropped-{turn}")
        ws.drop(f"{name}-open-{turn - 1}")
    return dropped


#: Pairs that are compared before those of joined boxes are left out.
FIRST_PAIRS = 4096


def dissolved(ws: Workspace, boxes: DataFrame, buffer: float, within: list[str] = (), edges: str | None = None) -> DataFrame:
    """The boxes with blob_id, the least id of all boxes that they join when each is dilated by `buffer` with round corners.

    Two boxes join if their gap is at most 2 buffers; with `edges`, a column of
    edges, it is the gap of the areas inside them. With a buffer of 0 or less
    nothing joins.
    """
    if buffer <= 0:
        return boxes.withColumn("blob_id", F.col("id"))
    slim = boxes.select("id", *within, "x0", "y0", "x1", "y1", *([edges] if edges else []))

    def compare(rows: pa.RecordBatch, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
        ids, group = rows.column("id").to_numpy(), np.arange(len(rows))
        order = np.argsort(-overlaps(rows, i, j), kind="stable")  # what lies over each other most likely joins
        i, j = i[order], j[order]
        found, low, high = [], 0, max(FIRST_PAIRS, len(rows))
        while low < len(i):  # pairs of boxes that others have joined aren't compared
            a, b = i[low:high], j[low:high]
            apart = group[a] != group[b]
            a, b = within_distance(rows, a[apart], b[apart], 2 * buffer, edges)
            found.append((a, b))
            if len(a):
                joined, root = roots(group[a], group[b])
                above = np.arange(len(rows))
                above[joined] = root
                group = above[group]
            low, high = high, high + 2 * (high - low)
        i, j = (np.concatenate(side) for side in zip(*found)) if found else (i, j)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[i], ids[j])), pa.array(np.maximum(ids[i], ids[j]))], ["u", "v"])

    kind = dict(slim.dtypes)["id"]
    found = components(ws, near_pairs(slim, None, compare, f"u {kind}, v {kind}", within, buffer))
    return boxes.join(found, "id", "left").withColumn("blob_id", F.coalesce("group_id", "id")).drop("group_id")


def dilated_area(x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray, d: float, steps: int = 32) -> float:
    """Area of the union of boxes dilated by d with round corners.

    Integrates the covered length over y, by Gauss-Legendre rules between the
    heights at which an edge or corner begins.
    """
    if len(x0) == 1:
        w, h = float(x1[0] - x0[0]), float(y1[0] - y0[0])
        return w * h + 2 * d * (w + h) + math.pi * d * d
    ys = np.unique(np.concatenate([y0 - d, y0, y1, y1 + d]))
    nodes, weights = np.polynomial.legendre.leggauss(steps if d > 0 else 1)
    total = 0.0
    for low, high in zip(ys[:-1], ys[1:]):
        hit = (y0 - d < high) & (y1 + d > low)
        if not hit.any():
            continue
        angle = (nodes + 1) * np.pi / 2
        at = low + (high - low) * (1 - np.cos(angle)) / 2  # dense where arcs begin
        weight = weights * np.sin(angle)
        weight *= (high - low) / weight.sum()
        off = np.maximum(np.maximum(y0[hit, None] - at, at - y1[hit, None]), 0.0)
        reach = np.sqrt(np.maximum(d * d - off * off, 0.0))
        left, right = x0[hit, None] - reach, x1[hit, None] + reach
        order = np.argsort(left, axis=0)
        left, right = np.take_along_axis(left, order, 0), np.take_along_axis(right, order, 0)
        ends = np.maximum.accumulate(right, 0)
        before = np.vstack([np.full((1, len(at)), -np.inf), ends[:-1]])
        total += float((np.maximum(right - np.maximum(left, before), 0.0).sum(0) * weight).sum())
    return total


#: Cells of the longest box, a side.
MOST_CELLS = 64


def blobs(boxes: DataFrame, buffer: float, within: list[str] = (), min_area: float | None = None) -> DataFrame:
    """One row per blob of `dissolved`: its boxes' number, dilated area, bounds and greatest score.

    Blobs below `min_area` are left out. A blob's area is summed over cells, so
    no task gets a whole blob, and what a cell takes grows with its boxes only.
    """

    d = max(buffer, 0.0)
    most = boxes.agg(F.max(F.greatest(Box().width, Box().height))).first()[0] or 0.0
    size = max(CELL, most / MOST_CELLS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["blob_id", "cx", "cy"], ROWS):
            blob, cx, cy, *sides = (c.to_numpy() for c in rows.columns)
            new = np.append(True, (blob[1:] != blob[:-1]) | (cx[1:] != cx[:-1]) | (cy[1:] != cy[:-1]))
            x, y = cx[new] * size, cy[new] * size
            areas = union_areas(np.stack(sides, 1), np.cumsum(new) - 1, np.stack([x, y, (cx[new] + 1) * size, (cy[new] + 1) * size], 1), d)
            yield pa.RecordBatch.from_arrays([pa.array(blob[new]), pa.array(areas)], ["blob_id", "area"])

    placed = boxes.select("blob_id", F.explode(cells(Box().grown(d), size)).alias("_cell"), "x0", "y0", "x1", "y1").select("blob_id", "_cell.cx", "_cell.cy", "x0", "y0", "x1", "y1")
    slim = placed.repartition("blob_id", "cx", "cy").sortWithinPartitions("blob_id", "cx", "cy")
    areas = slim.mapInArrow(run, f"blob_id {dict(boxes.dtypes)['blob_id']}, area double").groupBy("blob_id").agg(F.sum("area").alias("area"))
    whole = boxes.groupBy(*within, "blob_id").agg(F.count("*").alias("n"), (F.min("x0") - d).alias("x0"), (F.min("y0") - d).alias("y0"), (F.max("x1") + d).alias("x1"), (F.max("y1") + d).alias("y1"), F.max("score").alias("score"))
    out = whole.join(areas, "blob_id", "left")
    return out.filter(F.col("area") >= min_area) if min_area is not None else out
