"""Raster kernels on arrays, and raster aggregates on pixel rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def scaled_u8(value: Column, raster: list[str]) -> Column:
    """Pixel values as 0 to 255: as they are if the raster's greatest is at most 255, else by that; truncated."""
    most = F.max(value).over(Window.partitionBy(*raster))
    return F.when(most > 255, (value / most * 255).cast("int")).otherwise(value.cast("int"))


def rasterized(boxes: DataFrame, width: int, height: int, size: float) -> DataFrame:
    """(id, r, c) of the cells of a width x height grid from the origin whose centre lies in the box (edges from x0, y0 up to but without x1, y1)."""
    first = lambda low: F.greatest(F.ceil(low / size - 0.5).cast("int"), F.lit(0))
    last = lambda high, most: F.least(F.ceil(high / size - 0.5).cast("int") - 1, F.lit(most - 1))
    span = lambda low, high: F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
    rows = boxes.withColumn("r", F.explode(span(first(F.col("y0")), last(F.col("y1"), height))))
    return rows.withColumn("c", F.explode(span(first(F.col("x0")), last(F.col("x1"), width)))).select("id", "r", "c")


def labelled(mask: np.ndarray) -> np.ndarray:
    """4-connected components of a boolean array, numbered from 1 in the order of their first pixel; 0 elsewhere."""
    mask = np.asarray(mask, bool)
    labels = np.where(mask, np.arange(1, mask.size + 1).reshape(mask.shape), 0)
    while True:
        before = labels
        low = np.where(mask, labels, mask.size + 1)
        padded = np.pad(low, 1, constant_values=mask.size + 1)
        low = np.minimum.reduce([padded[1:-1, 1:-1], padded[:-2, 1:-1], padded[2:, 1:-1], padded[1:-1, :-2], padded[1:-1, 2:]])
        flat = np.append(0, np.where(mask, low, 0).ravel())
        labels = np.where(mask, flat[np.where(mask, low, 0)], 0)  # and on to the label of that pixel
        if (labels == before).all():
            break
    found, numbers = np.unique(labels[mask], return_inverse=True)
    out = np.zeros(mask.shape, "int32")
    out[mask] = numbers + 1
    return out


def blobs(mask: np.ndarray, least: int = 1) -> list[tuple[int, int, int, int, int]]:
    """(x0, y0, x1, y1, pixels) in pixel edges of each component of at least `least` pixels, by first pixel."""
    labels = labelled(mask)
    out = []
    for n in range(1, int(labels.max(initial=0)) + 1):
        r, c = np.nonzero(labels == n)
        if len(r) >= least:
            out.append((int(c.min()), int(r.min()), int(c.max()) + 1, int(r.max()) + 1, len(r)))
    return out


def outline(mask: np.ndarray) -> list[list[tuple[int, int]]]:
    """Rings along the pixel edges of a boolean array, (x, y) in pixel corners, closed, with corners only where they turn.

    Outer rings keep the pixels on one side, holes on the other; pixels that
    meet in a corner only are apart.
    """
    m = np.pad(np.asarray(mask, bool), 1)
    onward: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def add(rows, cols, x0, y0, x1, y1):
        for r, c in zip((rows - 1).tolist(), (cols - 1).tolist()):
            onward.setdefault((c + x0, r + y0), []).append((c + x1, r + y1))

    inner = np.zeros_like(m)
    inner[1:-1, 1:-1] = True
    own = m & inner
    add(*np.nonzero(own & ~np.roll(m, 1, 0)), 0, 0, 1, 0)  # nothing above: its upper edge, to the right
    add(*np.nonzero(own & ~np.roll(m, -1, 1)), 1, 0, 1, 1)
    add(*np.nonzero(own & ~np.roll(m, -1, 0)), 1, 1, 0, 1)
    add(*np.nonzero(own & ~np.roll(m, 1, 1)), 0, 1, 0, 0)
    rings = []
    while onward:
        start = min(onward)
        ring, at, step = [start], start, (0, 0)
        while True:
            ends = onward[at]
            # Where two ways go on, the turn to the right stays with the same pixel.
            right = (at[0] - step[1], at[1] + step[0])
            nxt = right if len(ends) > 1 and right in ends else ends[0]
            ends.remove(nxt)
            if not ends:
                del onward[at]
            turn = (nxt[0] - at[0], nxt[1] - at[1])
            if turn != step and at != start:
                ring.append(at)
            at, step = nxt, turn
            if at == start:
                break
        rings.append([*ring, start])
    return rings


def regions(mask: np.ndarray, least: int = 1) -> list[tuple[int, int, np.ndarray]]:
    """(x0, y0, pixels) of each component of at least `least` pixels: its place and a boolean array of its bounds."""
    labels = labelled(mask)
    out = []
    for n in range(1, int(labels.max(initial=0)) + 1):
        r, c = np.nonzero(labels == n)
        if len(r) >= least:
            out.append((int(c.min()), int(r.min()), labels[r.min() : r.max() + 1, c.min() : c.max() + 1] == n))
    return out


def vectorized(pixels: DataFrame, width: int, height: int, least: int = 1) -> DataFrame:
    """Components of the non-zero pixels (raster, r, c, v) of each raster: (raster, blob, x0, y0, x1, y1, px).

    A raster is one array of width x height, so its size is bounded.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        mask = np.zeros((height, width), bool)
        on = pdf["v"].to_numpy() != 0
        mask[pdf["r"].to_numpy()[on], pdf["c"].to_numpy()[on]] = True
        found = blobs(mask, least)
        return pd.DataFrame([(int(pdf["raster"].iloc[0]), i, *b) for i, b in enumerate(found)], columns=["raster", "blob", "x0", "y0", "x1", "y1", "px"])

    return pixels.groupBy("raster").applyInPandas(run, "raster long, blob int, x0 int, y0 int, x1 int, y1 int, px int")


def _lanczos(n_in: int, n_out: int, a: int = 3) -> np.ndarray:
    """Weights (n_out, n_in) of a Lanczos filter, widened when it shrinks."""
    scale = n_in / n_out
    wide = max(scale, 1.0)
    centre = (np.arange(n_out) + 0.5) * scale - 0.5
    x = (np.arange(n_in)[None, :] - centre[:, None]) / wide
    w = np.where(np.abs(x) < a, np.sinc(x) * np.sinc(x / a), 0.0)
    return w / w.sum(1, keepdims=True)


def resized(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bands (bands, h, w) resampled to another size; integers are rounded and kept in range."""
    out = np.einsum("yh,bhw,xw->byx", _lanczos(image.shape[1], height), image.astype("float64"), _lanczos(image.shape[2], width), optimize=True)
    if np.issubdtype(image.dtype, np.integer):
        info = np.iinfo(image.dtype)
        return np.clip(np.rint(out), info.min, info.max).astype(image.dtype)
    return out.astype(image.dtype)


def to_rgb_u8(image: np.ndarray) -> np.ndarray:
    """The first three bands, or the first one three times, as 0 to 255 by the greatest value; an all-zero raster stays zero."""
    bands = image[:3] if image.shape[0] >= 3 else np.repeat(image[:1], 3, 0)
    if bands.dtype == np.uint8:
        return bands
    most = bands.max(initial=0)
    return (bands / most * 255).astype("uint8") if most > 0 else bands.astype("uint8")


def inside_ring(ring: list[tuple[float, float]], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether points lie inside a closed ring, by crossings."""
    p = np.asarray(ring, "float64")
    inside = np.zeros(np.broadcast(x, y).shape, bool)
    for (ax, ay), (bx, by) in zip(p[:-1], p[1:]):
        if ay != by:
            inside ^= ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay) + ax)
    return inside


def pixel_mask(ring: list[tuple[float, float]], transform: tuple[float, ...], height: int, width: int) -> np.ndarray:
    """Pixels of a grid whose centre lies inside a ring; transform is (a, b, c, d, e, f)."""
    a, b, c, d, e, f = transform
    col, row = np.meshgrid(np.arange(width) + 0.5, np.arange(height) + 0.5)
    return inside_ring(ring, a * col + b * row + c, d * col + e * row + f)


def clipped(image: np.ndarray, transform: tuple[float, ...], ring: list[tuple[float, float]], least_data: float = 0.05) -> tuple[np.ndarray, tuple[float, ...]] | None:
    """The window of a north-up raster around a ring, zero outside it, with its transform.

    None if the ring's bounds miss the raster or, with four or more bands, less
    than `least_data` of the window has a non-zero fourth band.
    """
    a, _, c, _, e, f = transform
    xs, ys = [p[0] for p in ring], [p[1] for p in ring]
    h, w = image.shape[1:]
    c0, c1 = max(0, int(np.floor((min(xs) - c) / a))), min(w, int(np.ceil((max(xs) - c) / a)))
    r0, r1 = max(0, int(np.floor((max(ys) - f) / e))), min(h, int(np.ceil((min(ys) - f) / e)))
    if c0 >= c1 or r0 >= r1:
        return None
    moved = (a, 0.0, c + a * c0, 0.0, e, f + e * r0)
    window = np.where(pixel_mask(ring, moved, r1 - r0, c1 - c0), image[:, r0:r1, c0:c1], 0).astype(image.dtype)
    if window.shape[0] >= 4 and np.count_nonzero(window[3]) / window[3].size < least_data:
        return None
    return window, moved


def masked(image: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """All bands, zero where the mask is."""
    return np.where(mask, image, 0).astype(image.dtype)


def map_chips(chips: DataFrame, kernel, schema: str) -> DataFrame:
    """Runs kernel(row as dict) -> rows over chips, one at a time, in Arrow batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [f.split()[0] for f in schema.split(", ")]
        for b in batches:
            yield pd.DataFrame([r for row in b.to_dict("records") for r in kernel(row)], columns=columns)

    return chips.mapInPandas(run, schema)
