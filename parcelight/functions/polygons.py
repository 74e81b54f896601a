"""Polygons as columns: parsing, area, containment, distance and intersection, for any rings, holes and parts.

A geometry is an array of polygons, each an array of rings (the first one
outside, the others holes), each an array of corners (x, y). Most predicates
need its edges only: an array of (ax, ay, bx, by) with the inside on the left.
Both are made and compared in Arrow batches: all edges of a batch, or all pairs
of edges, are one operation on arrays.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelight.functions.boxes import Box

TYPE = "array<array<array<struct<x:double,y:double>>>>"
EDGES = "array<struct<ax:double,ay:double,bx:double,by:double>>"
_POLYGON = re.compile(r"\(\s*\([^()]*\)(?:\s*,\s*\([^()]*\))*\s*\)")
_RING = re.compile(r"\(([^()]+)\)")
_WKT = re.compile(r"\s*(?:SRID\s*=\s*\d+\s*;)?\s*(?:MULTI)?POLYGON\s*(?:Z|M|ZM)?\s*\(.*\)\s*\Z", re.I | re.S)
_CORNER = pa.struct([("x", pa.float64()), ("y", pa.float64())])
_EDGE = pa.struct([(n, pa.float64()) for n in ("ax", "ay", "bx", "by")])
#: Pairs of edges that are compared at once.
CHUNK = 1 << 20


def _corner(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


# --- texts to shapes ----------------------------------------------------------


def _wkt_rings(text: str) -> list[list] | None:
    """Corners of each ring of each polygon of a WKT text; None if it isn't such a text."""
    if not _WKT.match(text):
        return None
    return [[[c.split()[:2] for c in ring.split(",")] for ring in _RING.findall(p)] for p in _POLYGON.findall(text)]


def _json_rings(text: str) -> list[list] | None:
    try:
        g = json.loads(text)
        return {"Polygon": lambda c: [c], "MultiPolygon": lambda c: c}[g["type"]](g["coordinates"])
    except (ValueError, TypeError, KeyError, RecursionError):
        return None


def parsed(text: str | None) -> list[list[list[tuple[float, float]]]] | None:
    """The geometry of a text in WKT, EWKT or GeoJSON; None where there is no area: null, empty, unreadable or of another kind.

    Every ring has three corners or more, and every corner two finite
    ordinates; further ones are left out.
    """
    if not text:
        return None
    found = _json_rings(text) if text.lstrip().startswith("{") else _wkt_rings(text)
    try:
        shape = [[[(float(c[0]), float(c[1])) for c in ring] for ring in polygon] for polygon in found or []]
    except (ValueError, TypeError, IndexError, KeyError):
        return None
    rings = [r for p in shape for r in p]
    sound = rings and all(len(r) >= 3 and all(abs(v) < float("inf") for c in r for v in c) for r in rings)
    return shape if sound and all(shape) else None


def shapes(texts: pa.Array) -> pa.Array:
    """parsed() over a batch. If it has only single rings of corners with two ordinates, as nearly all are, they go through one conversion."""
    rows, flat, counts = texts.to_pylist(), [], []
    plain: list[int] = []
    others = False
    for i, text in enumerate(rows):
        rings = _RING.findall(text) if text and text[:1] in "PpMm" and text.count("(") <= 3 and _WKT.match(text) else []
        if len(rings) == 1 and len(rings[0].replace(",", " ").split()) == 2 * (rings[0].count(",") + 1) >= 6:
            plain.append(i)
            flat.append(rings[0])
            counts.append(rings[0].count(",") + 1)
        elif text and parsed(text) is not None:
            others = True
            break
    try:
        values = np.array(",".join(flat).replace(",", " ").split(), "float64")
        # Ordinates may be unevenly spread over corners, so what isn't plain text is read by itself.
        others = others or not np.isfinite(values).all() or any(" " not in c.strip() for t in flat for c in t.split(","))
    except ValueError:
        others = True
    if others or not plain:
        return pa.array([None if s is None else [[[{"x": x, "y": y} for x, y in r] for r in p] for p in s] for s in map(parsed, rows)], pa.list_(pa.list_(pa.list_(_CORNER))))
    corners = pa.StructArray.from_arrays([pa.array(values[0::2]), pa.array(values[1::2])], fields=list(_CORNER))
    has = np.zeros(len(rows), bool)
    has[plain] = True
    rings = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype("int32")), corners)
    parts = pa.ListArray.from_arrays(pa.array(np.arange(len(plain) + 1, dtype="int32")), rings)
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(has)).astype("int32")), parts, mask=pa.array(~has))


# --- edges --------------------------------------------------------------------


def edges_of(shape: pa.Array) -> pa.Array:
    """All edges of each geometry, outer rings anticlockwise and holes clockwise, those without length left out."""
    n = len(shape)
    valid = np.asarray(shape.is_valid())
    parts = shape.values if n else pa.array([], shape.type.value_type)
    rings = parts.values
    o0, o1, o2 = (np.asarray(x.offsets).astype("int64") if len(x) else np.zeros(1, "int64") for x in (shape, parts, rings))
    x, y = (np.asarray(rings.values.field(k)) for k in ("x", "y"))
    o0 = np.where(np.append(valid, True), o0, o0) if n else o0
    count = np.diff(o2)
    ring = np.repeat(np.arange(len(count)), count)
    following = np.arange(o2[0], o2[-1]) + 1
    following[o2[1:][count > 0] - 1 - o2[0]] = o2[:-1][count > 0]
    own = slice(o2[0], o2[-1])
    ax, ay, bx, by = x[own], y[own], x[following], y[following]
    fx, fy = x[np.minimum(o2[:-1], max(len(x) - 1, 0))][ring] if len(x) else ax, y[np.minimum(o2[:-1], max(len(y) - 1, 0))][ring] if len(y) else ay
    twice = np.bincount(ring, (ax - fx) * (by - fy) - (bx - fx) * (ay - fy), len(count))
    hole = np.ones(len(count), bool)
    hole[o1[:-1][np.diff(o1) > 0] - o1[0]] = False
    back = ((twice < 0) != hole)[ring] if len(ring) else np.zeros(0, bool)
    ax, bx, ay, by = np.where(back, bx, ax), np.where(back, ax, bx), np.where(back, by, ay), np.where(back, ay, by)
    long = (ax != bx) | (ay != by)
    row_start = o2[o1[o0] - o1[0]] - o2[0] if n else np.zeros(1, "int64")
    starts = np.append(0, np.cumsum(long))[row_start]
    flat = pa.StructArray.from_arrays([pa.array(v[long]) for v in (ax, ay, bx, by)], fields=list(_EDGE))
    return pa.ListArray.from_arrays(pa.array(starts.astype("int32")), flat, mask=pa.array(~valid)) if n else pa.array([], pa.list_(_EDGE))


class Edges:
    """Edges of a batch of geometries: rows start at `start` and have `count` of the flat arrays."""

    def __init__(self, array: pa.Array):
        offsets = np.asarray(array.offsets).astype("int64") if len(array) else np.zeros(1, "int64")
        self.valid = np.asarray(array.is_valid())
        self.start, self.count = offsets[:-1], np.where(self.valid, np.diff(offsets), 0)
        self.ax, self.ay, self.bx, self.by = (np.asarray(array.values.field(k)) for k in ("ax", "ay", "bx", "by"))

    def at(self, i: np.ndarray) -> tuple[np.ndarray, ...]:
        return self.ax[i], self.ay[i], self.bx[i], self.by[i]


def _runs(sizes: np.ndarray) -> Iterator[slice]:
    """Rows whose sizes add up to CHUNK or less, or single rows."""
    ends, low = np.cumsum(sizes), 0
    while low < len(sizes):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + CHUNK, "right")))
        yield slice(low, high)
        low = high


def _ragged(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place within the row) of rows of so many items."""
    row = np.repeat(np.arange(len(count)), count)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)


def each_edge(e: Edges, kernel: Callable, *values: np.ndarray) -> np.ndarray:
    """kernel(n, row, (ax, ay, bx, by), values of the row) -> a number per row, over all edges of each row."""
    out = []
    for s in _runs(e.count):
        row, k = _ragged(e.count[s])
        out.append(kernel(s.stop - s.start, row, e.at(e.start[s][row] + k), *(v[s][row] for v in values)))
    return np.concatenate(out) if out else np.zeros(0)


def each_pair(a: Edges, b: Edges, kernel: Callable, *values: np.ndarray) -> np.ndarray:
    """The same over all pairs of an edge of each row of a and one of the same row of b."""
    out = []
    for s in _runs(a.count * b.count):
        row, k = _ragged(a.count[s] * b.count[s])
        cb = b.count[s][row]
        i, j = a.start[s][row] + k // np.maximum(cb, 1), b.start[s][row] + k % np.maximum(cb, 1)
        out.append(kernel(s.stop - s.start, row, a.at(i), b.at(j), *(v[s][row] for v in values)))
    return np.concatenate(out) if out else np.zeros(0)


def _least(n: int, row: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.full(n, np.inf)
    np.minimum.at(out, row, values)
    return out


def _any(n: int, row: np.ndarray, flags: np.ndarray) -> np.ndarray:
    return np.bincount(row[flags], minlength=n) > 0


def _crossings(n, row, e, x, y):
    """Whether a point is inside, by crossings."""
    ax, ay, bx, by = e
    spans = (ay > y) != (by > y)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.bincount(row[spans & (x < (bx - ax) * (y - ay) / (by - ay) + ax)], minlength=n) % 2 == 1


def _touching(n, row, e, x, y):
    """Whether a point is on an edge."""
    ax, ay, bx, by = e
    on = ((bx - ax) * (y - ay) - (by - ay) * (x - ax) == 0) & (x >= np.minimum(ax, bx)) & (x <= np.maximum(ax, bx)) & (y >= np.minimum(ay, by)) & (y <= np.maximum(ay, by))
    return _any(n, row, on)


def _off(e, x, y):
    ax, ay, bx, by = e
    dx, dy = bx - ax, by - ay
    t = np.clip(((x - ax) * dx + (y - ay) * dy) / (dx * dx + dy * dy), 0.0, 1.0)
    return np.hypot(x - ax - t * dx, y - ay - t * dy)


def _strips(n, row, e, f, x, y):
    """Each area is the sum of the signed strips between its edges and the line y. So the common area is that of all pairs of strips: the integral of the lower of two edges over the x that both span."""
    (eax, eay, ebx, eby), (fax, fay, fbx, fby) = e, f
    low, high = np.maximum(np.minimum(eax, ebx), np.minimum(fax, fbx)), np.minimum(np.maximum(eax, ebx), np.maximum(fax, fbx))
    k = np.flatnonzero(low < high)
    row, low, high, y = row[k], low[k], high[k], y[k]
    (eax, eay, ebx, eby), (fax, fay, fbx, fby) = ((v[k] for v in side) for side in (e, f))
    at = lambda ax, ay, bx, by, v: (ay - y) + (by - ay) * (v - ax) / (bx - ax)
    e0, e1, f0, f1 = at(eax, eay, ebx, eby, low), at(eax, eay, ebx, eby, high), at(fax, fay, fbx, fby, low), at(fax, fay, fbx, fby, high)
    d0, d1 = e0 - f0, e1 - f1
    with np.errstate(divide="ignore", invalid="ignore"):
        gap = np.where(d0 * d1 >= 0, np.abs(d0 + d1) / 2, (d0 * d0 + d1 * d1) / (2 * (np.abs(d0) + np.abs(d1))))
    return np.bincount(row, np.sign(eax - ebx) * np.sign(fax - fbx) * (high - low) * ((e0 + e1 + f0 + f1) / 4 - gap / 2), n)


def _edges_cross(n, row, e, f):
    (eax, eay, ebx, eby), (fax, fay, fbx, fby) = e, f
    side = lambda ax, ay, bx, by, px, py: np.sign((bx - ax) * (py - ay) - (by - ay) * (px - ax))
    near = (np.minimum(eax, ebx) <= np.maximum(fax, fbx)) & (np.minimum(fax, fbx) <= np.maximum(eax, ebx)) & (np.minimum(eay, eby) <= np.maximum(fay, fby)) & (np.minimum(fay, fby) <= np.maximum(eay, eby))
    return _any(n, row, near & (side(*e, fax, fay) * side(*e, fbx, fby) <= 0) & (side(*f, eax, eay) * side(*f, ebx, eby) <= 0))


def _holds_corner(a: Edges, b: Edges) -> np.ndarray:
    """Whether a corner of b is inside a."""
    out = np.zeros(len(a.count), bool)
    for s in _runs(a.count * b.count):
        row, k = _ragged(a.count[s] * b.count[s])
        cb = np.maximum(b.count[s][row], 1)
        corner = b.start[s][row] + k % cb
        ax, ay, bx, by = a.at(a.start[s][row] + k // cb)
        x, y = b.ax[corner], b.ay[corner]
        with np.errstate(divide="ignore", invalid="ignore"):
            hit = ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay) + ax)
        odd = np.bincount(corner[hit], minlength=len(b.ax)) % 2 == 1
        out[s] = _any(s.stop - s.start, row, odd[corner])
    return out


def meets_of(a: Edges, b: Edges) -> np.ndarray:
    """Whether two areas have a point in common, their edges included."""
    cross = each_pair(a, b, _edges_cross).astype(bool)
    return cross | _holds_corner(a, b) | _holds_corner(b, a)


def gap_of(a: Edges, b: Edges) -> np.ndarray:
    """Distance between two areas; 0 if they meet."""
    near = each_pair(a, b, lambda n, row, e, f: _least(n, row, np.minimum(_off(e, f[0], f[1]), _off(f, e[0], e[1]))))
    return np.where(meets_of(a, b), 0.0, near)


def _masked(values: np.ndarray, *valid: np.ndarray) -> pa.Array:
    return pa.array(values, mask=~np.logical_and.reduce(valid))


def _floats(v: pa.Array) -> np.ndarray:
    return np.asarray(v.cast(pa.float64()).fill_null(np.nan))


# --- columns ------------------------------------------------------------------


def _udf(kernel: Callable, kind: str) -> Callable[..., Column]:
    made = []

    def call(*columns: Column) -> Column:
        if not made:  # an UDF needs a session, so not before it is used
            made.append(F.arrow_udf(kernel, kind))
        return made[0](*columns)

    return call


def _shape_kernel(text: pa.Array) -> pa.Array:
    return shapes(text)


def _edge_kernel(shape: pa.Array) -> pa.Array:
    return edges_of(shape)


def _area_kernel(e: pa.Array, x: pa.Array, y: pa.Array) -> pa.Array:
    own = Edges(e)
    twice = lambda n, row, v, px, py: np.bincount(row, (v[0] - px) * (v[3] - py) - (v[2] - px) * (v[1] - py), n)
    return _masked(each_edge(own, twice, _floats(x), _floats(y)) / 2, own.valid)


def _centroid_kernel(e: pa.Array, x: pa.Array, y: pa.Array) -> pa.Array:
    own, x, y = Edges(e), _floats(x), _floats(y)
    cross = lambda v, px, py: (v[0] - px) * (v[3] - py) - (v[2] - px) * (v[1] - py)
    twice = each_edge(own, lambda n, row, v, px, py: np.bincount(row, cross(v, px, py), n), x, y)
    mx = each_edge(own, lambda n, row, v, px, py: np.bincount(row, (v[0] - px + v[2] - px) * cross(v, px, py), n), x, y)
    my = each_edge(own, lambda n, row, v, px, py: np.bincount(row, (v[1] - py + v[3] - py) * cross(v, px, py), n), x, y)
    some = own.valid & (twice != 0)
    safe = np.where(twice != 0, twice, 1.0)
    return pa.StructArray.from_arrays([pa.array(mx / (3 * safe) + x), pa.array(my / (3 * safe) + y)], fields=list(_CORNER), mask=pa.array(~some))


def _inside_kernel(e: pa.Array, x: pa.Array, y: pa.Array) -> pa.Array:
    own, x, y = Edges(e), _floats(x), _floats(y)
    within = each_edge(own, _crossings, x, y).astype(bool) & ~each_edge(own, _touching, x, y).astype(bool)
    return _masked(within, own.valid, ~np.isnan(x), ~np.isnan(y))


def _distance_kernel(e: pa.Array, x: pa.Array, y: pa.Array) -> pa.Array:
    own, x, y = Edges(e), _floats(x), _floats(y)
    off = each_edge(own, lambda n, row, v, px, py: _least(n, row, _off(v, px, py)), x, y)
    return _masked(np.where(each_edge(own, _crossings, x, y).astype(bool), 0.0, off), own.valid, ~np.isnan(x), ~np.isnan(y))


def _overlap_kernel(a: pa.Array, b: pa.Array, x: pa.Array, y: pa.Array) -> pa.Array:
    left, right = Edges(a), Edges(b)
    return _masked(each_pair(left, right, _strips, _floats(x), _floats(y)), left.valid, right.valid)


def _meets_kernel(a: pa.Array, b: pa.Array) -> pa.Array:
    left, right = Edges(a), Edges(b)
    return _masked(meets_of(left, right), left.valid, right.valid)


def _gap_kernel(a: pa.Array, b: pa.Array) -> pa.Array:
    left, right = Edges(a), Edges(b)
    return _masked(gap_of(left, right), left.valid, right.valid)


#: polygons(text): the geometry of a text, as parsed().
polygons = _udf(_shape_kernel, TYPE)
#: edges(shape): all edges of a geometry, as edges_of().
edges = _udf(_edge_kernel, EDGES)
#: area(edges, x, y): area inside edges; (x, y) is a point nearby, for precision.
area = _udf(_area_kernel, "double")
_centroid = _udf(_centroid_kernel, "struct<x:double,y:double>")
#: inside(edges, x, y): whether a point is inside; a point on an edge isn't.
inside = _udf(_inside_kernel, "boolean")
#: distance(edges, x, y): of a point from the area; 0 within.
distance = _udf(_distance_kernel, "double")
#: overlap(a, b, x, y): area that lies inside both edges; (x, y) is a point left of and below both.
overlap = _udf(_overlap_kernel, "double")
#: meets(a, b): whether two areas have a point in common, their edges included.
meets = _udf(_meets_kernel, "boolean")
#: gap(a, b): distance between two areas; 0 if they meet.
gap = _udf(_gap_kernel, "double")


def bounds(e: Column) -> Box:
    """The box around edges."""
    side = lambda f, k: f(F.transform(e, lambda v: v[k]))
    return Box.of(side(F.array_min, "ax"), side(F.array_min, "ay"), side(F.array_max, "ax"), side(F.array_max, "ay"))


def centroid(e: Column, x: Column, y: Column) -> tuple[Column, Column]:
    """Centroid of the area inside edges; null if there is none."""
    c = _centroid(e, x, y)
    return c["x"], c["y"]


def with_edges(batch: pa.RecordBatch, text: str) -> pa.RecordBatch:
    """A batch with shape, edges, x0, y0, x1, y1 and area of the geometry texts of a column, which is left out."""
    shape = shapes(batch.column(text))
    e = edges_of(shape)
    own = Edges(e)
    bounded = [pa.array(each_edge(own, lambda n, row, v, f=f, s=s, i=i: s * _least(n, row, s * v[i])), mask=~own.valid) for i, s, f in ((0, 1.0, "x0"), (1, 1.0, "y0"), (0, -1.0, "x1"), (1, -1.0, "y1"))]
    size = _area_kernel(e, bounded[0], bounded[1])
    rest = [n for n in batch.schema.names if n != text]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in rest), shape, e, *bounded, size], [*rest, "shape", "edges", "x0", "y0", "x1", "y1", "area"])


def moved(shape: Column, dx: Column, dy: Column) -> Column:
    return F.transform(shape, lambda p: F.transform(p, lambda r: F.transform(r, lambda c: _corner(c["x"] + dx, c["y"] + dy))))


def affine(shape: Column, t: list[Column]) -> Column:
    """A geometry in pixels on the ground, by a transform (a, b, c, d, e, f)."""
    a, b, c, d, e, f = t
    return F.transform(shape, lambda p: F.transform(p, lambda r: F.transform(r, lambda v: _corner(a * v["x"] + b * v["y"] + c, d * v["x"] + e * v["y"] + f))))


def to_wkt(shape: Column) -> Column:
    """A geometry as POLYGON, or MULTIPOLYGON if it has several parts; null is null."""
    joined = lambda items: F.concat(F.lit("("), F.array_join(items, ", "), F.lit(")"))
    ring = lambda r: joined(F.transform(r, lambda c: F.concat_ws(" ", c["x"].cast("string"), c["y"].cast("string"))))
    parts = F.transform(shape, lambda p: joined(F.transform(p, ring)))
    return F.when(F.size(shape) == 1, F.concat(F.lit("POLYGON "), F.get(parts, F.lit(0)))).otherwise(F.concat(F.lit("MULTIPOLYGON "), joined(parts)))


def to_json(shape: Column) -> Column:
    """A geometry as GeoJSON text, a Polygon, or a MultiPolygon if it has several parts."""
    nested = F.transform(shape, lambda p: F.transform(p, lambda r: F.transform(r, lambda c: F.array(c["x"], c["y"]))))
    return F.when(F.size(shape) == 1, F.to_json(F.struct(F.lit("Polygon").alias("type"), F.get(nested, F.lit(0)).alias("coordinates")))).otherwise(F.when(shape.isNotNull(), F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), nested.alias("coordinates")))))
