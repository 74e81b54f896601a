"""Pairs of points within a distance, by range-partitioned strips and a local sweep."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelight.functions.points import located, point_texts
from parcelight.runtime import Workspace

#: Points that one cell should hold. The bounds of all cells go to every task: 8 bytes for so many points.
CELL_POINTS = 20_000
#: Pairs that the sweep gives at once.
CHUNK = 1 << 16
#: Most tasks of the sweep.
MOST_TASKS = 1 << 16


def locations(df: DataFrame, id_col: str = "id", geometry: str = "geometry", loaded: str = "loaded_at") -> DataFrame:
    """One row (id, x, y) per located id.

    Rows without a location are no locations; an id without any is left out.
    Of several deliveries the latest loaded located one counts (a null load
    time is the earliest; ties: the largest x, then y). A null id is left out.
    """
    texts = df.select(F.col(id_col).alias("id"), F.col(loaded).alias("at"), point_texts(F.col(geometry)).alias("p")).filter("id is not null")
    ordinate = lambda i: F.get("p", F.lit(i)).try_cast("double")
    rows = texts.select("id", "at", ordinate(0).alias("x"), ordinate(1).alias("y")).filter(located(F.col("x"), F.col("y")))
    return rows.groupBy("id").agg(F.max(F.struct("at", "x", "y")).alias("p")).select("id", "p.x", "p.y")


def _cuts(values: list[float], apart: float) -> np.ndarray:
    """Sorted bounds of which any two are at least `apart` from each other."""
    kept: list[float] = []
    for v in sorted(values):
        if not kept or v - kept[-1] >= apart:
            kept.append(v)
    return np.array(kept, dtype="float64")


def plan_cells(points: DataFrame, radius: float, cell_points: int = CELL_POINTS) -> tuple[np.ndarray, list[np.ndarray]]:
    """Bounds of the strips in y and, for each strip, bounds in x.

    Bounds are sampled quantiles, at least 2 radii apart, so that a point and
    its overlap touch at most two strips and two cells of each. There are as
    many strips as cells of a strip, about, so their number grows as the root
    of the points' and no cell grows with the data. What is still crowded after
    both cuts lies within a few radii and has to come out as pairs.
    """
    n = points.count()
    cells = -(-n // cell_points)
    if cells <= 1:
        return np.array([]), [np.array([])]
    strips = int(np.ceil(np.sqrt(cells)))
    y_cuts = _cuts(points.stat.approxQuantile("y", [i / strips for i in range(1, strips)], 0.1 / strips), 2 * radius)
    stripped = Bucketizer(splits=[-np.inf, *map(float, y_cuts), np.inf], inputCol="y", outputCol="strip").transform(points).select("x", F.col("strip").cast("int").alias("strip"))
    counts = {r.strip: r.n for r in stripped.groupBy("strip").agg(F.count("*").alias("n")).collect()}
    steps = max(-(-n // cell_points) for n in counts.values())
    x_cuts = [np.array([])] * (len(y_cuts) + 1)
    if steps > 1:
        quantiles = F.percentile_approx("x", [i / steps for i in range(1, steps)], 10 * steps)
        for row in stripped.groupBy("strip").agg(quantiles.alias("q")).collect():  # a number per cell
            k = -(-counts[row.strip] // cell_points)
            x_cuts[row.strip] = _cuts([row.q[max(0, round(i * steps / k) - 1)] for i in range(1, k)], 2 * radius)
    return y_cuts, x_cuts


def _spread(y_cuts: np.ndarray, x_cuts: list[np.ndarray], radius: float):
    """Gives each point to every cell in which a pair of it can be owned. Cells are numbered by strip, then by x.

    The owner of a pair is the cell of (least x, least y) of the two points;
    both lie within one radius above that in either direction.
    """
    first = np.cumsum([0] + [len(c) + 1 for c in x_cuts])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x, y, ids = b["x"].to_numpy(), b["y"].to_numpy(), b["id"].to_numpy()
            parts = []
            s_low, s_own = np.searchsorted(y_cuts, y - radius, "right"), np.searchsorted(y_cuts, y, "right")
            for ds in (0, 1):
                at = np.flatnonzero(s_low + ds <= s_own)
                strip = s_low[at] + ds
                c_low, c_own = np.zeros(len(at), "int64"), np.zeros(len(at), "int64")
                for s in set(strip.tolist()):
                    if len(x_cuts[s]):
                        own = strip == s
                        c_low[own] = np.searchsorted(x_cuts[s], x[at[own]] - radius, "right")
                        c_own[own] = np.searchsorted(x_cuts[s], x[at[own]], "right")
                for dc in (0, 1):
                    k = np.flatnonzero(c_low + dc <= c_own)
                    parts.append(pd.DataFrame({"cell": first[strip[k]] + c_low[k] + dc, "id": ids[at[k]], "x": x[at[k]], "y": y[at[k]]}))
            yield pd.concat(parts, ignore_index=True)

    return run


class Sweep:
    """Pairs of points at most `radius` apart, of points given in the order of y.

    The active set holds the points at most one radius below the sweep line,
    ordered by x. A new point is compared with those at most one radius left or
    right of it, found by bisection, and then enters; points fall out as the
    line leaves them behind.
    """

    def __init__(self, radius: float, rounding: float = 0.0):
        self.slack, self.limit = radius * 1.000001 + rounding, radius * radius
        self.xs: list[float] = []
        self.active: list[tuple[int, float, float]] = []
        self.queue: deque[tuple[int, float, float]] = deque()

    def put(self, id_: int, x: float, y: float) -> list[tuple[int, float, float]]:
        """The earlier points (id, x, y) that are near this one."""
        xs, active, queue, slack = self.xs, self.active, self.queue, self.slack
        low = y - slack
        while queue and queue[0][2] < low:
            old = queue.popleft()
            at = bisect_left(xs, old[1])
            while active[at] is not old:
                at += 1
            del xs[at], active[at]
        first = bisect_left(xs, x - slack)
        last = bisect_right(xs, x + slack, first)
        limit = self.limit
        near = [p for p in active[first:last] if (p[1] - x) * (p[1] - x) + (p[2] - y) * (p[2] - y) <= limit]
        point = (id_, x, y)
        at = bisect_right(xs, x, first, last)
        xs.insert(at, x)
        active.insert(at, point)
        queue.append(point)
        return near


def _pairs(y_cuts: np.ndarray, x_cuts: list[np.ndarray], radius: float):
    first = np.cumsum([0] + [len(c) + 1 for c in x_cuts])

    def bounds(cell: int) -> tuple[float, float, float, float]:
        """The half-open part of the plane whose pairs a cell owns: from y and x, up to y and x."""
        strip = int(np.searchsorted(first, cell, "right")) - 1
        edge = lambda cuts, i: float(cuts[i]) if 0 <= i < len(cuts) else np.inf if i >= 0 else -np.inf
        part = cell - int(first[strip])
        return edge(y_cuts, strip - 1), edge(x_cuts[strip], part - 1), edge(y_cuts, strip), edge(x_cuts[strip], part)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, sweep, a, b = None, None, [], []
        for batch in batches:
            rounding = 4 * float(np.spacing(np.abs(batch[["x", "y"]].to_numpy()).max(initial=1.0)))
            if sweep:
                sweep.slack = max(sweep.slack, radius * 1.000001 + rounding)
            for cell, id_, x, y in zip(*(batch[c].tolist() for c in ("cell", "id", "x", "y"))):
                if cell != current:
                    current, sweep = cell, Sweep(radius, rounding)
                    y0, x0, y1, x1 = bounds(cell)
                for other, ox, oy in sweep.put(id_, x, y):
                    least_x = x if x < ox else ox
                    if y0 <= oy < y1 and x0 <= least_x < x1 and other != id_:  # oy is the lesser y
                        a.append(id_ if id_ < other else other)
                        b.append(other if id_ < other else id_)
                if len(a) >= CHUNK:
                    yield pd.DataFrame({"id_a": a, "id_b": b})
                    a, b = [], []
        yield pd.DataFrame({"id_a": a, "id_b": b}, dtype="int64")

    return run


def pairs_within(ws: Workspace, points: DataFrame, radius: float, cell_points: int = CELL_POINTS) -> DataFrame:
    """(id_a, id_b), id_a < id_b: all pairs of points (id, x, y) at most `radius` apart, each once.

    Exactly `radius` counts. Points on the same spot pair with each other. No
    points, one point: no rows. Columns besides id, x and y are not read.
    """
    points = ws.write(points.select(F.col("id").cast("long"), F.col("x").cast("double"), F.col("y").cast("double")), "points")
    y_cuts, x_cuts = plan_cells(points, radius, cell_points)
    cell = T.StructType([T.StructField("cell", T.LongType()), *points.schema.fields])
    cells = sum(len(c) + 1 for c in x_cuts)
    spread = points.mapInPandas(_spread(y_cuts, x_cuts, radius), cell)
    # Ranges of cells by the planned bounds, so no sampling job and no bounds of Spark's own.
    tasks = min(cells, MOST_TASKS)
    ranged = spread.repartitionById(tasks, F.floor(F.col("cell") * tasks / cells).cast("int"))
    return ranged.sortWithinPartitions("cell", "y", "x", "id").mapInPandas(_pairs(y_cuts, x_cuts, radius), "id_a long, id_b long")
