"""Pairs of boxes that lie near each other, each task sweeping the cells of a grid.

Each box goes, with all that a comparison needs, to the few cells that it
touches, and a task compares what lies in a cell. So rows are shuffled once,
and only what the comparison keeps leaves it. Nothing is broadcast but the
cells of unusually large boxes, and only if they are few.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelight.functions.boxes import Box, cells
from parcelight.functions.polygons import Edges, _area_kernel, _floats, _ragged, _runs, _strips, each_pair, edges_of, gap_of, meets_of

#: Side of the smallest cells. Boxes of up to SPREAD sides lie in cells of their level; a level's cells have STEP times the side of those of the one below.
CELL, SPREAD, STEP, LEVELS = 128.0, 4, 8, 12
#: Rows that are compared at once; a cell with more is compared as a whole.
ROWS = 1 << 15
#: Cells of large boxes that may be broadcast.
FEW = 10_000
_SIDES = ("x0", "y0", "x1", "y1")
#: compare(rows, i, j) -> what is kept of the pairs of rows i and j.
Compare = Callable[[pa.RecordBatch, np.ndarray, np.ndarray], pa.RecordBatch]


def _level(box: Box) -> Column:
    """The first level for whose cells the box isn't too large; null for a box with a null or infinite side."""
    side = F.greatest(box.width, box.height)
    whole = reduce(Column.__and__, (F.abs(s) < float("inf") for s in (box.x0, box.y0, box.x1, box.y1)))
    steps = F.ceil(F.log2(F.greatest(side, F.lit(1.0)) / (CELL * SPREAD)) / np.log2(STEP))
    return F.when(whole, F.least(F.greatest(steps, F.lit(0)), F.lit(LEVELS)).cast("int"))


def _cells(box: Box, level: Column) -> Column:
    return F.transform(cells(box, F.lit(CELL) * F.pow(F.lit(float(STEP)), level)), lambda c: F.struct(level.alias("_lv"), c["cx"].alias("_cx"), c["cy"].alias("_cy")))


def _own(df: DataFrame, grow: float) -> DataFrame:
    return df.withColumn("_own", _level(Box().grown(grow))).filter("_own is not null")


def _at(rows: DataFrame, places: Column) -> DataFrame:
    return rows.withColumn("_cell", F.explode(places)).select(*rows.columns, "_cell.*")


def _placed(df: DataFrame, other: DataFrame, grow: float, within: list[str]) -> DataFrame:
    """Rows in the cells of their own level, and in those above in which boxes of the other table lie."""
    box, rows = Box().grown(grow), _own(df, grow)
    placed = _at(rows, _cells(box, F.col("_own")))
    slim = _own(other.select(*within, *_SIDES), grow)
    levels = sorted(r[0] for r in slim.filter("_own > 0").select("_own").distinct().collect())  # LEVELS at most
    if not levels:
        return placed
    above = F.filter(F.array(*map(F.lit, levels)), lambda v: v > F.col("_own"))
    up = _at(rows, F.flatten(F.transform(above, lambda v: _cells(box, v))))
    key = [*within, "_lv", "_cx", "_cy"]
    large = _at(slim.filter("_own > 0"), _cells(box, F.col("_own"))).select(key).distinct()
    few = large.limit(FEW + 1).count() <= FEW
    return placed.unionByName(up.join(F.broadcast(large) if few else large, key, "left_semi").select(placed.columns))


def _found(rows: pa.RecordBatch, within: int, grow: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j): pairs of rows of a left and a right box in the same cell that touch when grown, each in one of the cells. Of a table with itself each pair comes in one order only."""
    n = len(rows)
    side, own, level, cx, cy = (rows.column(k).to_numpy() for k in ("_side", "_own", "_lv", "_cx", "_cy"))
    x0, y0, x1, y1 = (rows.column(k).to_numpy() + s * grow for k, s in zip(_SIDES, (-1, -1, 1, 1)))
    new = np.ones(n, bool)
    new[1:] = (level[1:] != level[:-1]) | (cx[1:] != cx[:-1]) | (cy[1:] != cy[:-1])
    for k in range(within):
        c = rows.column(k)
        new[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
    values, rank = np.unique(np.concatenate([x0, x1]), return_inverse=True)
    group = (np.cumsum(new) - 1) * len(values)
    low, high = group + rank[:n], group + rank[n:]
    size, up = CELL * float(STEP) ** level, level > own

    def kept(q: np.ndarray, t: np.ndarray, first: np.ndarray, flip: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of each row of q and those of t, sorted by low, from place `first` up to its right side."""
        count = np.maximum(np.searchsorted(low[t], high[q], "right") - first, 0)
        for s in _runs(count):
            row, k = _ragged(count[s])
            i, j = q[s][row], t[first[s][row] + k]
            met = (y0[i] <= y1[j]) & (y0[j] <= y1[i])
            i, j = i[met], j[met]
            at = (np.floor(np.maximum(x0[i], x0[j]) / size[i]) == cx[i]) & (np.floor(np.maximum(y0[i], y0[j]) / size[i]) == cy[i])
            if at.any():
                yield (j[at], i[at]) if flip else (i[at], j[at])

    def both(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if len(a) and len(b):
            yield from kept(a, b, np.searchsorted(low[b], low[a], "left"), False)
            yield from kept(b, a, np.searchsorted(low[a], low[b], "right"), True)

    order = np.argsort(low, kind="stable")
    part = lambda s, above: order[(side[order] == s) & (up[order] == above)]
    if (side == 0).all():
        mine = part(0, False)
        yield from kept(mine, mine, np.arange(len(mine)) + 1, False)
        yield from both(mine, part(0, True))
    else:
        for a, b in ((False, False), (False, True), (True, False)):
            yield from both(part(-1, a), part(1, b))


def whole_groups(batches: Iterator[pa.RecordBatch], key: list[str], least: int) -> Iterator[pa.RecordBatch]:
    """Batches of about `least` rows or more, of rows sorted by `key`, that end with the last row of a group."""
    held, n = [], 0
    for b in batches:
        if not len(b):
            continue
        held.append(b)
        n += len(b)
        last = [(c, b.column(c)[len(b) - 1]) for c in key]
        if n < least or all(held[0].column(c)[0] == v for c, v in last):
            continue  # also a crowded group, which goes on
        whole = pa.concat_batches(held)
        same = reduce(pc.and_, (pc.equal(whole.column(c), v) for c, v in last))
        n = pc.sum(same).as_py()
        yield whole.slice(0, len(whole) - n)
        held = [whole.slice(len(whole) - n)]
    if held:
        yield pa.concat_batches(held)


def near_pairs(left: DataFrame, right: DataFrame | None, compare: Compare, schema: str, within: list[str] = (), grow: float = 0.0) -> DataFrame:
    """What `compare` keeps of the pairs of a left and a right box that touch when each is grown by `grow`.

    Both tables have x0, y0, x1, y1 and the columns of `within`, which must be
    equal. Further columns go to `compare`, null where a table has none of the
    name. With right None the pairs are those of the left table, each in any
    order, once.
    Null coordinates and a null in `within` meet nothing. A cell is compared in
    one task, so what a task holds grows with the most crowded cell.
    """
    within = list(within)
    known = reduce(Column.__and__, (F.col(c).isNotNull() for c in within), F.lit(True))
    sides = [(left, right, -1), (right, left, 1)] if right is not None else [(left, left, 0)]
    tables = [_placed(df.filter(known), other.filter(known), grow, within).withColumn("_side", F.lit(s)) for df, other, s in sides]
    key = ["_lv", "_cx", "_cy"]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    rows = rows.select(*within, *[c for c in rows.columns if c not in within])
    order = rows.repartition(*within, *key).sortWithinPartitions(*key, *within)
    k = len(within)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in whole_groups(batches, [*within, *key], ROWS):
            for i, j in _found(whole, k, grow):
                out = compare(whole, i, j)
                for start in range(0, len(out), ROWS):
                    yield out.slice(start, ROWS)

    return order.mapInArrow(run, schema)


def gaps(rows: pa.RecordBatch, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Distances of the boxes i and j; 0 if they touch."""
    x0, y0, x1, y1 = (rows.column(k).to_numpy() for k in _SIDES)
    return np.hypot(*(np.maximum(np.maximum(low[i] - high[j], low[j] - high[i]), 0.0) for low, high in ((x0, x1), (y0, y1))))


def overlaps(rows: pa.RecordBatch, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Areas that both boxes i and j cover."""
    x0, y0, x1, y1 = (rows.column(k).to_numpy() for k in _SIDES)
    side = lambda low, high: np.maximum(np.minimum(high[i], high[j]) - np.maximum(low[i], low[j]), 0.0)
    return side(x0, x1) * side(y0, y1)


def areas(rows: pa.RecordBatch, edges: str | None = None) -> np.ndarray:
    """Areas of the boxes; with `edges`, those inside them, NaN where a row has none."""
    x0, y0, x1, y1 = (rows.column(k) for k in _SIDES)
    if edges:
        return _floats(_area_kernel(rows.column(edges), x0, y0))
    return (x1.to_numpy() - x0.to_numpy()) * (y1.to_numpy() - y0.to_numpy())


def shape_overlaps(rows: pa.RecordBatch, edges: str, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Areas that lie inside the edges of both; NaN where one has none."""
    x0, y0 = (rows.column(k).to_numpy() for k in ("x0", "y0"))
    a, b = edges_at(rows, edges, i), edges_at(rows, edges, j)
    return np.where(a.valid & b.valid, each_pair(a, b, _strips, np.minimum(x0[i], x0[j]), np.minimum(y0[i], y0[j])), np.nan)


def edges_at(rows: pa.RecordBatch, edges: str, i: np.ndarray) -> Edges:
    """Those of a column of edges, or of one of shapes, of which each that is asked for is turned into edges once."""
    column = rows.column(edges)
    if pa.types.is_list(column.type.value_type):
        own, i = np.unique(i, return_inverse=True)
        column = edges_of(column.take(pa.array(own)))
    return Edges(column.take(pa.array(i)))


def within_distance(rows: pa.RecordBatch, i: np.ndarray, j: np.ndarray, distance: float, edges: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs that are at most `distance` apart."""
    near = gaps(rows, i, j) <= distance
    i, j = i[near], j[near]
    if edges:
        a, b = edges_at(rows, edges, i), edges_at(rows, edges, j)
        near = (gap_of(a, b) <= distance if distance else meets_of(a, b)) & a.valid & b.valid
        i, j = i[near], j[near]
    return i, j


def near_shapes(left: DataFrame, right: DataFrame, distance: float, edges: str | None = None) -> DataFrame:
    """(id, other): ids of the left and right rows (id, x0, y0, x1, y1) at most `distance` apart; with `edges`, a column of edges, the areas inside them."""
    kept = ["id", *_SIDES, *([edges] if edges else [])]
    left, right = left.select(kept), right.select(kept)
    kind = left.select("id").unionAll(right.select("id")).dtypes[0][1]

    def compare(rows: pa.RecordBatch, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
        i, j = within_distance(rows, i, j, distance, edges)
        return pa.RecordBatch.from_arrays([rows.column("id").take(pa.array(i)), rows.column("id").take(pa.array(j))], ["id", "other"])

    return near_pairs(left, right, compare, f"id {kind}, other {kind}", grow=distance / 2)


def row_pairs(left: DataFrame, right: DataFrame, distance: float, shape: str) -> DataFrame:
    """The left rows (x0, y0, x1, y1, ...) with `other`, the id of a right row (id, x0, y0, x1, y1) at most `distance` away, by the areas inside a column of shapes.

    So what is wanted of the left rows needs no join of all of them afterwards.
    """
    names = left.columns
    schema = ", ".join([*(f"`{c}` {kind}" for c, kind in left.dtypes), f"other {right.select('id').dtypes[0][1]}"])

    def compare(rows: pa.RecordBatch, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
        i, j = within_distance(rows, i, j, distance, shape)
        own = rows.select(names).take(pa.array(i))
        return pa.RecordBatch.from_arrays([*own.columns, rows.column("_other").take(pa.array(j))], [*names, "other"])

    return near_pairs(left, right.select(F.col("id").alias("_other"), *_SIDES, shape), compare, schema, grow=distance / 2)


def rows_near(left: DataFrame, right: DataFrame, distance: float, edges: str | None = None) -> DataFrame:
    """The left rows (id, x0, y0, x1, y1, ...) at most `distance` from a right one, each once; ids are unique."""
    schema = ", ".join(f"`{c}` {kind}" for c, kind in left.dtypes)

    def compare(rows: pa.RecordBatch, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
        return rows.select(names).take(pa.array(np.unique(within_distance(rows, i, j, distance, edges)[0])))

    names = left.columns
    return near_pairs(left, right.select(*_SIDES, *([edges] if edges else [])), compare, schema, grow=distance / 2).dropDuplicates(["id"])
