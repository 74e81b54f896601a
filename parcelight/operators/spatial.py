"""Spatial joins as equi-joins on grid cells with an exact residual predicate.

A hot tile is spread over its cells, so a join has no key that grows with a
tile. Boxes are sorted into levels by size, each with cells that a box of it
touches four of at most, so a large box isn't spread over many small cells.
Catalyst picks the join; nothing is broadcast by hint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelight.functions import polygons
from parcelight.functions.boxes import Box, cells

#: Levels that boxes are sorted into; each has cells of twice the side.
LEVELS = 32


def _level(box: Box, cell: float) -> Column:
    """The first level whose cells are as large as the box; null for a box with a null or infinite side."""
    side = F.greatest(box.width, box.height)
    return F.when(side < float("inf"), F.least(F.greatest(F.ceil(F.log2(side / cell)), F.lit(0)), F.lit(LEVELS)).cast("int"))


def _used(df: DataFrame, box: Box, cell: float) -> set[int]:
    """Levels that a table has boxes of, LEVELS + 1 at most."""
    return set(df.agg(F.collect_set(F.coalesce(_level(box, cell), F.lit(0))).alias("l")).first().l)


def _size(level: Column, cell: float) -> Column:
    return F.lit(cell) * F.pow(F.lit(2.0), level)


def _placed(box: Box, cell: float, levels: list[int]) -> Column:
    """Cells (level, cx, cy) that a box touches, at its level and those above that are in use."""
    own = F.filter(F.array(*map(F.lit, levels)), lambda v: v >= _level(box, cell))
    return F.flatten(F.transform(own, lambda v: F.transform(cells(box, _size(v, cell)), lambda c: F.struct(v.alias("level"), c["cx"].alias("cx"), c["cy"].alias("cy")))))


def points_near_boxes(boxes: DataFrame, points: DataFrame, radius: float, within: list[str] = (), cell: float | None = None, edges: str | None = None) -> DataFrame:
    """All (box, point) rows with the point less than `radius` from the box; radius 0: strictly inside it.

    `boxes` has id, x0, y0, x1, y1, `points` has pid, x, y; both have the
    columns of `within`, which must be equal. With `edges`, a column of edges,
    the area inside them counts instead of the box. The result has the boxes'
    columns, pid, x, y and `distance`. A point lies in one cell of a level, so
    no pair comes twice; null coordinates match nothing.
    """
    size, box = cell or max(8.0, 2 * radius), Box()
    grown = box.grown(radius)
    levels = sorted(_used(boxes, grown, size))
    spread = boxes.withColumn("_own", _level(grown, size)).withColumn("_cell", F.explode(_placed(grown, size, levels))).filter(F.col("_cell.level") == F.col("_own")).drop("_own")
    at = F.transform(F.array(*map(F.lit, levels)), lambda v: F.struct(v.alias("level"), F.floor(F.col("x") / _size(v, size)).alias("cx"), F.floor(F.col("y") / _size(v, size)).alias("cy")))
    placed = points.filter("x is not null and y is not null").select(*within, "pid", "x", "y", F.explode(at).alias("_cell"))
    x, y = F.col("x"), F.col("y")
    near = box.distance(x, y) < radius if radius else box.holds(x, y)
    met = spread.join(placed, [*within, "_cell"]).filter(near)
    shape = F.col(edges) if edges else None
    distance = polygons.distance(shape, x, y) if edges else box.distance(x, y)
    rows = met.select(*[met[c] for c in boxes.columns], "pid", "x", "y", distance.alias("distance"))
    if radius:
        return rows.filter(F.col("distance") < radius) if edges else rows
    return rows.filter(polygons.inside(shape, x, y)) if edges else rows


def box_pairs(left: DataFrame, right: DataFrame, within: list[str] = (), grow: float = 0.0, keep: Column | None = None, cell: float = 8.0) -> DataFrame:
    """All pairs of a left and a right box whose closed boxes, grown by `grow`, touch.

    Columns of both sides come with the prefixes l_ and r_. A pair is owned by
    the cell of its common corner (greatest x0, greatest y0) at the higher of
    its levels, so it comes once without a distinct. `keep` is a further
    condition, checked after the owner.
    """
    side = lambda df, p: df.select(*[F.col(c).alias(p + c) for c in df.columns])
    a, b = side(left, "l_"), side(right, "r_")
    la, rb = Box("l_").grown(grow), Box("r_").grown(grow)
    levels = sorted(_used(a, la, cell) | (_used(b, rb, cell) if right is not left else set()))
    a = a.select("*", *[F.col("l_" + c).alias("_" + c) for c in within], _level(la, cell).alias("_ll"), F.explode(_placed(la, cell, levels)).alias("_cell"))
    b = b.select("*", *[F.col("r_" + c).alias("_" + c) for c in within], _level(rb, cell).alias("_lr"), F.explode(_placed(rb, cell, levels)).alias("_cell"))
    met = a.join(b, ["_cell", *["_" + c for c in within]])
    level = F.greatest("_ll", "_lr")
    size = _size(level, cell)
    owner = F.struct(level.alias("level"), F.floor(F.greatest(la.x0, rb.x0) / size).alias("cx"), F.floor(F.greatest(la.y0, rb.y0) / size).alias("cy"))
    met = met.filter(la.touches(rb) & (F.col("_cell") == owner))
    return (met.filter(keep) if keep is not None else met).drop("_cell", "_ll", "_lr", *["_" + c for c in within])
