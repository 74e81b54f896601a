"""Axis-aligned boxes and their predicates as column expressions.

A box is four columns or a struct (x1, y1, x2, y2). All of it stays inside
whole-stage code generation and can be pushed below joins by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Box:
    """Names the four sides of a box in a DataFrame; `prefix` tells two boxes of a row apart."""

    def __init__(self, prefix: str = "", names: tuple[str, str, str, str] = ("x0", "y0", "x1", "y1")):
        self._names, self._sides = [prefix + n for n in names], None

    @classmethod
    def of(cls, x0: Column, y0: Column, x1: Column, y1: Column) -> Box:
        box = cls()
        box._sides = (x0, y0, x1, y1)
        return box

    def _side(self, i: int) -> Column:
        return self._sides[i] if self._sides else F.col(self._names[i])  # columns need a session, so not before they are used

    x0, y0, x1, y1 = (property(lambda self, i=i: self._side(i)) for i in range(4))

    @property
    def width(self) -> Column:
        return self.x1 - self.x0

    @property
    def height(self) -> Column:
        return self.y1 - self.y0

    @property
    def area(self) -> Column:
        return self.width * self.height

    @property
    def aspect(self) -> Column:
        """Longer side by shorter side; null if a side has no length."""
        return F.when((self.width != 0) & (self.height != 0), F.greatest(self.width, self.height) / F.least(self.width, self.height))

    @property
    def centre(self) -> tuple[Column, Column]:
        return (self.x0 + self.x1) / 2, (self.y0 + self.y1) / 2

    def grown(self, d: float | Column) -> Box:
        """Dilated with square corners."""
        return Box.of(self.x0 - d, self.y0 - d, self.x1 + d, self.y1 + d)

    def moved(self, dx: Column, dy: Column) -> Box:
        return Box.of(self.x0 + dx, self.y0 + dy, self.x1 + dx, self.y1 + dy)

    def clamped(self, width: Column | float, height: Column | float) -> Box:
        """Cut to an image of the given size."""
        low = lambda c: F.greatest(F.lit(0.0), c)
        return Box.of(low(self.x0), low(self.y0), F.least(F.lit(width), self.x1), F.least(F.lit(height), self.y1))

    def touches(self, other: Box) -> Column:
        """Whether the closed boxes have a point in common."""
        return (self.x0 <= other.x1) & (self.x1 >= other.x0) & (self.y0 <= other.y1) & (self.y1 >= other.y0)

    def overlap(self, other: Box) -> Column:
        """Area that both boxes cover."""
        side = lambda a0, a1, b0, b1: F.greatest(F.lit(0.0), F.least(a1, b1) - F.greatest(a0, b0))
        return side(self.x0, self.x1, other.x0, other.x1) * side(self.y0, self.y1, other.y0, other.y1)

    def iou_above(self, other: Box, threshold: float) -> Column:
        """Intersection over union > threshold, without a division."""
        inter = self.overlap(other)
        return inter > threshold * (self.area + other.area - inter)

    def holds(self, x: Column, y: Column) -> Column:
        """Whether a point is inside, the edge excluded."""
        return (x > self.x0) & (x < self.x1) & (y > self.y0) & (y < self.y1)

    def distance(self, x: Column, y: Column) -> Column:
        """From the box to a point; 0 inside."""
        return F.hypot(F.greatest(self.x0 - x, F.lit(0.0), x - self.x1), F.greatest(self.y0 - y, F.lit(0.0), y - self.y1))

    def gap(self, other: Box) -> Column:
        """Distance between two boxes; 0 if they touch."""
        return F.hypot(F.greatest(self.x0 - other.x1, F.lit(0.0), other.x0 - self.x1), F.greatest(self.y0 - other.y1, F.lit(0.0), other.y0 - self.y1))

    def columns(self, prefix: str = "") -> list[Column]:
        return [self.x0.alias(prefix + "x0"), self.y0.alias(prefix + "y0"), self.x1.alias(prefix + "x1"), self.y1.alias(prefix + "y1")]


def repaired(df: DataFrame) -> DataFrame:
    """Rows with the sides of x0, y0, x1, y1 put in order; boxes without area, or with a null side, are dropped."""
    box = Box()
    sides = {"x0": F.least(box.x0, box.x1), "y0": F.least(box.y0, box.y1), "x1": F.greatest(box.x0, box.x1), "y1": F.greatest(box.y0, box.y1)}
    whole = box.x0.isNotNull() & box.y0.isNotNull() & box.x1.isNotNull() & box.y1.isNotNull()
    return df.filter(whole & (box.width != 0) & (box.height != 0)).withColumns(sides)


def affine(box: Box, a: Column, b: Column, c: Column, d: Column, e: Column, f: Column) -> Box:
    """A pixel box on the ground: x = a col + b row + c, y = d col + e row + f, sides put in order."""
    xs, ys = (a * box.x0 + b * box.y0 + c, a * box.x1 + b * box.y1 + c), (d * box.x0 + e * box.y0 + f, d * box.x1 + e * box.y1 + f)
    return Box.of(F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys))


def cells(box: Box, size: float | Column) -> Column:
    """Grid cells (struct cx, cy) that a box touches, as an array to explode."""
    span = lambda low, high: F.sequence(F.floor(low / size), F.floor(high / size))
    xs, ys = span(box.x0, box.x1), span(box.y0, box.y1)
    return F.flatten(F.transform(xs, lambda cx: F.transform(ys, lambda cy: F.struct(cx.alias("cx"), cy.alias("cy")))))


def ring_area(ring: Column) -> Column:
    """Unsigned area of a closed ring, an array of struct (x, y), by the shoelace formula."""
    following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    cross = F.zip_with(ring, following, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda s, v: s + v)) / 2


def ring_centroid(ring: Column) -> tuple[Column, Column]:
    """Centroid of a closed ring; null if it has no area."""
    following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    cross = lambda p, q: p["x"] * q["y"] - q["x"] * p["y"]
    total = lambda f: F.aggregate(F.zip_with(ring, following, f), F.lit(0.0), lambda s, v: s + v)
    twice = F.nullif(total(cross), F.lit(0.0))
    return total(lambda p, q: (p["x"] + q["x"]) * cross(p, q)) / (3 * twice), total(lambda p, q: (p["y"] + q["y"]) * cross(p, q)) / (3 * twice)
