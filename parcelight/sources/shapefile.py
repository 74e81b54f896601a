"""Shapefiles: geometries of a .shp file with the attributes of the .dbf beside it."""

from __future__ import annotations

import glob
import os
import re
import struct
from collections.abc import Iterator

from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from parcelight.functions import wkb


def _area2(ring: list) -> float:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:]))


def _inside(p: list, ring: list) -> bool:
    hit = False
    for a, b in zip(ring, ring[1:]):
        if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < (b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1]) + a[0]:
            hit = not hit
    return hit


def shape_of(content: bytes) -> wkb.Geometry | None:
    """Geometry of a record: points, multipoints, lines and polygons (clockwise rings are outer ones), Z and M left out; None for a null shape."""
    kind = struct.unpack_from("<i", content)[0] % 10
    if kind == 0:
        return None
    if kind == 1:
        return "Point", list(struct.unpack_from("<2d", content, 4))
    if kind == 8:
        n = struct.unpack_from("<i", content, 36)[0]
        flat = struct.unpack_from(f"<{2 * n}d", content, 40)
        return "MultiPoint", [list(flat[i : i + 2]) for i in range(0, 2 * n, 2)]
    if kind not in (3, 5):
        raise ValueError(f"shape type {kind} is not supported")
    parts, n = struct.unpack_from("<2i", content, 36)
    starts = [*struct.unpack_from(f"<{parts}i", content, 44), n]
    flat = struct.unpack_from(f"<{2 * n}d", content, 44 + 4 * parts)
    lines = [[list(flat[2 * i : 2 * i + 2]) for i in range(a, b)] for a, b in zip(starts, starts[1:])]
    if kind == 3:
        return ("LineString", lines[0]) if len(lines) == 1 else ("MultiLineString", lines)
    outer = [[r] for r in lines if _area2(r) <= 0] or [[r] for r in lines]
    for hole in (r for r in lines if _area2(r) > 0) if any(_area2(r) <= 0 for r in lines) else ():
        home = next((p for p in outer if _inside(hole[0], p[0])), outer[0])
        home.append(hole)
    return ("Polygon", outer[0]) if len(outer) == 1 else ("MultiPolygon", outer)


class _Table:
    """The fields and rows of a .dbf file."""

    def __init__(self, path: str, encoding: str):
        self.path, self.encoding, self.fields, self.rows = path, encoding, [], 0
        if not os.path.exists(path):
            return
        with open(path, "rb") as f:
            head = f.read(32)
            self.rows, self.head, self.size = struct.unpack_from("<IHH", head, 4)
            at = 1
            while (d := f.read(32)) and d[0] != 0x0D:
                self.fields.append((d[:11].split(b"\0")[0].decode(encoding), chr(d[11]), at, d[16], d[17]))
                at += d[16]

    def types(self) -> list[T.StructField]:
        kind = lambda t, decimals: T.StringType() if t in "CDM" else T.BooleanType() if t == "L" else T.LongType() if t == "N" and not decimals else T.DoubleType()
        return [T.StructField(n, kind(t, k)) for n, t, _, _, k in self.fields]

    def row(self, f, i: int) -> list:
        f.seek(self.head + i * self.size)
        raw, out = f.read(self.size), []
        for _, t, at, length, decimals in self.fields:
            text = raw[at : at + length].decode(self.encoding, "replace").strip().strip("\0")
            if t in "CDM":
                out.append(text or None)
            elif t == "L":
                out.append(None if text in ("", "?") else text in "YyTt")
            else:
                try:
                    out.append(int(text) if t == "N" and not decimals else float(text))
                except ValueError:
                    out.append(None)
        return out


class _Records(InputPartition):
    def __init__(self, path: str, first: int, count: int):
        self.path, self.first, self.count = path, first, count


class _Reader(DataSourceReader):
    def __init__(self, files: list[str], encoding: str, rows: int):
        self.files, self.encoding, self.size = files, encoding, rows

    def partitions(self):
        """By the .shx index if there is one, which gives each record's place; else a file at once."""
        parts = []
        for path in self.files:
            index = path[:-4] + ".shx"
            n = (os.path.getsize(index) - 100) // 8 if os.path.exists(index) else -1
            parts += [_Records(path, a, self.size) for a in range(0, n, self.size)] if n > self.size else [_Records(path, 0, -1)]
        return parts

    def read(self, part: _Records) -> Iterator[tuple]:
        table = _Table(part.path[:-4] + ".dbf", self.encoding)
        prj = part.path[:-4] + ".prj"
        srid = srid_of(open(prj).read()) if os.path.exists(prj) else None
        with open(part.path, "rb") as f, open(table.path if table.fields else os.devnull, "rb") as attributes:
            if part.first:
                with open(part.path[:-4] + ".shx", "rb") as x:
                    x.seek(100 + 8 * part.first)
                    f.seek(2 * struct.unpack(">i", x.read(4))[0])
            else:
                f.seek(100)
            i = part.first
            while (part.count < 0 or i < part.first + part.count) and len(head := f.read(8)) == 8:
                shape = shape_of(f.read(2 * struct.unpack(">2i", head)[1]))
                box = wkb.bounds(shape) if shape else None
                values = table.row(attributes, i) if i < table.rows else [None] * len(table.fields)
                yield (*values, wkb.write(shape) if shape else None, srid, *(box or (None,) * 4))
                i += 1


def srid_of(prj: str) -> int | None:
    """EPSG code of a projection's text: as it says itself, or of ETRS89 and WGS 84 UTM zones and degrees by their name."""
    found = re.findall(r'AUTHORITY\["EPSG","?(\d+)"?\]\]\s*$', prj)
    if found:
        return int(found[-1])
    zone = re.search(r"(ETRS|WGS)[_ ]?(?:1989|89|1984|84).*?UTM[_ ]Zone[_ ](\d+)([NS])", prj, re.S | re.I)
    if zone:
        return (25800 if zone[1].upper() == "ETRS" else 32700 if zone[3].upper() == "S" else 32600) + int(zone[2])
    return 4326 if re.match(r'\s*GEOGCS\["(GCS_)?WGS', prj) else None


class Shapefile(DataSource):
    """spark.read.format("shapefile").load(path or glob): the attributes, geometry as WKB, srid and bounds x0, y0, x1, y1. Options: encoding (utf-8), rows per partition."""

    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def _files(self) -> list[str]:
        path = self.options["path"].removeprefix("file://")
        files = sorted(glob.glob(path))
        if not files:
            raise FileNotFoundError(path)
        return files

    def schema(self) -> T.StructType:
        own = _Table(self._files()[0][:-4] + ".dbf", self.options.get("encoding", "utf-8")).types()
        return T.StructType([*own, T.StructField("geometry", T.BinaryType()), T.StructField("srid", T.IntegerType()), *[T.StructField(n, T.DoubleType()) for n in ("x0", "y0", "x1", "y1")]])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self._files(), self.options.get("encoding", "utf-8"), int(self.options.get("rows", 50_000)))
