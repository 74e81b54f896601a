"""GeoTIFF files: strips or tiles, uncompressed or deflated, of bytes to doubles."""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Field sizes and codes of the TIFF format, and its tags.
_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
_CODES = {1: "B", 2: "c", 3: "H", 4: "I", 6: "b", 7: "B", 8: "h", 9: "i", 11: "f", 12: "d"}
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIPS, BANDS, ROWS_PER_STRIP, STRIP_BYTES, PLANAR, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES, FORMAT = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284, 317, 322, 323, 324, 325, 339
PIXEL_SCALE, TIEPOINT, TRANSFORM, GEO_KEYS = 33550, 33922, 34264, 34735
PROJECTED, GEOGRAPHIC = 3072, 2048


@dataclass
class Raster:
    """data (bands, height, width), transform (a, b, c, d, e, f) and srid."""

    data: np.ndarray
    transform: tuple[float, ...] = (1.0, 0.0, 0.0, 0.0, 1.0, 0.0)
    srid: int | None = None
    tags: dict = field(default_factory=dict, repr=False)


def read(content: bytes, bands: list[int] | None = None) -> Raster:
    """A raster with the given bands (from 1) or all. Raises ValueError if it can't be read."""
    order = {b"II*\0": "<", b"MM\0*": ">"}.get(content[:4])
    if order is None:
        raise ValueError("not a TIFF")
    try:
        tags = _tags(content, order)
        data = _pixels(content, order, tags, bands)
    except (struct.error, KeyError, IndexError, zlib.error) as e:
        raise ValueError(f"not readable as TIFF: {type(e).__name__} {e}") from None
    return Raster(data, _transform(tags), _srid(tags), tags)


def _tags(content: bytes, order: str) -> dict[int, tuple]:
    (at,) = struct.unpack_from(order + "I", content, 4)
    (n,) = struct.unpack_from(order + "H", content, at)
    tags = {}
    for i in range(n):
        tag, kind, count = struct.unpack_from(order + "HHI", content, at + 2 + 12 * i)
        place = at + 10 + 12 * i
        if _SIZES.get(kind, 99) * count > 4:
            (place,) = struct.unpack_from(order + "I", content, place)
        if kind in _CODES:
            tags[tag] = struct.unpack_from(f"{order}{count}{_CODES[kind]}", content, place)
    return tags


def _pixels(content: bytes, order: str, tags: dict, bands: list[int] | None) -> np.ndarray:
    one = lambda tag, default: tags.get(tag, (default,))[0]
    w, h, n, bits = tags[WIDTH][0], tags[HEIGHT][0], one(BANDS, 1), one(BITS, 1)
    kind = {1: "u", 2: "i", 3: "f"}[one(FORMAT, 1)]
    if bits not in (8, 16, 32, 64) or len(set(tags.get(BITS, (bits,)))) > 1:
        raise ValueError(f"{bits} bits per sample")
    dtype = np.dtype(f"{order}{kind}{bits // 8}")
    pack, planar, compression = n if one(PLANAR, 1) == 1 else 1, one(PLANAR, 1), one(COMPRESSION, 1)
    if compression not in (1, 8, 32946):
        raise ValueError(f"compression {compression}")
    if TILES in tags:
        bw, bh, places, sizes = tags[TILE_WIDTH][0], tags[TILE_HEIGHT][0], tags[TILES], tags[TILE_BYTES]
    else:
        bw, bh, places, sizes = w, min(one(ROWS_PER_STRIP, h), h), tags[STRIPS], tags[STRIP_BYTES]
    out = np.zeros((n, h, w), dtype.newbyteorder("="))
    across, down = -(-w // bw), -(-h // bh)
    for i, (place, size) in enumerate(zip(places, sizes)):
        plane, k = divmod(i, across * down)
        if planar == 2 and bands and plane + 1 not in bands:
            continue
        r, c = divmod(k, across)
        raw = content[place : place + size]
        raw = zlib.decompress(raw) if compression != 1 else raw
        rows = min(bh, h - r * bh) if TILES not in tags else bh
        block = np.frombuffer(raw, dtype, rows * bw * pack).reshape(rows, bw, pack)
        if one(PREDICTOR, 1) == 2:
            block = np.cumsum(block, 1, dtype=dtype)
        block = block[: h - r * bh, : w - c * bw].transpose(2, 0, 1)
        first = plane if planar == 2 else 0
        out[first : first + pack, r * bh : r * bh + block.shape[1], c * bw : c * bw + block.shape[2]] = block
    return out[[b - 1 for b in bands]] if bands else out


def _transform(tags: dict) -> tuple[float, ...]:
    if TRANSFORM in tags:
        m = tags[TRANSFORM]
        return m[0], m[1], m[3], m[4], m[5], m[7]
    if PIXEL_SCALE in tags and TIEPOINT in tags:
        (sx, sy), (i, j, _, x, y, _) = tags[PIXEL_SCALE][:2], tags[TIEPOINT][:6]
        return sx, 0.0, x - i * sx, 0.0, -sy, y + j * sy
    return 1.0, 0.0, 0.0, 0.0, 1.0, 0.0


def _srid(tags: dict) -> int | None:
    keys = tags.get(GEO_KEYS, ())
    found = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i + 1] == 0}
    return found.get(PROJECTED) or found.get(GEOGRAPHIC)


def write(raster: Raster, deflate: bool = True) -> bytes:
    """One strip per band, planes apart. Only north-up transforms can be written."""
    a, b, c, d, e, f = raster.transform
    if b or d:
        raise ValueError("a rotated transform")
    data = np.ascontiguousarray(raster.data)
    n, h, w = data.shape
    little = data.astype(data.dtype.newbyteorder("<"))
    strips = [zlib.compress(band.tobytes(), 6) if deflate else band.tobytes() for band in little]
    kind = {"u": 1, "i": 2, "f": 3}[data.dtype.kind]
    tags = {WIDTH: (4, [w]), HEIGHT: (4, [h]), BITS: (3, [data.dtype.itemsize * 8] * n), COMPRESSION: (3, [8 if deflate else 1]), PHOTOMETRIC: (3, [2 if n >= 3 else 1]), BANDS: (3, [n]), ROWS_PER_STRIP: (4, [h]), STRIP_BYTES: (4, [len(s) for s in strips]), PLANAR: (3, [2 if n > 1 else 1]), FORMAT: (3, [kind] * n), PIXEL_SCALE: (12, [a, -e, 0.0]), TIEPOINT: (12, [0.0, 0.0, 0.0, c, f, 0.0])}
    if n > 3:
        tags[338] = (3, [2] + [0] * (n - 4))  # the fourth band is alpha
    if raster.srid:
        tags[GEO_KEYS] = (3, [1, 1, 0, 2, 1024, 0, 1, 1, PROJECTED, 0, 1, raster.srid])
    at, places = 8, []
    for s in strips:
        places.append(at)
        at += len(s) + len(s) % 2
    tags[STRIPS] = (4, places)
    after = at + 2 + 12 * len(tags) + 4
    entries, extra = b"", b""
    for tag in sorted(tags):
        kind, values = tags[tag]
        raw = struct.pack(f"<{len(values)}{_CODES[kind]}", *values)
        if len(raw) > 4:
            entry = struct.pack("<I", after + len(extra))
            extra += raw + b"\0" * (len(raw) % 2)
        else:
            entry = raw.ljust(4, b"\0")
        entries += struct.pack("<HHI", tag, kind, len(values)) + entry
    body = b"".join(s + b"\0" * (len(s) % 2) for s in strips)
    return b"II*\0" + struct.pack("<I", at) + body + struct.pack("<H", len(tags)) + entries + struct.pack("<I", 0) + extra


def read_chips(spark: SparkSession, path: str, bands: tuple[int, ...] = (1, 2, 3), only: DataFrame | None = None) -> DataFrame:
    """One row per file: raster_id (its name), bands, height, width, transform (six doubles), srid, dtype, data (by bands and rows) and error.

    Asked bands that a file doesn't have are left out. A file that can't be
    read has an error and no data. A row holds one raster, as acquired by tile.
    With `only` (tile_id), files of other names are left out.
    """
    schema = "raster_id string, bands int, height int, width int, transform array<double>, srid int, dtype string, data binary, error string"

    def run(batches):
        for b in batches:
            rows = []
            for name, content in zip(b["path"], b["content"]):
                name = name.rsplit("/", 1)[-1]
                try:
                    r = read(bytes(content))
                    data = r.data[[k - 1 for k in bands if k <= r.data.shape[0]]]
                    rows.append((name, *data.shape, list(r.transform), r.srid, data.dtype.str, data.tobytes(), None))
                except ValueError as e:
                    rows.append((name, None, None, None, None, None, None, None, str(e)))
            frame = pd.DataFrame(rows, columns=[f.split()[0] for f in schema.split(", ")])
            yield frame.astype({k: "Int32" for k in ("bands", "height", "width", "srid")})

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    if only is not None:
        name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.tiff?$", "")
        files = files.withColumn("tile_id", name).join(only.select("tile_id"), "tile_id", "left_semi").select("path", "content")
    return files.mapInPandas(run, schema)
