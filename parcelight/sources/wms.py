"""Map services: requests, answers and the registry of services."""

from __future__ import annotations

import ssl
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelight.functions.boxes import Box

#: Image types by the name of a format.
FORMATS = {"geotiff": "image/tiff", "tiff": "image/tiff", "tif": "image/tiff", "jpeg": "image/jpeg", "jpg": "image/jpeg", "png": "image/png"}
EXTENSIONS = {"image/tiff": ".tif", "image/jpeg": ".jpg", "image/png": ".png"}
SERVICE_SCHEMA = "service string, pref int, url string, version string, default_layer string, crs string, resolution_cm int, x0 double, y0 double, x1 double, y1 double"
#: Seconds to wait for capabilities and for a map, and the bytes below which an answer is no map.
CAPABILITIES_S, MAP_S, LEAST_BYTES = 30, 120, 1000


def _lookup(table: dict[str, str], key: Column, default: str) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[key], F.lit(default))


def mime_type(name: Column) -> Column:
    """Image type of a format's name in any case, with or without a dot; TIFF if unknown or null."""
    return _lookup(FORMATS, F.replace(F.lower(name), F.lit("."), F.lit("")), "image/tiff")


def extension(mime: Column) -> Column:
    return _lookup(EXTENSIONS, mime, ".tif")


def file_name(service: Column, lat: Column, lon: Column, size_m: Column) -> Column:
    return F.format_string("ortho_%s_%.4f_%.4f_%dm", service, lat, lon, size_m)


def sniff(content: Column) -> Column:
    """Kind of a downloaded file by its first bytes: JPEG, GeoTIFF, PNG, WMS Error or unknown.

    An error report is looked for in the first 1024 bytes. Null and empty
    contents are unknown.
    """
    head = lambda n: F.hex(F.substring(content, 1, n))
    report = F.contains(F.decode(F.substring(content, 1, 1024), "ISO-8859-1"), F.lit("ServiceException"))
    return F.when(head(2) == "FFD8", "JPEG").when(head(4).isin("49492A00", "4D4D002A"), "GeoTIFF").when(head(4) == "89504E47", "PNG").when(report, "WMS Error").otherwise("unknown")


def validated(files: DataFrame) -> DataFrame:
    """size_bytes, size_kb, format and valid of files (path, content)."""
    kind = sniff(F.col("content"))
    return files.select("path", F.octet_length("content").alias("size_bytes"), (F.octet_length("content") / 1024).alias("size_kb"), kind.alias("format"), kind.isin("JPEG", "GeoTIFF", "PNG").alias("valid"))


def capabilities_url(url: Column, version: Column) -> Column:
    return F.concat(url, F.lit("?SERVICE=WMS&REQUEST=GetCapabilities&VERSION="), version)


def map_url(url: Column, version: Column, layer: Column, crs: Column, bbox: Box, width: Column, height: Column, mime: Column) -> Column:
    """The GetMap request of a box in the service's own system."""
    sides = F.concat_ws(",", *[s.cast("string") for s in (bbox.x0, bbox.y0, bbox.x1, bbox.y1)])
    parts = [("SERVICE", F.lit("WMS")), ("VERSION", version), ("REQUEST", F.lit("GetMap")), ("LAYERS", layer), ("STYLES", F.lit("")), ("CRS", crs), ("BBOX", sides), ("WIDTH", width.cast("string")), ("HEIGHT", height.cast("string")), ("FORMAT", mime), ("TRANSPARENT", F.lit("FALSE"))]
    return F.concat(url, F.lit("?"), F.concat_ws("&", *[F.concat(F.lit(f"{k}="), v) for k, v in parts]))


def with_services(df: DataFrame, services: DataFrame) -> DataFrame:
    """Each row with each service of a registry of at most 1000, which is checked; by an explode, without a join."""
    rows = services.limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("a registry has at most 1000 services")
    kinds = {f.name: f.dataType.simpleString() for f in services.schema.fields}
    entries = [F.struct(*[F.lit(r[c]).cast(t).alias(c) for c, t in kinds.items()]) for r in rows]
    if not entries:
        return df.limit(0).select("*", *[F.lit(None).cast(t).alias(c) for c, t in kinds.items()])
    return df.withColumn("_service", F.explode(F.array(*entries))).select(*df.columns, "_service.*")


def requests(centres: DataFrame, services: DataFrame, size_m: float, fmt: str = "geotiff") -> DataFrame:
    """The request for a square around each centre (id, lon, lat) from the first service that covers it.

    `services` is a registry (SERVICE_SCHEMA) of at most 1000 rows, which is
    checked; a service without extent covers everything. Centres that none
    covers have no row.
    """
    from parcelight.functions.utm import to_utm

    placed = with_services(centres, services).withColumn("_epsg", F.regexp_extract("crs", r"EPSG:(\d+)", 1).try_cast("int"))
    x, y = to_utm(F.col("lon"), F.col("lat"), F.col("_epsg"))
    placed = placed.withColumns({"cx": x, "cy": y})
    covered = placed.filter("x0 is null or (cx between x0 and x1 and cy between y0 and y1)")
    keep = [c for c in centres.columns if c != "id"]
    first = covered.groupBy("id").agg(F.min_by(F.struct(*keep, *services.columns, "cx", "cy"), "pref").alias("r")).select("id", "r.*")
    px = (F.lit(size_m) / (F.col("resolution_cm") / 100)).cast("int")
    box = Box.of(F.col("cx"), F.col("cy"), F.col("cx"), F.col("cy")).grown(size_m / 2)
    mime = mime_type(F.lit(fmt))
    url = map_url(F.col("url"), F.col("version"), F.col("default_layer"), F.col("crs"), box, px, px, mime)
    name = F.concat(file_name(F.col("service"), F.col("lat"), F.col("lon"), F.lit(size_m).cast("int")), extension(mime))
    return first.select("id", "service", url.alias("request"), name.alias("file"))


def http_get(url: str, timeout: float) -> bytes:
    with urllib.request.urlopen(url, timeout=timeout, context=ssl.create_default_context()) as answer:
        return answer.read()


def fetched(asked: DataFrame, get: Callable[[str, float], bytes] = http_get, timeout: float = MAP_S) -> DataFrame:
    """Requests (id, request, ...) with content and error; a failed request has an error and no content, the others go on."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            contents, errors = [], []
            for url in b["request"]:
                try:
                    data = get(url, timeout)
                    small = len(data) < LEAST_BYTES
                    contents.append(None if small else data)
                    errors.append(f"answer of {len(data)} bytes: {data[:200].decode('utf-8', 'replace')}" if small else None)
                except Exception as e:
                    contents.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield b.assign(content=contents, error=errors)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in asked.schema.fields)
    return asked.mapInPandas(run, f"{schema}, content binary, error string")


def layers(documents: DataFrame) -> DataFrame:
    """(name, crs, x0, y0, x1, y1) of the named layers of capabilities documents (content string) that have a box of their own.

    The first BoundingBox of a layer counts; missing sides are 0. Layers
    inside layers come too. Unreadable documents have none.
    """
    import xml.etree.ElementTree as ET

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for text in b["content"]:
                try:
                    root = ET.fromstring(text)
                except (ET.ParseError, TypeError):
                    continue
                for layer in root.iterfind(".//{*}Layer"):
                    name, box = layer.find("{*}Name"), layer.find("{*}BoundingBox")
                    if name is not None and name.text and box is not None:
                        rows.append((name.text, box.get("CRS", ""), *(float(box.get(k, 0)) for k in ("minx", "miny", "maxx", "maxy"))))
            yield pd.DataFrame(rows, columns=["name", "crs", "x0", "y0", "x1", "y1"])

    return documents.select("content").mapInPandas(run, "name string, crs string, x0 double, y0 double, x1 double, y1 double")


def registry(spark: SparkSession, config: dict) -> DataFrame:
    """Services of a configuration's `wms_services`, in their order."""
    rows = []
    for i, (key, s) in enumerate((config.get("wms_services") or {}).items(), 1):
        e = s.get("extent") or {}
        rows.append((key, i, s.get("url"), str(s.get("version", "1.3.0")), s.get("default_layer"), s.get("crs"), int(s.get("resolution_cm") or 25), *(float(e[k]) if k in e else None for k in ("minx", "miny", "maxx", "maxy"))))
    return spark.createDataFrame(rows, SERVICE_SCHEMA)
