"""Point geometries in their text forms, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"
#: WKT and EWKT: optional SRID, POINT or MULTIPOINT of one point, optional Z/M/ZM, two or more ordinates.
_WKT = rf"(?is)^\s*(?:SRID\s*=\s*\d+\s*;)?\s*(?:MULTI)?POINT\s*(?:Z|M|ZM)?\s*\(\s*\(?\s*({_NUMBER}\s+{_NUMBER})(?:\s+{_NUMBER}){{0,2}}\s*\)?\s*\)\s*$"
_GEOJSON = rf"(?s)^\s*\{{.*\"coordinates\"\s*:\s*\[\s*\[?\s*({_NUMBER}\s*,\s*{_NUMBER})"
_EWKT_SRID = r"(?i)^\s*SRID\s*=\s*(\d+)"


def point_texts(text: Column) -> Column:
    """The first two ordinates of a written point as an array of texts; null or of one empty text if there is none."""
    json = F.ltrim(text).startswith("{") & text.rlike(r'"(?:Multi)?Point"')
    return F.split(F.when(json, F.regexp_extract(text, _GEOJSON, 1)).otherwise(F.regexp_extract(text, _WKT, 1)), r"[\s,]+")


def located(x: Column, y: Column) -> Column:
    """Whether ordinates are a location: both finite, and not the placeholder 0 0."""
    return x.isNotNull() & y.isNotNull() & ~((x == 0) & (y == 0)) & (F.abs(x) < float("inf")) & (F.abs(y) < float("inf"))


def point_xy(text: Column) -> tuple[Column, Column]:
    """x and y of a point written as WKT, EWKT or GeoJSON (also as a
    multipoint of one, also with a third ordinate).

    Null, empty, unreadable or EMPTY texts and the placeholder 0 0 give nulls:
    they all mean that there is no location. Over many rows, point_texts in a
    projection of its own saves searching each text twice.
    """
    parts = point_texts(text)
    x, y = F.get(parts, F.lit(0)).try_cast("double"), F.get(parts, F.lit(1)).try_cast("double")
    return F.when(located(x, y), x), F.when(located(x, y), y)


def point_srid(text: Column) -> Column:
    """The SRID that an EWKT text names, else null."""
    found = F.regexp_extract(text, _EWKT_SRID, 1)
    return F.when(found != "", found).try_cast("int")
