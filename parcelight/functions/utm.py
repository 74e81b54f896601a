"""UTM coordinates as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Semi-major axis and squared eccentricity of GRS 80 as rounded in common UTM tables, scale on the meridian, false easting and northing.
SEMI_MAJOR, ECC2, SCALE, EASTING, NORTHING_SOUTH = 6378137.0, 0.00669438, 0.9996, 500000.0, 10000000.0


def zone_of(epsg: Column) -> Column:
    """UTM zone of an EPSG code of ETRS89 (258zz) or WGS 84 (326zz north, 327zz south); null for others."""
    within = lambda base: epsg.between(base + 1, base + 60)
    return F.when(within(25800), epsg - 25800).when(within(32600), epsg - 32600).when(within(32700), epsg - 32700)


def is_south(epsg: Column) -> Column:
    return epsg.between(32701, 32760)


def _meridian_arc(lat: Column) -> Column:
    n1, n2, n3 = ECC2, ECC2**2, ECC2**3
    series = (1 - n1 / 4 - 3 * n2 / 64 - 5 * n3 / 256) * lat
    for k, c in ((2, -(3 * n1 / 8 + 3 * n2 / 32 + 45 * n3 / 1024)), (4, 15 * n2 / 256 + 45 * n3 / 1024), (6, -35 * n3 / 3072)):
        series = series + c * F.sin(lat * k)
    return SEMI_MAJOR * series


def to_utm(lon: Column, lat: Column, epsg: Column, legacy: bool = False) -> tuple[Column, Column]:
    """Easting and northing of a longitude and latitude in degrees.

    The series of the transverse Mercator projection (Snyder, Map Projections,
    1987, eq. 8-9 and 8-10). `legacy` takes e^4 / (1 - e^4) for e'^2, as some
    older code does; it is a few centimetres off.
    """
    second = ECC2**2 / (1 - ECC2**2) if legacy else ECC2 / (1 - ECC2)
    phi = F.radians(lat)
    radius = SEMI_MAJOR / F.sqrt(1 - ECC2 * F.sin(phi) ** 2)
    t, c = F.tan(phi) ** 2, second * F.cos(phi) ** 2
    a = F.cos(phi) * (F.radians(lon) - F.radians(zone_of(epsg) * 6 - 183))
    east = a + (1 - t + c) * a**3 / 6 + (5 - 18 * t + t**2 + 72 * c - 58 * second) * a**5 / 120
    north = a**2 / 2 + (5 - t + 9 * c + 4 * c**2) * a**4 / 24 + (61 - 58 * t + t**2 + 600 * c - 330 * second) * a**6 / 720
    y = SCALE * (_meridian_arc(phi) + radius * F.tan(phi) * north)
    return SCALE * radius * east + EASTING, F.when(is_south(epsg), y + NORTHING_SOUTH).otherwise(y)


def from_utm(df: DataFrame, x: str, y: str, epsg: Column, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """df with longitude and latitude in degrees of UTM coordinates (Snyder, eq. 8-17 and 8-18).

    In steps, so that the terms that recur are evaluated once per row instead
    of being put into each other.
    """
    second = ECC2 / (1 - ECC2)
    e1 = (1 - (1 - ECC2) ** 0.5) / (1 + (1 - ECC2) ** 0.5)
    around = 1 - ECC2 / 4 - 3 * ECC2**2 / 64 - 5 * ECC2**3 / 256
    col = lambda name: F.col(f"_utm_{name}")
    step = lambda df, **c: df.withColumns({f"_utm_{k}": v for k, v in c.items()})
    df = step(df, e=epsg)
    df = step(df, mu=F.when(is_south(col("e")), F.col(y) - NORTHING_SOUTH).otherwise(F.col(y)) / (SCALE * SEMI_MAJOR * around))
    foot = col("mu")
    for k, c in ((2, 3 * e1 / 2 - 27 * e1**3 / 32), (4, 21 * e1**2 / 16 - 55 * e1**4 / 32), (6, 151 * e1**3 / 96), (8, 1097 * e1**4 / 512)):
        foot = foot + c * F.sin(col("mu") * k)
    df = step(df, foot=foot)
    df = step(df, c=second * F.cos(col("foot")) ** 2, tan=F.tan(col("foot")), cos=F.cos(col("foot")), w=1 - ECC2 * F.sin(col("foot")) ** 2)
    df = step(df, t=col("tan") ** 2, d=(F.col(x) - EASTING) / (SEMI_MAJOR / F.sqrt(col("w")) * SCALE))
    c1, t1, d = col("c"), col("t"), col("d")
    curve = col("tan") * col("w") / (1 - ECC2)  # n tan / r, r being n (1 - e^2) / w
    latitude = col("foot") - curve * (d**2 / 2 - (5 + 3 * t1 + 10 * c1 - 4 * c1**2 - 9 * second) * d**4 / 24 + (61 + 90 * t1 + 298 * c1 + 45 * t1**2 - 252 * second - 3 * c1**2) * d**6 / 720)
    longitude = (d - (1 + 2 * t1 + c1) * d**3 / 6 + (5 - 2 * c1 + 28 * t1 - 3 * c1**2 + 8 * second + 24 * t1**2) * d**5 / 120) / col("cos")
    df = df.withColumns({lon: F.degrees(longitude) + (zone_of(col("e")) * 6 - 183), lat: F.degrees(latitude)})
    return df.drop(*[c for c in df.columns if c.startswith("_utm_")])


def reproject(df: DataFrame, x: str, y: str, source: Column, target: Column) -> DataFrame:
    """df with UTM columns x and y in another UTM system; unchanged where both are the same."""
    out = from_utm(df.withColumns({"_from": source, "_to": target}), x, y, F.col("_from"), "_lon", "_lat")
    tx, ty = to_utm(F.col("_lon"), F.col("_lat"), F.col("_to"))
    out = out.withColumns({"_tx": tx, "_ty": ty})
    same = F.col("_from") == F.col("_to")
    out = out.withColumns({x: F.when(same, F.col(x)).otherwise(F.col("_tx")), y: F.when(same, F.col(y)).otherwise(F.col("_ty"))})
    return out.drop("_from", "_to", "_lon", "_lat", "_tx", "_ty")
