"""Vector queries over detections, tiles and prosumers: geometry, filters, joins, aggregates, windows, set operations and scalar functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelight.functions import polygons, utm
from parcelight.functions.boxes import Box, affine
from parcelight.functions.classes import power_class, status_class
from parcelight.operators import metrics
from parcelight.operators.patches import donut_area, in_donut, patch_grid
from parcelight.operators.rangesort import running_sums
from parcelight.operators.spatial import box_pairs, points_near_boxes
from parcelight.operators.sweep import near_shapes
from parcelight.plans import detectors
from parcelight.plans.domain import NEGATIVE, Domain, Registry, plain_prompt
from parcelight.sources.wms import extension, mime_type, sniff, with_services

query = Registry()
queries, oracle_sql = query.runs.copy, query.sql.copy
BOX = Box()
EDGES, SHAPE = "edges", "shape"
_NEG = f"prompt in {NEGATIVE}"
#: Metres within which a prosumer belongs to a mask, and within which it is near one.
SNAP, BUFFER = 10.0, 50.0


# --- geometry ---------------------------------------------------------------


@query("select id, area from boxes")
def geom_area(d: Domain) -> DataFrame:
    return d.detections.filter("edges is not null").select("id", "area")


@query("select id, round(x1 - x0, 2) as width_m, round(y1 - y0, 2) as height_m from boxes")
def geom_bounds_wh(d: Domain) -> DataFrame:
    return d.detections.filter("edges is not null").select("id", F.round(BOX.width, 2).alias("width_m"), F.round(BOX.height, 2).alias("height_m"))


@query("select id, greatest(x1 - x0, y1 - y0) / least(x1 - x0, y1 - y0) as aspect from boxes where x1 > x0 and y1 > y0")
def geom_aspect(d: Domain) -> DataFrame:
    return d.detections.select("id", BOX.aspect.alias("aspect")).filter("aspect is not null")


@query("""select id, round(sum((ax - x0 + bx - x0) * c) / (3 * sum(c)) + x0, 4) as cx, round(sum((ay - y0 + b_y - y0) * c) / (3 * sum(c)) + y0, 4) as cy
    from (select b.id, x0, y0, ax, ay, bx, b_y, (ax - x0) * (b_y - y0) - (bx - x0) * (ay - y0) as c from boxes b join edges e on e.id = b.id) group by id, x0, y0""")
def geom_centroid(d: Domain) -> DataFrame:
    cx, cy = polygons.centroid(F.col(EDGES), BOX.x0, BOX.y0)
    return d.detections.select("id", F.round(cx, 4).alias("cx"), F.round(cy, 4).alias("cy")).filter("cx is not null")


@query("select tile, (x1 - x0) * (y1 - y0) as area from grid")
def geom_make_box(d: Domain) -> DataFrame:
    """A box from four numbers, as a polygon: its area comes from its edges."""
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    ring = F.array(corner(BOX.x0, BOX.y0), corner(BOX.x1, BOX.y0), corner(BOX.x1, BOX.y1), corner(BOX.x0, BOX.y1))
    edges = polygons.edges(F.array(F.array(ring)))
    return d.grid.select("tile", polygons.area(edges, BOX.x0, BOX.y0).alias("area"))


@query("select pid, x - 64 as x0, y - 64 as y0, x + 64 as x1, y + 64 as y1 from points")
def bbox_from_center(d: Domain) -> DataFrame:
    return d.prosumers.select("pid", *Box.of(F.col("x"), F.col("y"), F.col("x"), F.col("y")).grown(64.0).columns())


@query("select id, cast(trunc((x1 - x0) / 0.25::double) as int) as px from boxes")
def px_dims(d: Domain) -> DataFrame:
    return d.detections.filter("edges is not null").select("id", (BOX.width / 0.25).cast("int").alias("px"))


@query("""select id, round(x0, 3) as x0, round(y0, 3) as y0, round(x1, 3) as x1, round(y1, 3) as y1 from boxes""")
def pixel_to_geo_affine(d: Domain) -> DataFrame:
    """To pixels of the tile and by its transform back to the ground."""
    left, top = F.floor(BOX.x0 / 1000) * 1000.0, F.ceil(BOX.y1 / 1000) * 1000.0
    pixels = d.detections.filter("edges is not null").select("id", left.alias("left"), top.alias("top"), *Box.of((BOX.x0 - left) * 4, (top - BOX.y1) * 4, (BOX.x1 - left) * 4, (top - BOX.y0) * 4).columns())
    zero = F.lit(0.0)
    ground = affine(BOX, F.lit(0.25), zero, F.col("left"), zero, F.lit(-0.25), F.col("top"))
    return pixels.select("id", *[F.round(c, 3).alias(n) for c, n in zip((ground.x0, ground.y0, ground.x1, ground.y1), ("x0", "y0", "x1", "y1"))])


@query("select tile, x0 + 0.25::double * 448 as c, y1 - 0.25::double * 896 as f from grid")
def patch_transform(d: Domain) -> DataFrame:
    """The transform of the patch at column 448 and row 896 of each tile."""
    return d.grid.select("tile", (BOX.x0 + 0.25 * F.lit(448)).alias("c"), (BOX.y1 - 0.25 * F.lit(896)).alias("f"))


@query("select id, x0 + 340000 as x0, y0 + 10 as y0, x1 + 340000 as x1, y1 + 10 as y1 from boxes")
def box_offset(d: Domain) -> DataFrame:
    return d.detections.filter("edges is not null").select("id", *BOX.moved(F.lit(340000), F.lit(10)).columns())


@query("""with m as (select b.id, greatest(0::double, b.x0 - g.x0) as x0, greatest(0::double, b.y0 - g.y0) as y0, least(1000::double, b.x1 - g.x0) as x1, least(1000::double, b.y1 - g.y0) as y1 from boxes b join grid g using (tile))
    select * from m where x1 - x0 >= 1 and y1 - y0 >= 1""")
def box_clamp(d: Domain) -> DataFrame:
    """Boxes in metres from their tile's corner, cut to the tile; what is left of less than 1 m falls away."""
    tiles = d.grid.select("tile", F.col("x0").alias("gx"), F.col("y0").alias("gy"))
    met = d.detections.filter("edges is not null").join(tiles, "tile")
    return met.select("id", *BOX.moved(-F.col("gx"), -F.col("gy")).clamped(1000.0, 1000.0).columns()).filter((BOX.width >= 1) & (BOX.height >= 1))


@query("select id, min(x) + 2.5::double as x0, max(y) - 1.5::double as y1 from corners group by id")
def geom_translate(d: Domain) -> DataFrame:
    box = polygons.bounds(polygons.edges(polygons.moved(F.col(SHAPE), F.lit(2.5), F.lit(-1.5))))
    return d.detections.filter("edges is not null").select("id", box.x0.alias("x0"), box.y1.alias("y1"))


@query("select tile, x0 - 250 as x0, y0 - 250 as y0, x1 + 250 as x1, y1 + 250 as y1 from grid")
def geom_buffer_mitre(d: Domain) -> DataFrame:
    return d.grid.select("tile", *BOX.grown(250.0).columns())


@query("select id, pid from nears where distance < 2.1::double")
def geom_buffer(d: Domain) -> DataFrame:
    """Points within a polygon dilated with round corners: nearer than the distance."""
    return points_near_boxes(d.masks.select("id", EDGES, *BOX.columns()), d.points, 2.1, edges=EDGES).select("id", "pid")


@query("""select tile, (x1 - x0 + 500) * (y1 - y0 + 500) - (x1 - x0) * (y1 - y0) as area from grid""")
def geom_difference(d: Domain) -> DataFrame:
    return d.grid.select("tile", donut_area(BOX, 0.25).alias("area"))


@query("""select tile, pid from grid join points on (x between x0 - 250 and x1 + 250) and (y between y0 - 250 and y1 + 250) where not (x between x0 and x1 and y between y0 and y1)""")
def donut_membership(d: Domain) -> DataFrame:
    """Prosumers in the ring around each tile."""
    near = points_near_boxes(d.grid.select(F.col("tile").alias("id"), *BOX.columns()), d.points, 360.0)
    return near.filter(in_donut(BOX, F.col("x"), F.col("y"), 0.25)).select(F.col("id").alias("tile"), "pid")


@query("select id from firsts where geometry is null or geometry not like '%(%'")
def geom_is_empty(d: Domain) -> DataFrame:
    """Detections without an area, which sinks leave out."""
    return d.detections.filter("edges is null").select("id")


_UTM_SQL = """
    p as (select tile, radians(40 + (x0 % 50000) / 1000000) as lat, radians(0.5::double + (y0 % 40000) / 1000000) as lon, cast(25830 + cast(x0 / 1000 as int) % 2 as int) as epsg from grid
    ), z as (select *, 0.00669438::double as e, radians((epsg - 25800) * 6 - 183) as cm from p
    ), q as (select *, 6378137 / sqrt(1 - e * pow(sin(lat), 2)) as n, pow(tan(lat), 2) as t, {ep} as ep from z
    ), r as (select *, ep * pow(cos(lat), 2) as c, cos(lat) * (lon - cm) as a,
      6378137 * ((1 - e / 4 - 3 * e * e / 64 - 5 * e * e * e / 256) * lat - (3 * e / 8 + 3 * e * e / 32 + 45 * e * e * e / 1024) * sin(2 * lat)
        + (15 * e * e / 256 + 45 * e * e * e / 1024) * sin(4 * lat) - (35 * e * e * e / 3072) * sin(6 * lat)) as m from q)
    select tile, epsg, round(0.9996::double * n * (a + (1 - t + c) * pow(a, 3) / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep) * pow(a, 5) / 120) + 500000, 4) as x,
      round(0.9996::double * (m + n * tan(lat) * (a * a / 2 + (5 - t + 9 * c + 4 * c * c) * pow(a, 4) / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep) * pow(a, 6) / 720)), 4) as y from r"""


def _degrees(d: Domain) -> DataFrame:
    return d.grid.select("tile", (F.lit(40.0) + (BOX.x0 % 50000) / 1000000).alias("lat"), (F.lit(0.5) + (BOX.y0 % 40000) / 1000000).alias("lon"), (F.lit(25830) + (BOX.x0 / 1000).cast("int") % 2).cast("int").alias("epsg"))


@query("with" + _UTM_SQL.format(ep="e / (1 - e)"))
def wgs84_to_utm(d: Domain) -> DataFrame:
    x, y = utm.to_utm(F.col("lon"), F.col("lat"), F.col("epsg"))
    return _degrees(d).select("tile", "epsg", F.round(x, 4).alias("x"), F.round(y, 4).alias("y"))


@query("with" + _UTM_SQL.format(ep="e * e / (1 - e * e)"))
def wgs84_to_utm_legacy(d: Domain) -> DataFrame:
    x, y = utm.to_utm(F.col("lon"), F.col("lat"), F.col("epsg"), legacy=True)
    return _degrees(d).select("tile", "epsg", F.round(x, 4).alias("x"), F.round(y, 4).alias("y"))


@query("select tile, x0 + 229000 as x, y0 as y from grid")
def crs_transform(d: Domain) -> DataFrame:
    """To the neighbouring zone and back again: where it started, to the centimetre."""
    start = d.grid.select("tile", (BOX.x0 + 229000).alias("x"), BOX.y0.alias("y"))
    there = utm.reproject(start, "x", "y", F.lit(25831), F.lit(25830))
    back = utm.reproject(there, "x", "y", F.lit(25830), F.lit(25831))
    return back.select("tile", F.round("x", 2).alias("x"), F.round("y", 2).alias("y"))


@query("select pid, coalesce(srid, 25831) as srid from points")
def crs_set_default(d: Domain) -> DataFrame:
    return d.prosumers.select("pid", F.coalesce("srid", F.lit(25831)).alias("srid"))


@query("select id, round(area, 2) as area_m2, round(score, 3) as score from (select id, area + 0.001013::double as area, score + 0.000113::double as score from boxes)")
def round_props(d: Domain) -> DataFrame:
    """Areas to 2 and scores to 3 places; a little is added first, as engines differ on halves."""
    return d.detections.filter("edges is not null").select("id", F.round(F.col("area") + 0.001013, 2).alias("area_m2"), F.round(F.col("score") + 0.000113, 3).alias("score"))


# --- filters ----------------------------------------------------------------


def _kept(d: Domain, condition: Column | str) -> DataFrame:
    return d.detections.filter("edges is not null").filter(condition).select("id")


@query("select id from boxes where area between 1 and 50")
def filter_area(d: Domain) -> DataFrame:
    return _kept(d, F.col("area").between(1, 50))


@query("select id from boxes where area between 0.5 and 2000")
def filter_area_phase4(d: Domain) -> DataFrame:
    return _kept(d, F.col("area").between(0.5, 2000))


@query("select id from boxes where greatest(x1 - x0, y1 - y0) / least(x1 - x0, y1 - y0) <= 2.000001::double")
def filter_aspect(d: Domain) -> DataFrame:
    return _kept(d, BOX.aspect <= 2.000001)


@query("select id from boxes where area <= 4000 * 4000 * 0.0625::double * 0.0001::double")
def filter_occupancy(d: Domain) -> DataFrame:
    return _kept(d, F.col("area") <= 4000 * 4000 * 0.25**2 * 0.0001)


@query("select id from boxes where tile = '31TAF2121'")
def filter_tile_id(d: Domain) -> DataFrame:
    return _kept(d, F.col("tile") == "31TAF2121")


@query("select tile from grid where x0 <= 123000 and x1 >= 121000 and y0 <= 4518000 and y1 >= 4515000")
def filter_bbox(d: Domain) -> DataFrame:
    return d.grid.filter(BOX.touches(Box.of(*map(F.lit, (121000.0, 4515000.0, 123000.0, 4518000.0))))).select("tile")


@query("select tile, case when tile in (select tile from boxes where region = 'core') then 'processed' else 'pending' end as status from grid")
def filter_status(d: Domain) -> DataFrame:
    """Tiles with detections of their core are processed."""
    outputs = d.boxes.filter("region = 'core'")
    status = lambda how, name: d.grid.join(outputs, "tile", how).select("tile", F.lit(name).alias("status"))
    return status("left_semi", "processed").unionByName(status("left_anti", "pending"))


def buildings_of(d: Domain, distance: float) -> DataFrame:
    """(id, fid): masks at most `distance` from a footprint."""
    return near_shapes(d.masks, d.buildings.withColumnRenamed("fid", "id"), distance, EDGES).withColumnRenamed("other", "fid")


#: hits (id, fid): a polygon and a box cross, one holds a corner of the other, or the distance of a corner from a side is small enough.
NEAR_BOX = """with sides as (select fid, unnest([{{'ax': x0, 'ay': y0, 'bx': x1, 'b_y': y0}}, {{'ax': x1, 'ay': y0, 'bx': x1, 'b_y': y1}}, {{'ax': x1, 'ay': y1, 'bx': x0, 'b_y': y1}}, {{'ax': x0, 'ay': y1, 'bx': x0, 'b_y': y0}}]) as s from buildings
    ), met as (select b.id, f.fid, f.x0 as fx0, f.y0 as fy0, f.x1 as fx1, f.y1 as fy1 from boxes b join buildings f on b.x0 <= f.x1 + {d} and b.x1 >= f.x0 - {d} and b.y0 <= f.y1 + {d} and b.y1 >= f.y0 - {d}
    ), e as (select met.*, n, ax, ay, bx, b_y, s.ax as cx, s.ay as cy, s.bx as dx, s.b_y as dy from met join edges using (id) join sides on sides.fid = met.fid
    ), o as (select *, greatest(0, least(1, ((cx - ax) * (bx - ax) + (cy - ay) * (b_y - ay)) / (pow(bx - ax, 2) + pow(b_y - ay, 2)))) as t, greatest(0, least(1, ((ax - cx) * (dx - cx) + (ay - cy) * (dy - cy)) / (pow(dx - cx, 2) + pow(dy - cy, 2)))) as u,
        (bx - ax) * (cy - ay) - (b_y - ay) * (cx - ax) as s1, (bx - ax) * (dy - ay) - (b_y - ay) * (dx - ax) as s2, (dx - cx) * (ay - cy) - (dy - cy) * (ax - cx) as s3, (dx - cx) * (b_y - cy) - (dy - cy) * (bx - cx) as s4 from e
    ), g as (select id, fid, min(sqrt(pow(cx - ax - t * (bx - ax), 2) + pow(cy - ay - t * (b_y - ay), 2))) as g1, min(sqrt(pow(ax - cx - u * (dx - cx), 2) + pow(ay - cy - u * (dy - cy), 2))) as g2,
        bool_or(s1 * s2 < 0 and s3 * s4 < 0) as crossing, bool_or(ax between fx0 and fx1 and ay between fy0 and fy1) as holds,
        count(distinct case when (ay > fy0) <> (b_y > fy0) and fx0 < (bx - ax) * (fy0 - ay) / (b_y - ay) + ax then n end) % 2 = 1 as inner_corner from o group by id, fid
    ), hits as (select id, fid from g where crossing or holds or inner_corner or least(g1, g2) <= {d}) """


@query(NEAR_BOX.format(d=2) + "select distinct id from hits")
def filter_building(d: Domain) -> DataFrame:
    """Masks at most 2 m from a footprint."""
    return buildings_of(d, 2.0).select("id").distinct()


@query(NEAR_BOX.format(d=0) + "select distinct id from hits")
def semi_building(d: Domain) -> DataFrame:
    return buildings_of(d, 0.0).select("id").distinct()


@query("select tile from grid where x0 <= 125500 and x1 >= 122500 and y0 <= 4519500 and y1 >= 4516500")
def filter_raster_extent(d: Domain) -> DataFrame:
    return d.grid.filter(BOX.touches(Box.of(*map(F.lit, (122500.0, 4516500.0, 125500.0, 4519500.0))))).select("tile")


@query("select id, score > 0.6::double as confident from boxes where score > 0.4::double")
def filter_score(d: Domain) -> DataFrame:
    return d.detections.filter("edges is not null and score > 0.4D").select("id", (F.col("score") > 0.6).alias("confident"))


_SERVICES = "(values ('icgc', 1, 111500::double, 4515000::double, 130000::double, 4540000::double), ('ign', 2, null, null, null, null))"
_IN_SERVICE = f"grid join {_SERVICES} s(service, pref, a, b, c, e) on a is null or ((x0 + x1) / 2 between a and c and (y0 + y1) / 2 between b and e)"


def _covered(d: Domain) -> DataFrame:
    """Centres of tiles with the services that cover them; the registry has a fixed few rows."""
    services = d.spark.createDataFrame([("icgc", 1, 111500.0, 4515000.0, 130000.0, 4540000.0), ("ign", 2, None, None, None, None)], "service string, pref int, sx0 double, sy0 double, sx1 double, sy1 double")
    centre = d.grid.select("tile", ((F.col("x0") + F.col("x1")) / 2).alias("x"), ((F.col("y0") + F.col("y1")) / 2).alias("y"))
    inside = F.col("sx0").isNull() | (F.col("x").between(F.col("sx0"), F.col("sx1")) & F.col("y").between(F.col("sy0"), F.col("sy1")))
    return with_services(centre, services).filter(inside)


@query(f"select tile, service from {_IN_SERVICE}")
def filter_extent_cover(d: Domain) -> DataFrame:
    return _covered(d).select("tile", "service")


@query(f"select tile, arg_min(service, pref) as service from {_IN_SERVICE} group by tile")
def first_match_service(d: Domain) -> DataFrame:
    return _covered(d).groupBy("tile").agg(F.min_by("service", "pref").alias("service"))


@query(f"select tile, service from {_IN_SERVICE} qualify row_number() over (partition by tile order by pref) = 1")
def win_first_match(d: Domain) -> DataFrame:
    first = F.row_number().over(Window.partitionBy("tile").orderBy("pref"))
    return _covered(d).withColumn("n", first).filter("n = 1").select("tile", "service")


@query("""select pid, case when pot_kw >= 0 and pot_kw <= 5 then '0-5' when pot_kw > 5 and pot_kw <= 25 then '5-25' when pot_kw > 25 and pot_kw <= 100 then '25-100' when pot_kw > 100 then '>100' end as class from points""")
def case_sld_power(d: Domain) -> DataFrame:
    return d.prosumers.select("pid", power_class(F.col("pot_kw")).alias("class"))


@query("""select pid, case when estat = 'active' and coalesce(srid, 0) = 25831 then 'active' when estat = 'active' and srid is null then 'active, unplaced' when estat = 'closed' or estat = 'pending' then 'idle' end as class
    from (select pid, lower(estat) as estat, srid from points)""")
def case_sld_status(d: Domain) -> DataFrame:
    rules = [("active", [[("estat", "=", "active"), ("srid", "=", "25831")]]), ("active, unplaced", [[("estat", "=", "active"), ("srid", "<>", "25831")]]), ("idle", [[("estat", "=", "closed")], [("estat", "=", "pending")]])]
    return d.prosumers.select("pid", F.lower("estat").alias("estat"), F.coalesce(F.col("srid").cast("string"), F.lit("none")).alias("srid")).select("pid", status_class(rules).alias("class"))


# --- joins ------------------------------------------------------------------


def _inside(d: Domain, masks: DataFrame | None = None) -> DataFrame:
    """(id, tile, region, pid): prosumers strictly inside a mask's rings."""
    masks = d.masks if masks is None else masks
    return points_near_boxes(masks.select("id", "tile", "region", EDGES, *BOX.columns()), d.points, 0.0, edges=EDGES)


@query("select b.id, count(pid) as prosumers_inside from boxes b left join insides i on i.id = b.id group by b.id")
def join_points_within_masks(d: Domain) -> DataFrame:
    inside = _inside(d).groupBy("id").agg(F.count("*").alias("n"))
    return d.boxes.select("id").join(inside, "id", "left").select("id", F.coalesce("n", F.lit(0)).alias("prosumers_inside"))


@query("""with b as (select tile, region, min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1 from boxes group by all),
    n as (select b.tile, region, count(pid) as n from b left join points p on x > x0 and x < x1 and y > y0 and y < y1 group by all)
    select tile, max(n) as prosumers_in_tile from n group by tile""")
def join_points_within_tile(d: Domain) -> DataFrame:
    """Prosumers in the bounds of all masks of a tile and region, the most of its regions."""
    bounds = d.boxes.groupBy("tile", "region").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1")).withColumn("id", F.struct("tile", "region"))
    bounds = d.ws.write(bounds, "bounds")
    counts = points_near_boxes(bounds, d.points, 0.0, cell=256.0).groupBy("id").agg(F.count("*").alias("n"))
    return bounds.join(counts, bounds["id"].eqNullSafe(counts["id"]), "left").groupBy("tile").agg(F.coalesce(F.max("n"), F.lit(0)).alias("prosumers_in_tile"))


def _proximity(d: Domain) -> DataFrame:
    return metrics.mask_proximity(d.masks.select("id", EDGES, *BOX.columns()), d.points, SNAP, BUFFER, edges=EDGES)


@query("select b.id, count(pid) filter (distance < 10) as points_inside from boxes b left join nears n on n.id = b.id group by b.id")
def join_proximity_snap(d: Domain) -> DataFrame:
    return _proximity(d).select("id", "points_inside")


@query("select b.id, count(pid) filter (distance < 50) as points_in_buffer, count(pid) filter (distance < 10) > 0 as has_match from boxes b left join nears n on n.id = b.id group by b.id")
def join_proximity_buffer(d: Domain) -> DataFrame:
    return _proximity(d).select("id", "points_in_buffer", "has_match")


def _matched(d: Domain) -> DataFrame:
    return points_near_boxes(d.masks.select("id", EDGES, *BOX.columns()), d.points, SNAP, edges=EDGES)


@query("select pid from points where pid not in (select pid from nears where distance < 10)")
def anti_unmatched_points(d: Domain) -> DataFrame:
    return d.points.join(_matched(d), "pid", "left_anti").select("pid")


@query("select distinct pid from nears where distance < 10")
def semi_matched_points(d: Domain) -> DataFrame:
    return d.points.join(_matched(d), "pid", "left_semi").select("pid")


@query("select distinct tile, pid from insides join firsts using (id)")
def matched_prosumer_ids(d: Domain) -> DataFrame:
    return _inside(d).select("tile", "pid").distinct()


def _overlaps(d: Domain) -> DataFrame:
    """(l_, r_ columns, inter): masks of a tile that overlap, each pair once."""
    masks = d.masks.select("id", "tile", "prompt", "area", EDGES, *BOX.columns())
    pairs = box_pairs(masks, masks, ["tile"], keep=(F.col("l_id") < F.col("r_id")) & (Box("l_").overlap(Box("r_")) > 0))
    return pairs.withColumn("inter", polygons.overlap(F.col("l_edges"), F.col("r_edges"), F.least("l_x0", "r_x0"), F.least("l_y0", "r_y0"))).filter("inter > 1e-6D")


@query(f"""with o as (select a_id as id, b_id as other, inter from commons union all select b_id, a_id, inter from commons)
    select id from boxes where coalesce(prompt, '') not in {NEGATIVE} and id not in (select o.id from o join firsts f on f.id = o.other and f.{_NEG} join boxes b on b.id = o.id where inter > 0.3::double * b.area)""")
def anti_negative_overlap(d: Domain) -> DataFrame:
    """Masks of which no mask with a negative prompt covers more than three tenths."""
    negative = F.col("prompt").isin(*NEGATIVE)
    both = _overlaps(d)
    side = lambda a, b: both.select(F.col(f"{a}_id").alias("id"), F.col(f"{a}_area").alias("area"), F.col(f"{b}_prompt").alias("prompt"), "inter")
    lost = side("l", "r").unionAll(side("r", "l")).filter(negative & (F.col("inter") > 0.3 * F.col("area")))
    return d.boxes.filter(~F.coalesce(negative, F.lit(False))).join(lost, "id", "left_anti").select("id")


@query("select a_id as id_a, b_id as id_b, round(inter, 4) as inter, round(a.area + b.area - inter, 4) as uni from commons join boxes a on a.id = a_id join boxes b on b.id = b_id")
def selfjoin_iou(d: Domain) -> DataFrame:
    return _overlaps(d).select(F.col("l_id").alias("id_a"), F.col("r_id").alias("id_b"), F.round("inter", 4).alias("inter"), F.round(F.col("l_area") + F.col("r_area") - F.col("inter"), 4).alias("uni"))


_PROMPTS = r"(select distinct rtrim(regexp_replace(lower(trim(regexp_replace(prompt, '\s+', ' ', 'g'))), '\.$', '')) as prompt from prompt_targets where prompt is not null)"


@query(f"select tile, y as patch_y, x as patch_x, prompt from grid, unnest(range(0, 4000, 1344)) a(y), unnest(range(0, 4000, 1344)) b(x), {_PROMPTS}")
def cross_patch_prompt(d: Domain) -> DataFrame:
    """Each patch of each tile with each prompt: an explode of the prompts, whose number is checked, and no join."""
    asked = d.table("prompt_targets").select(plain_prompt(F.col("prompt")).alias("p")).filter("p is not null").distinct().limit(1001).collect()
    if len(asked) > 1000:
        raise ValueError("more than 1000 prompts")
    tiles = d.grid.select("tile", F.lit(4000).alias("w"), F.lit(4000).alias("h"))
    grid = patch_grid(tiles, 1408, 64, shifted=False)
    return grid.select("tile", F.col("py").cast("long").alias("patch_y"), F.col("px").cast("long").alias("patch_x"), F.explode(F.array(*[F.lit(r.p) for r in asked])).alias("prompt"))


@query("select fid, model from buildings cross join (values ('clipseg'), ('gdino'), ('langsam'), ('owlv2')) m(model)")
def cross_model_input(d: Domain) -> DataFrame:
    """Every registered model on every building."""
    return d.prosumers.select(F.col("pid").alias("fid"), F.explode(F.array(*map(F.lit, detectors.models()))).alias("model"))


@query("select tile from grid where tile not in (select tile from boxes where region in ('core', 'donut') group by tile having count(distinct region) = 2)")
def semi_anti_tile_status(d: Domain) -> DataFrame:
    """Tiles of which core and donut aren't both there."""
    done = d.detections.filter("edges is not null and region in ('core', 'donut')").groupBy("tile").agg(F.count_distinct("region").alias("n")).filter("n = 2")
    return d.grid.join(done, "tile", "left_anti").select("tile")


@query("""select g.tile, r.raster from grid g join (select raster, 111000 + raster % 40 * 1250::double as x0, 4512000 + raster % 30 * 1300::double as y0, w, h from rasters) r
    on r.x0 <= g.x1 and r.x0 + r.w >= g.x0 and r.y0 <= g.y1 and r.y0 + r.h >= g.y0""")
def join_tile_raster(d: Domain) -> DataFrame:
    k = F.col("raster")
    extents = d.rasters.select(k, (F.lit(111000.0) + k % 40 * 1250).alias("x0"), (F.lit(4512000.0) + k % 30 * 1300).alias("y0"), "w", "h").withColumns({"x1": F.col("x0") + F.col("w"), "y1": F.col("y0") + F.col("h")})
    return box_pairs(d.grid, extents, cell=1000.0).select(F.col("l_tile").alias("tile"), F.col("r_raster").alias("raster"))


@query("select b.id, prompt from boxes b where score > 0.5::double and area between 1 and 50000")
def lookup_prompt_by_geom(d: Domain) -> DataFrame:
    """Kept detections keep their prompt: it travels with the row."""
    return d.detections.filter("score > 0.5D and area between 1 and 50000").select("id", "prompt")


@query("""select prompt, coalesce(case prompt when 'geotiff' then 'image/tiff' when 'jpeg' then 'image/jpeg' when 'png' then 'image/png' end, 'image/tiff') as mime, coalesce(case prompt when 'jpeg' then '.jpg' when 'png' then '.png' end, '.tif') as ext
    from (select lower(replace(split_part(source_file, '.', 2), '.', '')) as prompt from boxes) group by all""")
def lookup_format_mime(d: Domain) -> DataFrame:
    """Image types by file ending; what isn't an image is asked for as TIFF."""
    ending = F.lower(F.get(F.split("source_file", r"\."), F.lit(1)))
    rows = d.detections.filter("edges is not null").select(F.coalesce(ending, F.when(F.col("source_file").isNotNull(), F.lit(""))).alias("prompt")).distinct()
    return rows.select("prompt", mime_type(F.col("prompt")).alias("mime"), extension(mime_type(F.col("prompt"))).alias("ext"))


# --- aggregates -------------------------------------------------------------

def _summary(d: Domain) -> DataFrame:
    """Per-tile summary of detections with a usual area; figures in hundredths, so that sums don't depend on their order."""
    masks = d.detections.filter("area_m2 between 1 and 50000").select(F.col("tile").alias("tile_id"), "area_m2", F.col("shape").alias("geometry"))
    return metrics.tile_summary(masks).withColumn("total_area_m2", F.round("total_area_m2", 2))


@query("select *, round(total_area_m2 / 10000, 6) as total_area_ha from (select tile as tile_id, count(case when geometry like '%(%' then 1 end) as polygon_count, round(sum(area_m2), 2) as total_area_m2 from firsts where area_m2 between 1 and 50000 group by tile)")
def agg_tile_summary(d: Domain) -> DataFrame:
    return _summary(d).withColumn("total_area_ha", F.round(F.col("total_area_m2") / 10000, 6))


@query("""with t as (select tile, round(sum(area_m2), 2) as a, count(case when geometry like '%(%' then 1 end) as n from firsts where area_m2 between 1 and 50000 group by tile)
    select cast(sum(n) as bigint) as polygons, round(sum(a), 2) as area_m2, round(sum(a) / 1000000, 6) as area_km2, count(*) as tiles, round(avg(a), 4) as mean_m2, max(a) as max_m2 from t""")
def agg_global_summary(d: Domain) -> DataFrame:
    whole = metrics.global_summary(_summary(d))
    return whole.select("polygons", F.round("area_m2", 2).alias("area_m2"), F.round("area_km2", 6).alias("area_km2"), "tiles", F.round("mean_m2", 4).alias("mean_m2"), "max_m2")


@query("select tile as tile_id from firsts where area_m2 between 1 and 50000 group by tile order by round(sum(area_m2), 2) desc, tile limit 1")
def agg_argmax_tile(d: Domain) -> DataFrame:
    """The tile with the greatest area, the first by name if several have it."""
    most = _summary(d).groupBy("total_area_m2").agg(F.min("tile_id").alias("tile_id"))
    return most.agg(F.max_by("tile_id", "total_area_m2").alias("tile_id"))


@query("""with m as (select b.id, count(pid) filter (distance < 10) as n from boxes b left join nears using (id) group by b.id),
    u as (select count(*) as fn from points where pid not in (select pid from nears where distance < 10)),
    c as (select count(*) filter (n > 0) as tp, count(*) filter (n = 0) as fp, any_value(fn) as fn from m, u),
    r as (select *, case when tp + fp > 0 then tp / (tp + fp) else 0 end as p, case when tp + fn > 0 then tp / (tp + fn) else 0 end as r from c)
    select tp as true_positives, fp as false_positives, fn as false_negatives, round(p, 3) as precision, round(r, 3) as recall, round(case when p + r > 0 then 2 * p * r / (p + r) else 0 end, 3) as f1,
      (select count(*) from points) - fn as matched_points, fn as unmatched_points from r""")
def agg_confusion_proximity(d: Domain) -> DataFrame:
    return metrics.proximity_summary(d.masks.select("id", EDGES, *BOX.columns()), d.points, snap=SNAP, edges=EDGES)


@query("""with m as (select tile, cast(count(*) as bigint) as masks from boxes group by tile), h as (select tile, count(distinct pid) as matched from insides join firsts using (id) group by tile), p as (select coalesce(tile_id, 'none') as tile, count(*) as total from points group by all),
    c as (select tile, masks, coalesce(matched, 0) as tp, greatest(0, masks - coalesce(matched, 0)) as fp, greatest(0, coalesce(total, 0) - coalesce(matched, 0)) as fn from m left join h using (tile) left join p using (tile)),
    r as (select *, case when tp + fp > 0 then tp / (tp + fp) else 0 end as p, case when tp + fn > 0 then tp / (tp + fn) else 0 end as r from c)
    select tile, tp as true_positives, fp as false_positives, round(p, 3) as precision, round(r, 3) as recall, round(case when p + r > 0 then 2 * p * r / (p + r) else 0 end, 3) as f1 from r""")
def agg_tile_metrics(d: Domain) -> DataFrame:
    """Per tile: prosumers inside its masks, of those registered in it, against its masks."""
    masks = d.boxes.groupBy("tile").agg(F.count("*").alias("masks"))
    matched = _inside(d).groupBy("tile").agg(F.count_distinct("pid").alias("matched"))
    total = d.points.groupBy(F.coalesce("tile_id", F.lit("none")).alias("tile")).agg(F.count("*").alias("total"))
    rows = masks.join(matched, "tile", "left").join(total, "tile", "left").fillna(0, ["matched", "total"])
    return rows.select("tile", *metrics.tile_metrics(F.col("matched"), F.col("total"), F.col("masks")))


@query("select tile, min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1 from boxes group by tile")
def agg_total_bounds(d: Domain) -> DataFrame:
    return d.detections.filter("edges is not null").groupBy("tile").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


@query("""with s as (select g.tile, count(distinct region) filter (region in ('core', 'donut')) as n from grid g left join boxes using (tile) group by g.tile)
    select count(*) filter (n = 2) as done, count(*) filter (n = 1) as partly, count(*) filter (n = 0) as pending from s""")
def agg_status_counts(d: Domain) -> DataFrame:
    """Tiles with the results of both regions, of one and of none."""
    regions = d.detections.filter("edges is not null and region in ('core', 'donut')").groupBy("tile").agg(F.count_distinct("region").alias("n"))
    status = d.grid.join(regions, "tile", "left").select(F.coalesce("n", F.lit(0)).alias("n"))
    return status.agg(*[F.count_if(F.col("n") == n).alias(name) for n, name in ((2, "done"), (1, "partly"), (0, "pending"))])


@query("""select tile, count(*) as total_raw, count(*) filter (area between 1 and 50) as after_area, count(*) filter (area between 1 and 50 and score > 0.5::double) as final from boxes group by tile""")
def agg_detection_stats(d: Domain) -> DataFrame:
    fits = F.col("area").between(1, 50)
    return d.detections.filter("edges is not null").groupBy("tile").agg(F.count("*").alias("total_raw"), F.count_if(fits).alias("after_area"), F.count_if(fits & (F.col("score") > 0.5)).alias("final"))


@query(f"select round(sum(area), 3) as total_area_m2 from boxes where score > 0.5::double and coalesce(prompt, '') not in {NEGATIVE}")
def agg_total_pv_area(d: Domain) -> DataFrame:
    kept = d.detections.filter("score > 0.5D").filter(~F.coalesce(F.col("prompt").isin(*NEGATIVE), F.lit(False)))
    return kept.agg(F.round(F.sum("area"), 3).alias("total_area_m2"))


@query(NEAR_BOX.format(d=0) + "select (select count(distinct id) from hits) as touching, (select count(*) from boxes) as total")
def agg_intersect_count(d: Domain) -> DataFrame:
    touching = buildings_of(d, 0.0).select("id").distinct()
    rows = touching.select(F.lit(True).alias("hit")).unionAll(d.boxes.select(F.lit(False).alias("hit")))
    return rows.agg(F.count_if("hit").alias("touching"), F.count_if(~F.col("hit")).alias("total"))


@query("""select module as model, cast(count(*) filter (json_valid(payload)) as varchar) as detections, count(*) filter (not coalesce(json_valid(payload), false)) as errors, count(distinct export_id) as runs
    from (select distinct export_id, rec_no, module, payload from model_exports) group by module""")
def agg_model_table(d: Domain) -> DataFrame:
    """Runs, detections and unreadable records of each model."""
    rows = d.table("model_exports").select("export_id", "rec_no", "module", "payload").distinct()
    whole = F.rtrim(F.col("payload")).endswith("}") & F.try_parse_json("payload").isNotNull()
    good = F.coalesce(whole, F.lit(False))
    return rows.groupBy(F.col("module").alias("model")).agg(F.count_if(good).cast("string").alias("detections"), F.count_if(~good).alias("errors"), F.count_distinct("export_id").alias("runs"))


# --- windows, sorts, limits ---------------------------------------------------


@query("""select b.id, cast(sum(n) over (partition by tile order by region nulls first, b.id rows unbounded preceding) as bigint) as matched_prosumers
    from (select b.id, tile, region, count(pid) as n from boxes b left join insides i on i.id = b.id group by all) b""")
def win_cumsum(d: Domain) -> DataFrame:
    """Prosumers inside masks, summed up in the order of the tile's rows; a hot tile is summed up by many tasks."""
    inside = _inside(d).groupBy("id").agg(F.count("*").alias("n"))
    rows = d.boxes.select("id", "tile", "region").join(inside, "id", "left").select("id", "tile", "region", F.coalesce("n", F.lit(0)).alias("n"))
    return running_sums(d.ws, rows, ["tile"], ["region", "id"], "n", "cumsum").select("id", F.col("running").alias("matched_prosumers"))


def _numbered(d: Domain, rows: DataFrame, group: list[str], order: list, name: str) -> DataFrame:
    """Rows with `no`, their place from 0 in their group; places are running sums of ones, so no group is sorted by one task."""
    placed = running_sums(d.ws, rows.withColumn("one", F.lit(1)), group, order, "one", name)
    return placed.select(*rows.columns, (F.col("running") - 1).cast("int").alias("no"), F.col("total"))


@query("select id, cast(row_number() over (partition by tile, region order by score desc nulls last, id) - 1 as int) as detection_id from boxes")
def win_row_number(d: Domain) -> DataFrame:
    rows = d.detections.filter("edges is not null").select("id", "tile", "region", "score")
    return _numbered(d, rows, ["tile", "region"], [F.desc("score"), "id"], "numbers").select("id", F.col("no").alias("detection_id"))


@query("select tile as tile_id, round(sum(area_m2), 2) as total_area_m2 from firsts where area_m2 between 1 and 50000 group by tile order by total_area_m2 desc, tile_id limit 5")
def topk_tiles(d: Domain) -> DataFrame:
    return _summary(d).orderBy(F.desc("total_area_m2"), "tile_id").limit(5).select("tile_id", "total_area_m2")


def _by_score(d: Domain) -> DataFrame:
    rows = d.detections.filter("edges is not null").select("id", "score")
    return _numbered(d, rows, [], [F.desc("score"), "id"], "places").select("id", "score", (F.col("no") + 1).cast("long").alias("place")).orderBy("place")


@query("select id, score, row_number() over (order by score desc nulls last, id) as place from boxes")
def sort_score(d: Domain) -> DataFrame:
    """The whole sort; ids are unique, so a place is the number of rows up to it."""
    return _by_score(d)


@query("select id, score, row_number() over (order by score desc nulls last, id) as place from boxes")
def sort_score_np(d: Domain) -> DataFrame:
    """The sort whose ties numpy leaves open; here the id decides, so it is the same sort."""
    return _by_score(d)


@query("select tile || '_core' as file from grid")
def sort_files(d: Domain) -> DataFrame:
    return d.grid.select(F.concat("tile", F.lit("_core")).alias("file")).orderBy("file")


@query("select id from boxes order by id limit 20")
def limit_n(d: Domain) -> DataFrame:
    return d.detections.filter("edges is not null").select("id").orderBy("id").limit(20)


# --- set operations -----------------------------------------------------------


@query("select id, region, prompt from boxes where region = 'core' union all select id, region, null from boxes where region = 'donut'")
def union_all_regions(d: Domain) -> DataFrame:
    core = d.boxes.filter("region = 'core'").select("id", "region", "prompt")
    return core.unionByName(d.boxes.filter("region = 'donut'").select("id", "region"), allowMissingColumns=True)


@query("select tile, id from boxes")
def union_features(d: Domain) -> DataFrame:
    """Two parts that hold all tiles together."""
    return d.boxes.filter("tile < '31TAF25'").select("tile", "id").unionByName(d.boxes.filter("tile >= '31TAF25'").select("tile", "id"))


@query("select pid from points except select pid from insides")
def except_unmatched(d: Domain) -> DataFrame:
    return d.points.select("pid").subtract(_inside(d).select("pid"))


@query("select distinct pid from insides join firsts using (id) where region in ('core', 'donut')")
def union_distinct_matched(d: Domain) -> DataFrame:
    hits = d.ws.write(_inside(d).select("region", "pid"), "hits")
    matched = lambda region: hits.filter(F.col("region") == region).select("pid")
    return matched("core").union(matched("donut")).distinct()


@query(f"""with f as (select tile, id, case when {_NEG} then 'negative_mask' else 'pv' end as type from boxes)
    select id, type, cast(row_number() over (partition by tile order by type desc, id) - 1 as int) as feature_no from f""")
def union_pv_negative(d: Domain) -> DataFrame:
    """Negatives are numbered after the kept ones of their tile."""
    negative = F.coalesce(F.col("prompt").isin(*NEGATIVE), F.lit(False))
    numbered = lambda rows, name: _numbered(d, rows.select("tile", "id"), ["tile"], ["id"], name)
    pv = numbered(d.boxes.filter(~negative), "pv").withColumn("type", F.lit("pv"))
    counts = pv.groupBy("tile").agg(F.max("total").alias("pv"))
    moved = numbered(d.boxes.filter(negative), "negative").join(counts, "tile", "left").withColumn("no", (F.col("no") + F.coalesce("pv", F.lit(0))).cast("int")).withColumn("type", F.lit("negative_mask"))
    return pv.select("id", "type", F.col("no").alias("feature_no")).unionByName(moved.select("id", "type", F.col("no").alias("feature_no")))


@query("select fid, model from buildings cross join (values ('clipseg'), ('gdino'), ('langsam')) m(model)")
def skip_list(d: Domain) -> DataFrame:
    return cross_model_input(d).filter(~F.col("model").isin("owlv2"))


# --- scalar functions ---------------------------------------------------------


@query(r"""select p_partkey as k, replace(p_brand, '#', '_') as stem, contains(p_name, 'ring') as has_ring, string_split(p_name, ' ')[1] as head, list_transform(string_split(p_name || ', ' || p_brand, ','), lambda x: trim(x)) as parts,
    lower(p_type) as low, printf('%04d', p_partkey) as padded, printf('%.2f', p_retailprice) as price, ends_with(p_name, 'g') as ends, regexp_extract(p_brand, '#(\d+)', 1) as num from part""")
def fn_string(d: Domain) -> DataFrame:
    name, brand = F.col("p_name"), F.col("p_brand")
    return d.table("part").select(
        F.col("p_partkey").alias("k"),
        F.replace(brand, F.lit("#"), F.lit("_")).alias("stem"),
        F.contains(name, F.lit("ring")).alias("has_ring"),
        F.split(name, " ", 2)[0].alias("head"),
        F.transform(F.split(F.concat(name, F.lit(", "), brand), ","), lambda x: F.trim(x)).alias("parts"),
        F.lower("p_type").alias("low"),
        F.format_string("%04d", "p_partkey").alias("padded"),
        F.format_string("%.2f", "p_retailprice").alias("price"),
        F.endswith(name, F.lit("g")).alias("ends"),
        F.regexp_extract(brand, r"#(\d+)", 1).alias("num"),
    )


@query("""select event_id as pid, round(1 / (1 + exp(-value / 100)), 9) as sigmoid, round(sqrt(pow(sin(value), 2) + pow(cos(value), 2)) + tan(radians(value)), 6) as trig, abs(value - 50) as dev, least(100, greatest(0, value)) as clamped from events""")
def fn_math(d: Domain) -> DataFrame:
    v = F.col("value")
    return d.table("events").select(F.col("event_id").alias("pid"), F.round(1 / (1 + F.exp(-v / 100)), 9).alias("sigmoid"), F.round(F.sqrt(F.pow(F.sin(v), F.lit(2)) + F.pow(F.cos(v), F.lit(2))) + F.tan(F.radians(v)), 6).alias("trig"), F.abs(v - 50).alias("dev"), F.least(F.lit(100.0), F.greatest(F.lit(0.0), v)).alias("clamped"))


@query("""select vec_id, list_max(embedding) as hi, list_min(embedding) as lo, len(embedding) as n, list_transform(list_zip(embedding[1:4], embedding[5:8]), lambda x: greatest(x[1], x[2])) as both from embeddings""")
def fn_array(d: Domain) -> DataFrame:
    e = F.col("embedding")
    return d.table("embeddings").select("vec_id", F.array_max(e).alias("hi"), F.array_min(e).alias("lo"), F.size(e).cast("long").alias("n"), F.zip_with(F.slice(e, 1, 4), F.slice(e, 5, 4), lambda a, b: F.greatest(a, b)).alias("both"))


@query("select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, '{\"k\":' || json_extract_string(props, '$.k') || '}' as back from events")
def fn_json(d: Domain) -> DataFrame:
    parsed = d.table("events").select("event_id", F.from_json("props", "k bigint").alias("p"))
    return parsed.select("event_id", F.col("p.k").alias("k"), F.to_json("p").alias("back"))


@query("select tile, x0, y1 from grid where geom_type = 'MultiPolygon'")
def fn_xml(d: Domain) -> DataFrame:
    """Names and bounds out of layers in a namespace, where they have a box."""
    box = F.when(F.col("geom_type") == "MultiPolygon", F.format_string('<w:BoundingBox minx="%.1f" maxy="%.1f"/>', "x0", "y1")).otherwise("")
    document = F.concat(F.lit('<w:Layer xmlns:w="http://www.opengis.net/wms"><w:Name>'), "tile", F.lit("</w:Name>"), box, F.lit("</w:Layer>"))
    at = lambda path: F.xpath_string(F.col("x"), F.lit(path))
    layer = "*[local-name()='Layer']/*[local-name()='{}']"
    read = d.grid.select(document.alias("x")).select(at(layer.format("Name")).alias("tile"), at(layer.format("BoundingBox") + "/@minx").try_cast("double").alias("x0"), at(layer.format("BoundingBox") + "/@maxy").try_cast("double").alias("y1"))
    return read.filter("x0 is not null")


@query("""select file_id, case when body is null then 'unknown' when body like '%ServiceException%' then 'WMS Error' else 'unknown' end as format, coalesce(octet_length(encode(body)), 0) as size_bytes, false as valid from mask_files""")
def fn_magic_bytes(d: Domain) -> DataFrame:
    """Bodies of files, none of which is an image, by their first bytes; images are judged in the tests."""
    files = d.table("mask_files").select("file_id", F.coalesce(F.encode("body", "UTF-8"), F.lit(b"")).alias("content"))
    kind = sniff(F.col("content"))
    return files.select("file_id", kind.alias("format"), F.octet_length("content").cast("long").alias("size_bytes"), kind.isin("JPEG", "GeoTIFF", "PNG").alias("valid"))


@query("select raster, coalesce(nullif(size % 3, 0), 10) as param, coalesce(map {'a': 1, 'b': 2}[case when raster % 3 = 0 then 'a' when raster % 3 = 1 then 'b' else 'c' end], 0) as looked from rasters")
def fn_defaults(d: Domain) -> DataFrame:
    key = F.element_at(F.array(*map(F.lit, "abc")), (F.col("raster") % 3 + 1).cast("int"))
    table = F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2))
    return d.rasters.select("raster", F.coalesce(F.nullif(F.col("size") % 3, F.lit(0)), F.lit(10)).alias("param"), F.coalesce(table[key], F.lit(0)).alias("looked"))


@query("select coalesce(coord_10k, '') as parent, string_agg(tile, chr(10) order by tile) as ids from grid group by all")
def fn_join_lines(d: Domain) -> DataFrame:
    """The tiles of each 10 km square, a hundred at most, one per line; those without a square together."""
    return d.grid.groupBy(F.coalesce("coord_10k", F.lit("")).alias("parent")).agg(F.array_join(F.array_sort(F.collect_list("tile")), "\n").alias("ids"))


@query("select day, count(*) as n, cast(max(dayofweek(day)) as int) as weekday, cast(max(datediff('day', date '2025-01-01', day)) as int) as since from firsts where day is not null group by day")
def fn_date(d: Domain) -> DataFrame:
    """Detections by day, with its place in the week (Sunday is 0) and the days since the year began."""
    rows = d.detections.filter("day is not null").groupBy("day").agg(F.count("*").alias("n"))
    return rows.select("day", "n", (F.dayofweek("day") - 1).alias("weekday"), F.date_diff("day", F.lit("2025-01-01").cast("date")).alias("since"))
