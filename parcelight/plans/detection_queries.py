"""Queries of detection: patches, rasters, suppression, merging and pipelines."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.functions.boxes import Box, repaired
from parcelight.operators import patches, raster, suppress
from parcelight.plans import detectors, flow, pipelines
from parcelight.plans.domain import NEGATIVE, Domain, Registry
from parcelight.plans.vector_queries import NEAR_BOX
from parcelight.runtime import ship
from parcelight.sources import config, geojson

query = Registry()
queries, oracle_sql = query.runs.copy, query.sql.copy
LIMITS = pipelines.Limits(min_area=1.0, max_area=500.0, max_aspect=2.500001, max_occupancy=0.0001, tile_area=1_000_000.0)

# --- patches ------------------------------------------------------------------


@query("""select raster, cast(yi * ceil(w / 128.0) + xi as int) as patch_no, cast(greatest(0, least(x + 192, w) - 192) as int) as px, cast(greatest(0, least(y + 192, h) - 192) as int) as py,
    cast(least(x + 192, w) - greatest(0, least(x + 192, w) - 192) as int) as pw, cast(least(y + 192, h) - greatest(0, least(y + 192, h) - 192) as int) as ph
    from (select *, xi * 128 as x, yi * 128 as y from rasters, unnest(range(0, cast(ceil(w / 128.0) as int))) a(xi), unnest(range(0, cast(ceil(h / 128.0) as int))) b(yi))""")
def patch_grid_shifted(d: Domain) -> DataFrame:
    return patches.patch_grid(d.rasters, 192, 64).select("raster", "patch_no", "px", "py", "pw", "ph")


_CLIPPED = """select raster, cast(yi * ceil(w / 240.0) + xi as int) as patch_no, cast(x as int) as px, cast(y as int) as py, cast(least(x + 288, w) - x as int) as pw, cast(least(y + 288, h) - y as int) as ph
    from (select *, xi * 240 as x, yi * 240 as y from rasters, unnest(range(0, cast(ceil(w / 240.0) as int))) a(xi), unnest(range(0, cast(ceil(h / 240.0) as int))) b(yi)) where least(w - x, h - y) >= {least}"""


@query(_CLIPPED.format(least=32))
def patch_grid_clipped(d: Domain) -> DataFrame:
    return patches.patch_grid(d.rasters, 288, 48, shifted=False, least=32).select("raster", "patch_no", "px", "py", "pw", "ph")


@query(_CLIPPED.format(least=64))
def filter_patch_min(d: Domain) -> DataFrame:
    return patches.patch_grid(d.rasters, 288, 48, shifted=False, least=32).filter("pw >= 64 and ph >= 64").select("raster", "patch_no", "px", "py", "pw", "ph")


@query("select raster, count(*) as patches from (select raster from rasters where w <= 512 and h <= 512 union all select raster from rasters, unnest(range(0, w, 448)) a(x), unnest(range(0, h, 448)) b(y) where not (w <= 512 and h <= 512)) group by raster")
def patch_bypass(d: Domain) -> DataFrame:
    return patches.tiled(d.rasters, 512, 64).groupBy("raster").agg(F.count("*").alias("patches"))


@query("""select tile, 'core' as region, x0, y0, x1, y1, (x1 - x0) * (y1 - y0) as area from grid union all
    select tile, 'donut', x0 - 250, y0 - 250, x1 + 250, y1 + 250, (x1 - x0 + 500) * (y1 - y0 + 500) - (x1 - x0) * (y1 - y0) from grid""")
def donut_gen(d: Domain) -> DataFrame:
    return patches.with_donuts(d.grid).select("tile", "region", "x0", "y0", "x1", "y1", "area")


# --- rasters --------------------------------------------------------------------


@query("select raster, count(*) filter (v > 500) as n, count(*) as total from pixels group by raster")
def agg_mask_pixels(d: Domain) -> DataFrame:
    return d.pixels.groupBy("raster").agg(F.count_if(F.col("v") > 500).alias("n"), F.count("*").alias("total"))


@query("select raster, avg(case when alpha > 10 then 1.0::double else 0 end) as share from pixels group by raster")
def agg_data_fraction(d: Domain) -> DataFrame:
    return d.pixels.groupBy("raster").agg(F.avg((F.col("alpha") > 10).cast("double")).alias("share"))


@query("select raster from pixels group by raster having avg(case when alpha > 15 then 1.0::double else 0 end) >= 0.5")
def filter_nodata(d: Domain) -> DataFrame:
    return d.pixels.groupBy("raster").agg(F.avg((F.col("alpha") > 15).cast("double")).alias("share")).filter("share >= 0.5").select("raster")


@query("select l_orderkey // 64 as raster, cast(l_partkey % 64 as int) as px, cast(max(l_linenumber % 2) as int) as bit from lineitem group by all")
def agg_mask_or(d: Domain) -> DataFrame:
    return d.table("lineitem").groupBy(F.floor(F.col("l_orderkey") / 64).alias("raster"), (F.col("l_partkey") % 64).cast("int").alias("px")).agg(F.bit_or(F.col("l_linenumber") % 2).alias("bit"))


@query("select raster, max(v) as most from pixels group by raster")
def agg_raster_max(d: Domain) -> DataFrame:
    return d.pixels.groupBy("raster").agg(F.max("v").alias("most"))


@query("select raster, r, c, case when max(v) over (partition by raster) > 255 then cast(trunc(v::double / max(v) over (partition by raster) * 255) as int) else v end as u8 from pixels")
def raster_scale_u8(d: Domain) -> DataFrame:
    return d.pixels.select("raster", "r", "c", raster.scaled_u8(F.col("v"), ["raster"]).alias("u8"))


@query("""select raster, r, c, case when exists (select 1 from plots b where b.fid = raster % 100 and c * 2.0::double + 1 >= b.x0 and c * 2.0::double + 1 < b.x1 and r * 2.0::double + 1 >= b.y0 and r * 2.0::double + 1 < b.y1) then v else 0 end as v from pixels""")
def raster_apply_mask(d: Domain) -> DataFrame:
    cells = raster.rasterized(d.plots.withColumn("id", F.col("fid")), 8, 8, 2.0).withColumn("on", F.lit(True))
    met = d.pixels.withColumn("id", F.col("raster") % 100).join(cells, ["id", "r", "c"], "left")
    return met.select("raster", "r", "c", F.when(F.col("on"), F.col("v")).otherwise(0).alias("v"))


@query("""select fid as id, cast(r as int) as r, cast(c as int) as c from plots, unnest(range(0, 16)) a(r), unnest(range(0, 16)) b(c) where c * 1.5::double + 0.75::double >= x0 and c * 1.5::double + 0.75::double < x1 and r * 1.5::double + 0.75::double >= y0 and r * 1.5::double + 0.75::double < y1""")
def raster_rasterize(d: Domain) -> DataFrame:
    return raster.rasterized(d.plots.withColumn("id", F.col("fid")), 16, 16, 1.5)


@query("select tile, (x1 - x0) / 4000 as a, x0 as c, -(y1 - y0) / 4000 as e, y1 as f from grid")
def raster_from_bounds(d: Domain) -> DataFrame:
    return d.grid.select("tile", ((F.col("x1") - F.col("x0")) / 4000).alias("a"), F.col("x0").alias("c"), (-(F.col("y1") - F.col("y0")) / 4000).alias("e"), F.col("y1").alias("f"))


_LABELS = """with recursive m as (select raster, r, c from pixels where v > 300), e as (
      select a.raster, a.r * 8 + a.c as u, b.r * 8 + b.c as w from m a join m b on a.raster = b.raster and abs(a.r - b.r) + abs(a.c - b.c) <= 1
    ), l(raster, id, seen) using key (raster, id) as (
      select raster, u, min(w) from e group by raster, u union
      select e.raster, e.w, min(l.seen) from l join e on e.raster = l.raster and e.u = l.id join recurring.l as o on o.raster = e.raster and o.id = e.w where l.seen < o.seen group by e.raster, e.w
    ), b as (select raster, seen, min(id % 8) as x0, min(id // 8) as y0, max(id % 8) + 1 as x1, max(id // 8) + 1 as y1, count(*) as px from l group by all)
    select raster, cast(x0 as int) as x0, cast(y0 as int) as y0, cast(x1 as int) as x1, cast(y1 as int) as y1, cast(px as int) as px from b where px >= {least}"""


def _blobs(d: Domain, least: int) -> DataFrame:
    ship(d.spark)
    return raster.vectorized(d.pixels.filter("v > 300"), 8, 8, least).select("raster", "x0", "y0", "x1", "y1", "px")


@query(_LABELS.format(least=1))
def raster_vectorize(d: Domain) -> DataFrame:
    return _blobs(d, 1)


@query(_LABELS.format(least=5))
def filter_mask_min(d: Domain) -> DataFrame:
    return _blobs(d, 5)


@query("""select raster, count(*) as n, cast(sum(v) as bigint) as total from pixels join plots on fid = raster % 100
    where c * 2 + 1 > x0 and c * 2 + 1 < x1 and 16 - r * 2 - 1 > y0 and 16 - r * 2 - 1 < y1 and v > 0 group by raster""")
def raster_clip(d: Domain) -> DataFrame:
    """Rasters of 2 m pixels, clipped by the outline of a building; what misses it is dropped."""
    ship(d.spark)
    chips = detectors.chips(d.pixels, 8, 8).join(d.plots, F.col("raster") % 100 == F.col("fid"))

    def clip(row: dict) -> list[tuple]:
        image = np.frombuffer(row["data"], "<i4").reshape(1, row["height"], row["width"])
        x0, y0, x1, y1 = (row[k] for k in ("x0", "y0", "x1", "y1"))
        found = raster.clipped(image, (2.0, 0.0, 0.0, 0.0, -2.0, 16.0), [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)])
        return [(row["raster"], int(np.count_nonzero(found[0])), int(found[0].sum()))] if found is not None and found[0].any() else []

    return raster.map_chips(chips, clip, "raster long, n long, total long")


@query()
def raster_resize(d: Domain) -> DataFrame:
    """Rasters resampled to half and double their sides; the mean stays about the same."""
    ship(d.spark)

    def resize(row: dict) -> list[tuple]:
        image = np.frombuffer(row["data"], "<i4").reshape(1, row["height"], row["width"])
        half, double = raster.resized(image, row["height"] // 2, row["width"] // 2), raster.resized(image, row["height"] * 2, row["width"] * 2)
        return [(row["raster"], int(half.size), int(double.size), round(float(double.mean()), 3))]

    return raster.map_chips(detectors.chips(d.pixels, 8, 8), resize, "raster long, half long, double long, mean double")


@query("select id, x0, y0, x1, y1 from boxes where area >= 2")
def geom_make_valid(d: Domain) -> DataFrame:
    """Boxes whose corners were written in the wrong order or that collapsed: put in order, or dropped."""
    turned, flat = F.col("id") % 3 == 0, F.col("area") < 2
    broken = d.boxes.select("id", F.when(turned, F.col("x1")).otherwise(F.col("x0")).alias("x0"), "y0", F.when(turned, F.col("x0")).when(flat, F.col("x0")).otherwise(F.col("x1")).alias("x1"), F.when(flat, F.col("y0")).otherwise(F.col("y1")).alias("y1"))
    return repaired(broken)


# --- suppression ------------------------------------------------------------------

_STRUCT = "STRUCT(id BIGINT, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE)[]"


def _box_nms_sql(source: str, name: str, iou: float) -> str:
    """A common table expression: greedy suppression of boxes in lists per tile."""
    inter = "greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0))"
    area = lambda k: f"({k}.x1 - {k}.x0) * ({k}.y1 - {k}.y0)"
    above = f"{inter} > {iou}::double * ({area('a')} + {area('b')} - {inter})"
    return f"""{name}_l as (select list({{'id': id, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}} order by score desc nulls last, id) as l from {source} group by tile),
      {name}_k as (select list_reduce(l, lambda kept, b: case when len(list_filter(kept, lambda a: {above})) > 0 then kept else list_append(kept, b) end, []::{_STRUCT}) as l from {name}_l),
      {name} as (select * from {source} where id in (select u.id from (select unnest(l) as u from {name}_k)))"""


def _nms_sql(source: str, name: str, iou: float, guard: bool = False) -> str:
    """A common table expression: greedy suppression of polygons in lists per tile, each with those above it that it overlaps too much."""
    first = "coalesce(a.score, -1) > coalesce(b.score, -1) or (coalesce(a.score, -1) = coalesce(b.score, -1) and a.id < b.id)"
    return f"""{name}_o as (select case when {first} then a.id else b.id end as w, case when {first} then b.id else a.id end as l from commons join boxes a on a.id = a_id join boxes b on b.id = b_id where inter > {iou}::double * (a.area + b.area - inter)),
      {name}_h as (select l as id, list(w) as ws from {name}_o {"where w < l" if guard else ""} group by l),
      {name}_l as (select list({{'id': id, 'ws': coalesce(ws, [])}} order by score desc nulls last, id) as l from {source} left join {name}_h using (id) group by tile),
      {name}_k as (select list_reduce(l, lambda kept, b: case when list_has_any(kept, b.ws) then kept else list_append(kept, b.id) end, []::BIGINT[]) as l from {name}_l),
      {name} as (select * from {source} where id in (select unnest(l) from {name}_k))"""


def _sql(*steps: str, select: str = "select id from last") -> str:
    return f"with {', '.join(steps)} {select}"


def _where(source: str, name: str, condition: str) -> str:
    return f"{name} as (select * from {source} where {condition})"


_AREA = "area between 1 and 500"
_ASPECT = "greatest(x1 - x0, y1 - y0) / least(x1 - x0, y1 - y0) <= 2.500001::double"
_OCCUPANCY = "area <= 100"
_HITS = NEAR_BOX.removeprefix("with ").strip()


@query(_sql(_nms_sql("boxes", "last", 0.5)))
def nms_polygon(d: Domain) -> DataFrame:
    return suppress.nms(d.ws, d.masks, 0.5, ["tile"], edges="edges").select("id")


@query(_sql(_nms_sql("boxes", "last", 0.5, guard=True)))
def nms_polygon_index_guard(d: Domain) -> DataFrame:
    return suppress.nms(d.ws, d.masks, 0.5, ["tile"], mode="index_guard", edges="edges").select("id")


@query(_sql(_box_nms_sql("boxes", "last", 0.3)))
def nms_box(d: Domain) -> DataFrame:
    return suppress.nms(d.ws, d.boxes, 0.3, ["tile"]).select("id")


@query(_sql("moved as (select * replace (x0 + id % 3 as x0, x1 + id % 3 as x1, y0 + id % 2 as y0, y1 + id % 2 as y1) from boxes)", _box_nms_sql("moved", "last", 0.2)))
def nms_merge_patches(d: Domain) -> DataFrame:
    dx, dy = F.col("id") % 3, F.col("id") % 2
    moved = d.boxes.withColumns({"x0": F.col("x0") + dx, "x1": F.col("x1") + dx, "y0": F.col("y0") + dy, "y1": F.col("y1") + dy})
    return suppress.nms(d.ws, moved, 0.2, ["tile"]).select("id")


@query(_sql(_nms_sql("boxes", "one", 0.5), _where("one", "two", _AREA), _nms_sql("two", "last", 0.1)))
def nms_post_filter(d: Domain) -> DataFrame:
    once = suppress.nms(d.ws, d.masks, 0.5, ["tile"], name="one", edges="edges")
    return suppress.nms(d.ws, pipelines.by_area(once, LIMITS), 0.1, ["tile"], name="two", edges="edges").select("id")


# --- merging ------------------------------------------------------------------------

#: k: the polygons; e: those that meet, or of which a corner of one is near enough to a side of the other.
_MERGED = """with recursive k as ({source}), m as (select a.id as u, b.id as w from k a join k b on a.tile = b.tile and a.id < b.id and a.x0 <= b.x1 + {reach} and b.x0 <= a.x1 + {reach} and a.y0 <= b.y1 + {reach} and b.y0 <= a.y1 + {reach}
    ), p as (select m.*, e.ax as ax, e.ay as ay, e.bx as bx, e.b_y as b_y, f.ax as cx, f.ay as cy, f.bx as dx, f.b_y as dy from m join edges e on e.id = u join edges f on f.id = w
    ), o as (select *, greatest(0, least(1, ((cx - ax) * (bx - ax) + (cy - ay) * (b_y - ay)) / (pow(bx - ax, 2) + pow(b_y - ay, 2)))) as t, greatest(0, least(1, ((ax - cx) * (dx - cx) + (ay - cy) * (dy - cy)) / (pow(dx - cx, 2) + pow(dy - cy, 2)))) as v,
        (bx - ax) * (cy - ay) - (b_y - ay) * (cx - ax) as s1, (bx - ax) * (dy - ay) - (b_y - ay) * (dx - ax) as s2, (dx - cx) * (ay - cy) - (dy - cy) * (ax - cx) as s3, (dx - cx) * (b_y - cy) - (dy - cy) * (bx - cx) as s4 from p
    ), n as (select u, w from o group by u, w having bool_or(s1 * s2 < 0 and s3 * s4 < 0) or least(min(sqrt(pow(cx - ax - t * (bx - ax), 2) + pow(cy - ay - t * (b_y - ay), 2))), min(sqrt(pow(ax - cx - v * (dx - cx), 2) + pow(ay - cy - v * (dy - cy), 2)))) <= {reach}
      union select a_id, b_id from commons where a_id in (select id from k) and b_id in (select id from k)
    ), e as (select u, w from n union all select w, u from n union all select id, id from k
    ), l(id, seen) using key (id) as (
      select u, min(w) from e group by u union
      select e.w, min(l.seen) from l join e on e.u = l.id join recurring.l as o on o.id = e.w where l.seen < o.seen group by e.w
    )"""


@query(_MERGED.format(source="select * from boxes", reach="0.500001::double") + " select id, seen as blob_id from l")
def agg_union_dissolve(d: Domain) -> DataFrame:
    """Components of polygons at most two buffers apart, buffer = half the distance of 0.5 m."""
    return suppress.dissolved(d.ws, d.masks, 0.2500005, ["tile"], "edges").select("id", "blob_id")


@query(_MERGED.format(source="select * from boxes", reach="1.000001::double") + " select id, seen as blob_id from l")
def agg_union_dissolve_full(d: Domain) -> DataFrame:
    """The same with the whole distance as buffer, which joins gaps of twice the distance."""
    return suppress.dissolved(d.ws, d.masks, 0.5000005, ["tile"], "edges").select("id", "blob_id")


def _blobs_of(d: Domain, least: float | None = None) -> DataFrame:
    boxes = d.boxes.filter("area < 500")
    return suppress.blobs(suppress.dissolved(d.ws, boxes, 0.25, ["tile"]), 0.25, ["tile"], min_area=least)


@query()
def agg_dissolve_area(d: Domain) -> DataFrame:
    """Blobs of the bounds with the area of their dilated union, rounded."""
    return _blobs_of(d).select("tile", "blob_id", "n", F.round("area", 3).alias("area"), "score")


@query()
def filter_merged_min(d: Domain) -> DataFrame:
    return _blobs_of(d, 4.0).select("tile", "blob_id", F.round("area", 3).alias("area"))


# --- pipelines ------------------------------------------------------------------------


@query(_sql(_nms_sql("boxes", "one", 0.3), _where("one", "two", f"{_AREA} and {_ASPECT} and {_OCCUPANCY}"), _nms_sql("two", "last", 0.3)))
def pipeline_langsam_tile(d: Domain) -> DataFrame:
    return pipelines.langsam_tile(d.ws, d.masks, LIMITS, ["tile"]).select("id")


@query(_MERGED.format(source=f"select * from boxes where {_AREA} and {_ASPECT}", reach="1.000001::double") + " select id, seen as blob_id from l")
def pipeline_langsam_file(d: Domain) -> DataFrame:
    return pipelines.langsam_file(d.ws, d.masks, replace(LIMITS, merge_m=1.000001), ["tile"]).select("id", "blob_id")


@query(_sql(_nms_sql("boxes", "one", 0.3), _where("one", "last", f"{_AREA} and {_ASPECT} and {_OCCUPANCY}")))
def pipeline_owlv2_clipseg(d: Domain) -> DataFrame:
    return pipelines.owlv2(d.ws, d.masks, LIMITS, ["tile"]).select("id")


@query(_sql(_HITS.format(d=2), _nms_sql("boxes", "one", 0.3), _where("one", "last", f"{_AREA} and {_ASPECT} and id in (select id from hits)")))
def pipeline_phase2(d: Domain) -> DataFrame:
    return pipelines.phase2(d.ws, d.masks, d.buildings, LIMITS, ["tile"]).select("id")


@query(f"""with {_HITS.format(d=0)}, both_ways as (select a_id as id, b_id as other, inter from commons union all select b_id, a_id, inter from commons)
    select id, case when id not in (select id from hits) then 'outside' when id in (select o.id from both_ways o join firsts f on f.id = o.other and f.prompt in {NEGATIVE} join boxes b on b.id = o.id where inter > 0.3::double * b.area) then 'negative' else 'kept' end as fate
    from boxes where coalesce(prompt, '') not in {NEGATIVE}""")
def pipeline_phase3(d: Domain) -> DataFrame:
    negative = F.coalesce(F.col("prompt").isin(*NEGATIVE), F.lit(False))
    return pipelines.phase3(d.outlines.filter(~negative), d.outlines.filter(negative), d.buildings, ["tile"]).select("id", "fate")


@query(_sql(_HITS.format(d=0), _where("boxes", "two", "id in (select id from hits) and area between 0.5 and 2000"), _nms_sql("two", "last", 0.5)))
def pipeline_phase4(d: Domain) -> DataFrame:
    return pipelines.phase4(d.ws, d.masks.select("id", "tile", "score", "x0", "y0", "x1", "y1", "area", "edges"), d.buildings, ["tile"]).select("id")


# --- detectors --------------------------------------------------------------------------


def _detected(d: Domain, model: str) -> DataFrame:
    ship(d.spark)
    chips = detectors.chips(d.pixels, 8, 8)
    return detectors.detect(chips, model, ["dark roof panel."]).select("raster", "prompt", "x0", "y0", "x1", "y1", "score", "error")


for _model in ("langsam", "gdino", "owlv2", "clipseg"):
    query(name=f"udf_{_model}")(lambda d, m=_model: _detected(d, m))


@query()
def plugin_registry(d: Domain) -> DataFrame:
    """Every model on every raster, errors kept apart: detections and errors per model."""
    ship(d.spark)
    return detectors.model_table(detectors.run_models(detectors.chips(d.pixels, 8, 8), ["langsam", "owlv2", "clipseg", "missing"], ["dark roof panel."]))


@query("select * from (values ('default module z is not one of the models'), ('missing key: project_name'), ('missing key: version')) t(problem)")
def cli_config_check(d: Domain) -> DataFrame:
    """What the check of a configuration reports."""
    found = [p if p.startswith("missing") else p.split(" is not")[0] + " is not one of the models" for p in config.check({"default_module": "z"}, detectors.models())]
    return d.spark.createDataFrame([(p,) for p in found], "problem string")


@query()
def udf_versions(d: Domain) -> DataFrame:
    """Versions of the libraries that the workers see; a missing one is null."""
    return detectors.versions(d.spark)


@query()
def pipeline_tile_flow(d: Domain) -> DataFrame:
    """Rasters written as GeoTIFFs, detected patch by patch, suppressed, filtered, written as GeoJSON and read again."""
    from parcelight.plans.source_queries import write_rasters

    folder, out = write_rasters(d), f"{d.ws.path('flow').removeprefix('file://')}"
    flow.run(d.spark, folder, out, "langsam", ["dark roof panel."], replace(LIMITS, min_area=0.05, max_aspect=8.0))
    return geojson.read_masks(d.spark, out).select("tile_id", "region", "detection_id", "area_m2", "score", "prompt")
