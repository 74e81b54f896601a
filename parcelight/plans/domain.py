"""The tables of the detection domain, each row once and cleaned: detections, tiles, prosumers, buildings, and rasters over the order tables.

Each relation is given twice: as a DataFrame and as the text of a common table
expression, for a check of results by another engine.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelight.functions import polygons
from parcelight.functions.boxes import Box
from parcelight.operators.near import locations
from parcelight.runtime import Workspace, read_table

#: Prompts that name what is no panel.
NEGATIVE = ("skylight window", "water heater panel")


def plain_prompt(text: Column) -> Column:
    """A prompt without case, outer and repeated blanks and final full stop."""
    return F.rtrim(F.regexp_replace(F.lower(F.trim(F.regexp_replace(text, r"\s+", " "))), r"\.$", ""))


def masks_of(detections: DataFrame) -> DataFrame:
    """Detections as masks: id, tile, region, prompt, score, area_m2, source_file, day, shape, edges and the bounds x0, y0, x1, y1 and the area inside the edges.

    Of several deliveries of an id the first loaded one counts. A missing tile
    is the tile `none`; a score that isn't from 0 to 1 and an area that isn't
    positive and finite are null. A geometry that is null, empty or unreadable
    has neither edges nor bounds.
    """
    rows = detections.filter("detection_id is not null").groupBy("detection_id").agg(F.min(F.struct("ingested_at", "tile_id", "region", "area_m2", "score", "prompt", "source_file", "geometry", "detected_at")).alias("d"))
    d = lambda c: F.col(f"d.{c}")
    plain = rows.select(
        F.col("detection_id").alias("id"),
        F.coalesce(d("tile_id"), F.lit("none")).alias("tile"),
        F.lower(F.trim(d("region"))).alias("region"),
        plain_prompt(d("prompt")).alias("prompt"),
        F.when(d("score").between(0, 1), d("score")).alias("score"),
        F.when((d("area_m2") > 0) & (d("area_m2") < float("inf")), d("area_m2")).alias("area_m2"),
        d("source_file").alias("source_file"),
        F.to_date(d("detected_at")).alias("day"),
        d("geometry").alias("geometry"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield polygons.with_edges(b, "geometry")

    kept = [f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields if f.name != "geometry"]
    shaped = plain.mapInArrow(run, ", ".join([*kept, f"shape {polygons.TYPE}", f"edges {polygons.EDGES}", *(f"{c} double" for c in ("x0", "y0", "x1", "y1", "area"))]))
    # Coordinates in centimetres give areas in steps of half a square centimetre.
    return shaped.withColumn("area", F.round("area", 5))


class Domain:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @cached_property
    def ws(self) -> Workspace:
        return Workspace(self.spark, "domain")

    @cached_property
    def detections(self) -> DataFrame:
        """All detections as masks, also those without a geometry."""
        return masks_of(self.table("detections"))

    @cached_property
    def masks(self) -> DataFrame:
        """Detections with a geometry, parsed once and written, as joins read them more than once."""
        return self.ws.write(self.detections.filter("edges is not null"), "masks")

    @cached_property
    def outlines(self) -> DataFrame:
        """The masks with no more than suppression and filters by shape need, for queries that have much else to keep on disk."""
        return self.ws.write(self.detections.filter("edges is not null").select("id", "tile", "prompt", "score", "edges", "x0", "y0", "x1", "y1", "area"), "outlines")

    @cached_property
    def shapes(self) -> DataFrame:
        """The masks' ids, shapes and bounds alone, for queries that give the shapes out; edges are made of them where they are compared."""
        return self.ws.write(self.detections.filter("edges is not null").select("id", "shape", "x0", "y0", "x1", "y1"), "shapes")

    @cached_property
    def boxes(self) -> DataFrame:
        """The bounds of the masks."""
        return self.masks.drop("shape", "edges")

    @cached_property
    def points(self) -> DataFrame:
        """Located prosumers, as last delivered."""
        return self.ws.write(self._points, "points")

    @property
    def _points(self) -> DataFrame:
        rows = self.table("prosumers").groupBy("id").agg(F.max(F.struct("loaded_at", "tile_id", "pot_kw", "estat", "srid")).alias("r"))
        more = rows.select(F.col("id").alias("pid"), "r.tile_id", "r.pot_kw", "r.estat", "r.srid")
        return locations(self.table("prosumers")).withColumnRenamed("id", "pid").join(more, "pid")

    @cached_property
    def prosumers(self) -> DataFrame:
        """Located prosumers, not written: for queries that read them once."""
        return self._points

    @cached_property
    def grid(self) -> DataFrame:
        """Tiles of 1 km."""
        return self.table("tiles").select(F.col("coord_1k").alias("tile"), "coord_10k", "geom_type", F.col("minx").alias("x0"), F.col("miny").alias("y0"), F.col("maxx").alias("x1"), F.col("maxy").alias("y1"), "srid")

    @cached_property
    def footprints(self) -> DataFrame:
        """A footprint of 12 m x 12 m around each located prosumer, with its shape."""
        box = Box.of(F.col("x"), F.col("y"), F.col("x"), F.col("y")).grown(6.0)
        corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
        ring = F.array(corner(F.col("x0"), F.col("y0")), corner(F.col("x1"), F.col("y0")), corner(F.col("x1"), F.col("y1")), corner(F.col("x0"), F.col("y1")))
        return self.points.select(F.col("pid").alias("fid"), *box.columns()).withColumn("shape", F.array(F.array(ring)))

    @cached_property
    def buildings(self) -> DataFrame:
        """The footprints with edges."""
        return self.footprints.select("fid", "x0", "y0", "x1", "y1", polygons.edges(F.col("shape")).alias("edges"))

    @cached_property
    def plots(self) -> DataFrame:
        """Small footprints in metres from a raster's corner, one per supplier."""
        k = F.col("s_suppkey")
        return self.table("supplier").select(k.alias("fid"), ((k % 9) * 2.0).alias("x0"), ((k % 7) * 2.0).alias("y0"), ((k % 9) * 2.0 + 12).alias("x1"), ((k % 7) * 2.0 + 10).alias("y1"))

    @cached_property
    def rasters(self) -> DataFrame:
        """Rasters in pixels, one per part."""
        k = F.col("p_partkey")
        return self.table("part").select(k.alias("raster"), (F.lit(64) + (k * 37) % 900).cast("int").alias("w"), (F.lit(64) + (k * 53) % 900).cast("int").alias("h"), F.col("p_size").alias("size"), F.col("p_retailprice").alias("price"))

    @cached_property
    def pixels(self) -> DataFrame:
        """Pixels of 8 x 8 rasters, one per line item, the greatest value where several meet; their number grows with the table."""
        k = F.col("l_orderkey")
        rows = self.table("lineitem").select(F.floor(k / 64).alias("raster"), F.floor(k % 64 / 8).cast("int").alias("r"), (F.col("l_partkey") % 8).cast("int").alias("c"), (F.col("l_quantity") * 20).cast("int").alias("v"), (F.col("l_suppkey") % 20).cast("int").alias("alpha"))
        return rows.groupBy("raster", "r", "c").agg(F.max("v").alias("v"), F.max("alpha").alias("alpha"))


_PLAIN = r"rtrim(regexp_replace(lower(trim(regexp_replace(prompt, '\s+', ' ', 'g'))), '\.$', ''))"
CTE = {
    "firsts": f"""firsts as (select detection_id as id, coalesce(tile_id, 'none') as tile, lower(trim(region)) as region, {_PLAIN} as prompt, case when score between 0 and 1 and not isnan(score) then score end as score,
        case when area_m2 > 0 and not isnan(area_m2) and not isinf(area_m2) then area_m2 end as area_m2, source_file, cast(detected_at as date) as day, geometry
        from detections qualify row_number() over (partition by detection_id order by ingested_at) = 1)""",
    "corners": r"""corners as (select id, n, cast(split_part(trim(c), ' ', 1) as double) as x, cast(split_part(trim(c), ' ', 2) as double) as y from (
        select id, unnest(string_split(regexp_extract(geometry, '\(\(+([^()]+)\)', 1), ',')) as c, generate_subscripts(string_split(regexp_extract(geometry, '\(\(+([^()]+)\)', 1), ','), 1) as n from firsts where geometry like '%(%'))""",
    "edges": """edges as (select id, n, case when s < 0 then bx else ax end as ax, case when s < 0 then b_y else ay end as ay, case when s < 0 then ax else bx end as bx, case when s < 0 then ay else b_y end as b_y from (
        select *, sum((ax - fx) * (b_y - fy) - (bx - fx) * (ay - fy)) over (partition by id) as s from (
          select a.id, a.n, a.x as ax, a.y as ay, b.x as bx, b.y as b_y, f.x as fx, f.y as fy from corners a join corners b on a.id = b.id and b.n = a.n + 1 join corners f on f.id = a.id and f.n = 1)))""",
    "boxes": """boxes as (select f.* exclude (geometry), x0, y0, x1, y1, area from firsts f join (select id, min(x) as x0, min(y) as y0, max(x) as x1, max(y) as y1 from corners group by id) using (id)
        join (select id, round(sum((ax - fx) * (b_y - fy) - (bx - fx) * (ay - fy)) / 2, 5) as area from edges join (select id, x as fx, y as fy from corners where n = 1) using (id) group by id) using (id))""",
    "commons": """commons as (select a_id, b_id, sum(s * (hi - lo) * ((e0 + e1 + f0 + f1) / 4 - case when (e0 - f0) * (e1 - f1) >= 0 then abs(e0 - f0 + e1 - f1) / 2 else ((e0 - f0) * (e0 - f0) + (e1 - f1) * (e1 - f1)) / (2 * (abs(e0 - f0) + abs(e1 - f1))) end / 2)) as inter from (
        select *, (eay - base) + (eby - eay) * (lo - eax) / (ebx - eax) as e0, (eay - base) + (eby - eay) * (hi - eax) / (ebx - eax) as e1,
          (fay - base) + (fby - fay) * (lo - fax) / (fbx - fax) as f0, (fay - base) + (fby - fay) * (hi - fax) / (fbx - fax) as f1 from (
          select a_id, b_id, base, e.ax as eax, e.ay as eay, e.bx as ebx, e.b_y as eby, f.ax as fax, f.ay as fay, f.bx as fbx, f.b_y as fby, sign(e.ax - e.bx) * sign(f.ax - f.bx) as s,
            greatest(least(e.ax, e.bx), least(f.ax, f.bx)) as lo, least(greatest(e.ax, e.bx), greatest(f.ax, f.bx)) as hi
          from (select a.id as a_id, b.id as b_id, least(a.y0, b.y0) as base from boxes a join boxes b on a.tile = b.tile and a.id < b.id and a.x0 < b.x1 and a.x1 > b.x0 and a.y0 < b.y1 and a.y1 > b.y0)
          join edges e on e.id = a_id join edges f on f.id = b_id) where lo < hi) group by a_id, b_id having inter > 1e-6::double)""",
    "insides": """insides as (select b.id, pid from boxes b join points p on x > x0 and x < x1 and y > y0 and y < y1 join edges e on e.id = b.id group by b.id, pid
        having count(*) filter ((ay > y) <> (b_y > y) and x < (bx - ax) * (y - ay) / (b_y - ay) + ax) % 2 = 1
          and not bool_or((bx - ax) * (y - ay) - (b_y - ay) * (x - ax) = 0 and x between least(ax, bx) and greatest(ax, bx) and y between least(ay, b_y) and greatest(ay, b_y)))""",
    "nears": """nears as (select id, pid, case when count(*) filter ((ay > y) <> (b_y > y) and x < (bx - ax) * (y - ay) / (b_y - ay) + ax) % 2 = 1 then 0 else min(sqrt(pow(x - ax - t * (bx - ax), 2) + pow(y - ay - t * (b_y - ay), 2))) end as distance from (
        select b.id, pid, x, y, ax, ay, bx, b_y, greatest(0, least(1, ((x - ax) * (bx - ax) + (y - ay) * (b_y - ay)) / ((bx - ax) * (bx - ax) + (b_y - ay) * (b_y - ay)))) as t
        from boxes b join points p on x > x0 - 50 and x < x1 + 50 and y > y0 - 50 and y < y1 + 50 join edges e on e.id = b.id) group by id, pid)""",
    "points": r"""points as (select l.id as pid, x, y, tile_id, pot_kw, estat, srid from (
        select id, cast(o[1] as double) as x, cast(o[2] as double) as y from (select id, loaded_at, regexp_extract_all(case when geometry like '%coordinates%' then regexp_replace(geometry, '^.*coordinates"\s*:', '')
          else regexp_replace(geometry, '^\s*SRID=\d+;', '', 'i') end, '[-+]?[0-9]+\.?[0-9]*') as o from prosumers where geometry is not null)
        where len(o) >= 2 and not (cast(o[1] as double) = 0 and cast(o[2] as double) = 0) qualify row_number() over (partition by id order by loaded_at desc nulls last, x desc, y desc) = 1) l
        join (select id, tile_id, pot_kw, estat, srid from prosumers qualify row_number() over (partition by id order by loaded_at desc nulls last, tile_id desc nulls last, pot_kw desc nulls last, estat desc nulls last, srid desc nulls last) = 1) m using (id))""",
    "grid": "grid as (select coord_1k as tile, coord_10k, geom_type, minx as x0, miny as y0, maxx as x1, maxy as y1, srid from tiles)",
    "buildings": "buildings as (select pid as fid, x - 6 as x0, y - 6 as y0, x + 6 as x1, y + 6 as y1 from points)",
    "plots": """plots as (select s_suppkey as fid, cast(s_suppkey % 9 * 2 as double) as x0, cast(s_suppkey % 7 * 2 as double) as y0,
        cast(s_suppkey % 9 * 2 + 12 as double) as x1, cast(s_suppkey % 7 * 2 + 10 as double) as y1 from supplier)""",
    "rasters": """rasters as (select p_partkey as raster, cast(64 + (p_partkey * 37) % 900 as int) as w, cast(64 + (p_partkey * 53) % 900 as int) as h,
        p_size as size, p_retailprice as price from part)""",
    "pixels": """pixels as (select l_orderkey // 64 as raster, cast(l_orderkey % 64 // 8 as int) as r, cast(l_partkey % 8 as int) as c,
        max(cast(l_quantity * 20 as int)) as v, max(cast(l_suppkey % 20 as int)) as alpha from lineitem group by all)""",
}

#: What a relation is made of.
_NEEDS = {"corners": ["firsts"], "edges": ["corners"], "boxes": ["edges"], "buildings": ["points"], "commons": ["boxes"], "insides": ["boxes", "points"], "nears": ["boxes", "points"]}


def with_relations(sql: str) -> str:
    """The SQL with the relations that it names, and those that they need before them."""
    used: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in used:
            used.append(name)

    for name in CTE:
        if re.search(rf"\b{name}\b", sql):
            add(name)
    own = re.match(r"\s*with\s+(recursive\s+)?", sql)
    head = ", ".join(CTE[name] for name in used)
    rest = sql[own.end() :] if own else sql
    return (f"with {'recursive ' if own and own[1] else ''}{head}{', ' if head and own else ' '}{rest}") if head or own else sql


class Registry:
    """Queries by name, each with the SQL that gives the same rows, if there is one."""

    def __init__(self):
        self.runs: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None, name: str | None = None):
        def add(f: Callable[[Domain], DataFrame]):
            key = name or f.__name__
            self.runs[key] = lambda spark, sf_dir: f(Domain(spark, sf_dir))
            if sql:
                self.sql[key] = with_relations(sql)
            return f

        return add
