"""The pN_ queries of the core: points near points, small files, drifting schemas."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelight.operators import compact, drift, near
from parcelight.runtime import Workspace, read_table

#: Metres within which prosumers are near each other.
NEAR_M = 10.0


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of different located prosumers at most 10 m apart."""
    ws = Workspace(spark, "p2")
    return near.pairs_within(ws, near.locations(read_table(spark, sf_dir, "prosumers")), NEAR_M)


def _consolidated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ws = Workspace(spark, "p3")
    return compact.compact(ws, read_table(spark, sf_dir, "mask_files"), ws.path("mask_features"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features that the consolidation left out as repeats of an earlier one."""
    return _consolidated(spark, sf_dir)[1].select("file_id", "feature_no")


def p3_consolidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consolidated features, each once, as the target folder holds them."""
    return _consolidated(spark, sf_dir)[0].drop("ring", "shape")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of fields from each export to the next of its series."""
    return drift.field_changes(Workspace(spark, "p6"), read_table(spark, sf_dir, "model_exports"))


def p6_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same changes with their series and run, in order."""
    return drift.change_log(Workspace(spark, "p6"), read_table(spark, sf_dir, "model_exports"))


def p6_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readable records as one table with one set of columns."""
    return drift.unify(Workspace(spark, "p6"), read_table(spark, sf_dir, "model_exports"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p2_found": p2_found, "p3_found": p3_found, "p3_consolidated": p3_consolidated, "p6_found": p6_found, "p6_log": p6_log, "p6_table": p6_table}


def oracle_sql() -> dict[str, str]:
    return {"p2_found": P2_SQL, "p3_found": P3_SQL, "p3_consolidated": P3_KEPT_SQL, "p6_found": P6_SQL, "p6_log": P6_LOG_SQL}


#: All pairs within one distance, by grid cells of that size.
P2_SQL = r"""
with n as (
  select id, loaded_at, regexp_extract_all(case when geometry like '%coordinates%' then regexp_replace(geometry, '^.*coordinates"\s*:', '')
         else regexp_replace(geometry, '^\s*SRID=\d+;', '', 'i') end, '[-+]?[0-9]+\.?[0-9]*') as o from prosumers where geometry is not null
), p as (
  select id, loaded_at, cast(o[1] as double) as x, cast(o[2] as double) as y from n where len(o) >= 2
), l as (
  select id, x, y from p where not (x = 0 and y = 0) qualify row_number() over (partition by id order by loaded_at desc nulls last, x desc, y desc) = 1
), c as (
  select *, cast(floor(x / 10) as bigint) as cx, cast(floor(y / 10) as bigint) as cy from l
), r as (
  select id, x, y, cx + dx as cx, cy + dy as cy from c, (values (-1), (0), (1)) a(dx), (values (-1), (0), (1)) b(dy)
)
select c.id as id_a, r.id as id_b from c join r using (cx, cy)
where c.id < r.id and (c.x - r.x) * (c.x - r.x) + (c.y - r.y) * (c.y - r.y) <= 100
"""


#: Features by the definition of sameness, over parsed documents.
_P3_FEATURES = """
with f as (
  select file_id, unnest(json_extract(body, '$.features[*]')) as f, generate_subscripts(json_extract(body, '$.features[*]'), 1) as n from mask_files where json_valid(body)
), p as (
  select file_id, cast(n - 1 as int) as feature_no, f ->> '$.properties.tile_id' as tile_id, f ->> '$.properties.region' as region, cast(f ->> '$.properties.detection_id' as double) as detection_id,
    cast(f ->> '$.properties.area_m2' as double) as area_m2, cast(f ->> '$.properties.score' as double) as score, f ->> '$.properties.prompt' as prompt, f ->> '$.properties.crs' as crs,
    cast(f -> '$.geometry.coordinates[0]' as double[][])[:-2] as corners from f
), k as (
  select *, list_position(corners, list_min(corners)) as k from p
), r as (
  select *, row_number() over (partition by tile_id, region, detection_id, area_m2, score, prompt, corners[k:] || corners[:k - 1] order by file_id, feature_no) as place from k
)
"""
P3_SQL = _P3_FEATURES + "select file_id, feature_no from r where place > 1"
P3_KEPT_SQL = _P3_FEATURES + "select file_id, feature_no, tile_id, region, detection_id, area_m2, score, prompt, crs, cast(null as varchar) as rest from r where place = 1"

#: Changes by the definitions: fields of neighbours, and for pairs of a gone and a new one all common detections.
_P6_CHANGES = r"""
with r as (
  select distinct export_id, rec_no, payload from model_exports where json_valid(payload) and json_type(payload) = 'OBJECT'
), f as (
  select export_id, payload ->> '$.detection_id' as k, j.key as field, j.value as v, case when j.type = 'VARCHAR' then 'string' when j.type = 'BOOLEAN' then 'boolean' when j.type = 'ARRAY' then 'array' when j.type = 'OBJECT' then 'object' else 'number' end as t
  from r, json_each(r.payload) j where j.type <> 'NULL'
), h as (
  select export_id, field, case when count(distinct t) = 1 then min(t) else 'string' end as t from f group by all
), e as (
  select export_id, building_id, module, run_no, lag(export_id) over (partition by building_id, module order by run_no, export_id) as before from (select distinct export_id, building_id, module, run_no from model_exports)
), gone as (
  select e.export_id, h.field, h.t from e join h on h.export_id = before where not exists (select 1 from h n where n.export_id = e.export_id and n.field = h.field)
), new as (
  select e.export_id, h.field, h.t from e join h on h.export_id = e.export_id where before is not null and not exists (select 1 from h o where o.export_id = before and o.field = h.field)
), p as (
  select export_id, k, field, case when t = 'array' and json_array_length(v) = 1 then v ->> '$[0]' when t = 'object' then coalesce(v ->> '$.value', v ->> '$') else v ->> '$' end as x from f where field <> 'detection_id'
), c as (
  select export_id, k, field, case when regexp_full_match(trim(x), '[+-]?([0-9]+([.,][0-9]*)?|[.,][0-9]+)([eE][+-]?[0-9]+)?') then 'n' || cast(cast(replace(trim(x), ',', '.') as double) as varchar) else 's' || x end as x from p where x is not null and k is not null
), agreed as (
  select e.export_id, a.field as old_field, b.field as new_field, g.t as old_t, n.t as new_t, count(distinct a.k) as n
  from e join gone g on g.export_id = e.export_id join new n on n.export_id = e.export_id join c a on a.export_id = e.before and a.field = g.field join c b on b.export_id = e.export_id and b.field = n.field and b.k = a.k
  group by all having bool_and(a.x = b.x)
), ranked as (
  select *, row_number() over (partition by export_id, old_field order by n desc, old_field, new_field) as po, row_number() over (partition by export_id, new_field order by n desc, old_field, new_field) as pn from agreed
), renamed as (
  select * from ranked where po = 1 and pn = 1
), changes as (
  select export_id, 'renamed' as change, old_field, new_field from renamed
  union all select export_id, 'removed', field, '' from gone g where not exists (select 1 from renamed r where r.export_id = g.export_id and r.old_field = g.field)
  union all select export_id, 'added', '', field from new n where not exists (select 1 from renamed r where r.export_id = n.export_id and r.new_field = n.field)
  union all select export_id, 'retyped', old_field, new_field from renamed where old_t <> new_t
  union all select e.export_id, 'retyped', o.field, o.field from e join h o on o.export_id = before join h n on n.export_id = e.export_id and n.field = o.field where o.t <> n.t
)
"""
P6_SQL = _P6_CHANGES + "select * from changes"
P6_LOG_SQL = _P6_CHANGES + "select building_id, module, run_no, changes.* from changes join e using (export_id)"
