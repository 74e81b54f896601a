"""The pN_ queries of the training-data operators, with SQL where whole tables allow it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelight.llm import cutoff, groups, packing, percentiles, tokens, truncated
from parcelight.runtime import Workspace, read_table


def p1_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median, 90th and 99th percentile of area_m2 per tile, from day summaries."""
    return percentiles.percentiles(Workspace(spark, "p1"), read_table(spark, sf_dir, "detections"))


def p1_day_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summaries of single days that p1_percentiles combines."""
    values = percentiles.measured(read_table(spark, sf_dir, "detections"))
    return percentiles.day_summaries(Workspace(spark, "p1"), values, "tile_id")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each linked detection with the least detection of its group."""
    edges = groups.clean_edges(read_table(spark, sf_dir, "detection_matches"), read_table(spark, sf_dir, "detections"), "detection_a", "detection_b", "detection_id")
    return groups.groups(Workspace(spark, "p4"), edges).select(F.col("id").alias("detection_id"), "group_id")


def _cutoffs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ws = Workspace(spark, "p5")
    targets = read_table(spark, sf_dir, "prompt_targets").select(cutoff.source_key(F.col("prompt")).alias("source"), F.col("target_permille").alias("permille"))
    data = cutoff.scored(read_table(spark, sf_dir, "detections")).join(targets.select("source"), "source", "left_semi")
    data = ws.write(data, "scored")
    return data, ws.write(cutoff.cutoffs(ws, data, targets), "cutoffs")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections that reach the cutoff of their prompt."""
    return cutoff.kept(*_cutoffs(spark, sf_dir)).select(F.col("id").alias("detection_id"))


def p5_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cutoff and kept number of each prompt of prompt_targets."""
    return _cutoffs(spark, sf_dir)[1].withColumnsRenamed({"source": "prompt", "permille": "target_permille"})


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return tokens.token_ids(read_table(spark, sf_dir, "documents"))


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of every document, or of each of its pieces if it exceeds one."""
    return packing.pack(Workspace(spark, "p8"), tokens.token_counts(read_table(spark, sf_dir, "documents")), "doc_id")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose text was cut off."""
    return truncated.scored(Workspace(spark, "p9"), read_table(spark, sf_dir, "documents")).filter("margin > 0").select("doc_id")


def p9_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each source's texts are cut off."""
    cut = F.col("margin") > 0
    return truncated.scored(Workspace(spark, "p9"), read_table(spark, sf_dir, "documents")).groupBy("source").agg(F.count("*").alias("n"), F.count_if(cut).alias("cut"), F.avg(cut.cast("double")).alias("share"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_percentiles, p1_day_summaries, p4_found, p5_found, p5_cutoffs, p7_ids, p8_containers, p9_found, p9_sources)}


_P1_DAYS = """
  first_seen as (
    select detection_id, tile_id, cast(detected_at as date) as day, area_m2 as value from detections
    where area_m2 > 0 and not isnan(area_m2) and not isinf(area_m2)
    qualify row_number() over (partition by detection_id order by ingested_at, tile_id, detected_at, area_m2) = 1
  ), counts as (
    select tile_id, day, value, count(*) as n from first_seen group by all
  ), ranked as (
    select *, sum(n) over (partition by tile_id, day order by value) as running, sum(n) over (partition by tile_id, day) as total from counts
  ), days as (
    select tile_id, day, max(value) as value, cast(sum(n) as bigint) as n from ranked group by tile_id, day, floor((running - 1) * 200 / total)
  )"""

_P5_DATA = r"""
  d as (
    select detection_id, rtrim(regexp_replace(lower(trim(regexp_replace(prompt, '\s+', ' ', 'g'))), '\.$', '')) as k, score from detections
    where score between 0 and 1 and not isnan(score) and prompt is not null
    qualify row_number() over (partition by detection_id order by ingested_at) = 1
  ), t as (
    select rtrim(regexp_replace(lower(trim(regexp_replace(prompt, '\s+', ' ', 'g'))), '\.$', '')) as k, target_permille from prompt_targets
  ), r as (
    select *, count(*) over (partition by k) as n, count(*) over (partition by k order by score desc) as reach from d
  ), c as (
    select t.k, target_permille, coalesce(max(n), 0) as n, max(score) filter (reach * 1000 >= n * target_permille) as cutoff from t left join r using (k) group by all
  )"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_day_summaries": f"with {_P1_DAYS} select tile_id, day, value, n from days",
        "p1_percentiles": f"""with {_P1_DAYS}, merged as (
            select tile_id, value, sum(n) as n from days group by all
          ), cumulated as (
            select *, sum(n) over (partition by tile_id order by value) as running, sum(n) over (partition by tile_id) as total from merged
          )
          select tile_id, cast(sum(n) as bigint) as n, min(value) filter (running >= ceil(total * 0.5::double)) as p50,
            min(value) filter (running >= ceil(total * 0.9::double)) as p90, min(value) filter (running >= ceil(total * 0.99::double)) as p99
          from cumulated group by tile_id""",
        "p4_found": """with recursive ids as (select distinct detection_id from detections), e as (
            select distinct least(detection_a, detection_b) as u, greatest(detection_a, detection_b) as v from detection_matches
            where detection_a <> detection_b and detection_a in (from ids) and detection_b in (from ids)
          ), s as (select u, v from e union all select v, u from e), r(id, seen) using key (id) as (
            select u, min(least(u, v)) from s group by u
            union
            select s.v, min(r.seen) from r join s on s.u = r.id join recurring.r as o on o.id = s.v where r.seen < o.seen group by s.v
          ) select id as detection_id, seen as group_id from r""",
        "p5_found": f"with {_P5_DATA} select detection_id from d join c using (k) where score >= cutoff",
        "p5_cutoffs": f"""with {_P5_DATA} select c.k as prompt, target_permille, cast(c.n as bigint) as n, cutoff,
            cast(count(d.detection_id) as bigint) as kept from c left join d on d.k = c.k and d.score >= c.cutoff group by all""",
    }
