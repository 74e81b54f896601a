"""Results as GeoJSON: reading many files, and one file per tile and region."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelight.operators.rangesort import running_sums
from parcelight.runtime import Workspace, listing, rename

#: Features as they are written; older files have mask_id and avg_score.
FEATURES = "type string, crs struct<type:string,properties:struct<name:string>>, metadata map<string,string>, features array<struct<type:string,geometry:struct<type:string,coordinates:string>,properties:map<string,string>>>"
_PROPERTIES = {"detection_id": "int", "area_m2": "double", "score": "double", "prompt": "string", "crs": "string", "region": "string", "tile_id": "string"}
_OLDER = {"detection_id": "mask_id", "score": "avg_score"}


def stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.geojson$", "")


def read_masks(spark: SparkSession, folder: str, tile_id: str | None = None, merged: bool = False) -> DataFrame:
    """Features of all *.geojson files of a folder, by file name: source_file, file_tile, file_region, feature_no, the properties, geometry (GeoJSON text) and srid.

    `tile_id` keeps files whose name contains it. Merged files (*_merged*) repeat
    others and are left out unless asked for. Files that aren't collections, or
    hold no features, have no rows. A missing property is null; a missing CRS
    is 25831. File lists and names are pruned before any file is read.
    """
    files = spark.read.option("pathGlobFilter", "*.geojson").text(folder, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    name = stem(F.col("path"))
    files = files.withColumn("source_file", name)
    if not merged:
        files = files.filter(~F.contains("source_file", F.lit("_merged")))
    if tile_id is not None:
        files = files.filter(F.contains("source_file", F.lit(tile_id)))
    parsed = files.select("source_file", F.from_json("value", FEATURES).alias("d"))
    rows = parsed.select("source_file", F.col("d.crs.properties.name").alias("_crs"), F.posexplode("d.features").alias("feature_no", "f"))
    p = F.col("f.properties")
    value = {k: F.coalesce(p[k], p[_OLDER[k]]) if k in _OLDER else p[k] for k in _PROPERTIES}
    tagged = F.regexp_extract("source_file", "_(core|donut)$", 1)
    return rows.select(
        F.concat("source_file", F.lit(".geojson")).alias("source_file"),
        F.regexp_replace("source_file", "_(core|donut)$", "").alias("file_tile"),
        F.when(tagged != "", tagged).alias("file_region"),
        "feature_no",
        *[value[k].try_cast(t).alias(k) for k, t in _PROPERTIES.items()],
        F.to_json(F.struct(F.col("f.geometry.type").alias("type"), F.try_parse_json(F.col("f.geometry.coordinates")).alias("coordinates"))).alias("geometry"),
        F.coalesce(F.regexp_extract("_crs", r"EPSG:+(?::)?(\d+)", 1).try_cast("int"), F.lit(25831)).alias("srid"),
    )


def read_grid(spark: SparkSession, path: str, key: str = "COORD_1K") -> DataFrame:
    """Tiles of a GeoJSON grid: coord_1k, coord_10k, geom_type and bounds x0, y0, x1, y1. A grid without the key column is refused."""
    text = spark.read.text(path, wholetext=True)
    features = text.select(F.explode(F.from_json("value", FEATURES)["features"]).alias("f"))
    if features.filter(F.map_contains_key("f.properties", key)).isEmpty() and not features.isEmpty():
        raise ValueError(f"the grid has no column {key}")
    flat = F.transform(F.regexp_extract_all("f.geometry.coordinates", F.lit(r"\[\s*(-?[\d.eE+-]+\s*,\s*-?[\d.eE+-]+)")), lambda c: F.split(c, ","))
    xs, ys = F.transform("c", lambda p: p[0].cast("double")), F.transform("c", lambda p: p[1].cast("double"))
    rows = features.select(F.col("f.properties")[key].alias("coord_1k"), F.col("f.properties")["COORD_10K"].alias("coord_10k"), F.col("f.geometry.type").alias("geom_type"), flat.alias("c"))
    return rows.select("coord_1k", "coord_10k", "geom_type", F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def _feature(row: dict, geometry: str, names: list[str]) -> dict:
    return {"type": "Feature", "geometry": json.loads(geometry), "properties": {k: None if pd.isna(row[k]) else row[k] for k in names}}


def collection(features: list[dict], srid: int = 25831, metadata: dict | None = None) -> dict:
    out = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": f"urn:ogc:def:crs:EPSG::{srid}"}}, "features": features}
    return out | ({"metadata": metadata} if metadata is not None else {})


def numbered(ws: Workspace, masks: DataFrame) -> DataFrame:
    """Masks (tile_id, region, score, id, geometry, area_m2, prompt) with detection_id from 0 per tile and region, by score and id, and rounded figures.

    Empty geometries take a number, and are left out only when written. A hot
    tile is numbered by many tasks.
    """
    placed = running_sums(ws, masks.withColumn("one", F.lit(1)), ["tile_id", "region"], [F.desc("score"), "id"], "one", "numbered").drop("one", "total")
    return placed.withColumns({"detection_id": (F.col("running") - 1).cast("int"), "area_m2": F.round("area_m2", 2), "score": F.round("score", 3)}).drop("running")


def write_tiles(masks: DataFrame, folder: str, srid: int = 25831) -> DataFrame:
    """Writes {tile_id}_{region}.geojson for each pair and returns (file, features); runs when the result is read.

    `masks` is as from `numbered`. Each file is written by one task under
    another name and moved into place, so a repeated task leaves one whole file.
    `folder` must be a folder that all executors share.
    """
    names = ["tile_id", "region", "detection_id", "crs", "area_m2", "score", "prompt"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values("detection_id").assign(crs=f"EPSG:{srid}").to_dict("records")
        features = [_feature(r, r["geometry"], names) for r in rows if r["geometry"]]
        name = f"{rows[0]['tile_id']}_{rows[0]['region']}.geojson"
        os.makedirs(folder, exist_ok=True)
        part = os.path.join(folder, f".{name}.{uuid.uuid4().hex}")
        with open(part, "w") as f:
            json.dump(collection(features, srid), f, ensure_ascii=False, default=lambda v: v.item())
        os.replace(part, os.path.join(folder, name))
        return pd.DataFrame({"file": [name], "features": [len(features)]})

    return masks.groupBy("tile_id", "region").applyInPandas(run, "file string, features int")


def write_empty(tiles: DataFrame, folder: str, region: str = "core") -> int:
    """Writes a file without features for each tile (tile_id); returns their number."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            os.makedirs(folder, exist_ok=True)
            for tile in b["tile_id"]:
                part = os.path.join(folder, f".{tile}.{uuid.uuid4().hex}")
                with open(part, "w") as f:
                    json.dump(collection([]), f)
                os.replace(part, os.path.join(folder, f"{tile}_{region}.geojson"))
            yield pd.DataFrame({"n": [len(b)]})

    return int(tiles.select("tile_id").mapInPandas(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])


#: Features of one merged file.
MERGED_FEATURES = 200_000


def write_merged(parts: list[DataFrame], folder: str, srid: int = 25831) -> int:
    """All features of several tables in GeoJSON files `<n>_merged.geojson` of about MERGED_FEATURES, sorted by tile and region; returns the number of files.

    Columns are aligned by name. A file is written line by line by one task, so
    no document is held in memory; features without a geometry are left out.
    """
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    spark = out.sparkSession
    props = [c for c in out.columns if c not in ("geometry", "id")]
    feature = F.to_json(F.struct(F.lit("Feature").alias("type"), F.try_parse_json("geometry").alias("geometry"), F.struct(*props).alias("properties")), {"ignoreNullFields": "false"})
    rows = out.filter("geometry is not null")
    files = max(1, -(-rows.count() // MERGED_FEATURES))
    ordered = rows.repartitionByRange(files, "tile_id", "region", "detection_id").sortWithinPartitions("tile_id", "region", "detection_id").select(feature.alias("value"))
    head = json.dumps(collection([], srid)).removesuffix("]}")

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = True
        for b in batches:
            out = [("" if first and i == 0 else ",") + v for i, v in enumerate(b["value"])]
            if first and out:
                out, first = [head, *out], False
            yield pd.DataFrame({"value": out})
        if not first:
            yield pd.DataFrame({"value": ["]}"]})

    ordered.mapInPandas(lines, "value string").write.mode("overwrite").text(folder)
    written = sorted(f for f in listing(spark, folder) if f.endswith(".txt"))
    for i, name in enumerate(written):
        rename(spark, f"{folder}/{name}", f"{folder}/{i:05d}_merged.geojson")
    return len(written)


def building_features(kept: DataFrame, building: Column | str, negatives: DataFrame | None = None, per: list[str] | None = None) -> DataFrame:
    """Features of one building's detections (no, geometry, score): id `<building>_<4 digits>`, type pv or negative_mask; negatives are numbered after the kept ones.

    With `per`, detections are those of many buildings, each numbered on its own.
    """
    building = F.lit(building) if isinstance(building, str) else building
    per = per or []
    rows = kept.select(*per, "no", "geometry", "score", F.lit("pv").alias("type"))
    if negatives is not None:
        counts = kept.groupBy(*per).agg(F.count("*").alias("offset"))
        moved = negatives.join(counts, per, "left") if per else negatives.crossJoin(counts)
        rows = rows.unionAll(moved.select(*per, (F.col("no") + F.coalesce("offset", F.lit(0))).alias("no"), "geometry", "score", F.lit("negative_mask").alias("type")))
    return rows.select(*per, F.format_string("%s_%04d", building, "no").alias("id"), "type", "geometry", "score")


def documents(features: DataFrame, key: list[str]) -> DataFrame:
    """(key..., document): one FeatureCollection as JSON text per key, without Python.

    For keys whose features fit in one document; features (id, type, geometry, ...) are ordered by id.
    """
    props = [c for c in features.columns if c not in (*key, "geometry")]
    feature = F.struct(F.col("id").alias("_o"), F.to_json(F.struct(F.lit("Feature").alias("type"), F.try_parse_json(F.col("geometry")).alias("geometry"), F.struct(*props).alias("properties"))).alias("j"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(feature)), lambda f: f["j"]), ",")
    return features.groupBy(*key).agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), joined, F.lit("]}")).alias("document"))


def outputs(spark: SparkSession, folder: str) -> DataFrame:
    """(tile_id, region) of the result files that exist, from the listing alone."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.geojson").load(folder).select(stem(F.col("path")).alias("s"))
    return listed.select(F.regexp_replace("s", "_(core|donut)$", "").alias("tile_id"), F.regexp_extract("s", "_(core|donut)$", 1).alias("region")).filter("region <> ''")


def pending(tiles: DataFrame, done: DataFrame, donuts: bool) -> DataFrame:
    """Tiles (tile_id) whose expected outputs don't all exist: the core, and the donut if donuts are made."""
    expected = 2 if donuts else 1
    wanted = done if donuts else done.filter("region = 'core'")
    whole = wanted.groupBy("tile_id").agg(F.count_distinct("region").alias("n")).filter(F.col("n") >= expected)
    return tiles.join(whole, "tile_id", "left_anti")

