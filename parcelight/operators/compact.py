"""Consolidation of many small GeoJSON result files into few well-sized, sorted ones."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelight.runtime import Workspace, delete, exists, folder_bytes, rename

#: A group of copies is salted if it has more than one in so many rows; so there are fewer such groups than this.
HOT_SHARE = 1_000

#: ring: x and y of the corners in turn, from the least corner on, without the closing one; shape: as JSON, whatever of the geometry isn't one plain ring, and properties of another type than their column's; rest: as JSON, all other members of the feature, its properties and its geometry.
FEATURE_SCHEMA = "file_id long, feature_no int, tile_id string, region string, detection_id double, area_m2 double, score double, prompt string, crs string, ring array<double>, shape string, rest string"
_ARROW = pa.schema([("file_id", pa.int64()), ("feature_no", pa.int32()), ("tile_id", pa.string()), ("region", pa.string()), ("detection_id", pa.float64()), ("area_m2", pa.float64()), ("score", pa.float64()), ("prompt", pa.string()), ("crs", pa.string()), ("ring", pa.list_(pa.float64())), ("shape", pa.string()), ("rest", pa.string())])
_SAME = ["tile_id", "region", "detection_id", "area_m2", "score", "prompt", "ring", "shape"]
_COLUMNS = [f.split()[0] for f in FEATURE_SCHEMA.split(", ")]


def _no_constant(name: str):
    raise ValueError(f"{name} is not JSON")


def _text(value) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value, sort_keys=True)


def _number(value) -> float | None:
    """A JSON number by value; anything else has none."""
    return float(value) if value is not None and _is_number(value) else None


def _is_text(value) -> bool:
    return value is None or isinstance(value, str)


def _is_number(value) -> bool:
    return value is None or isinstance(value, float) or isinstance(value, int) and not isinstance(value, bool) and abs(value) <= 1 << 53


#: Properties that make a feature the same, and whether a value is what their column holds exactly.
_KINDS = {"tile_id": _is_text, "region": _is_text, "prompt": _is_text, "detection_id": _is_number, "area_m2": _is_number, "score": _is_number}


def canonical_ring(ring: list) -> list[float]:
    """Corners of a closed ring from the least one on, in the same direction, flat."""
    corners = [(float(p[0]), float(p[1])) for p in ring]
    if len(corners) > 1 and corners[0] == corners[-1]:
        corners.pop()
    low = min(corners)
    starts = [i for i, c in enumerate(corners) if c == low]
    best = min((corners[i:] + corners[:i] for i in starts)) if len(starts) > 1 else corners[starts[0] :] + corners[: starts[0]]
    return [v + 0.0 for c in best for v in c]


def _geometry(g) -> tuple[list[float] | None, str | None]:
    try:
        rings = g["coordinates"]
        if g["type"] == "Polygon" and len(rings) == 1 and rings[0] and all(len(p) == 2 for p in rings[0]):
            return canonical_ring(rings[0]), None
    except (TypeError, KeyError, ValueError):
        pass
    return None, None if g is None else json.dumps(g, sort_keys=True)


def features_of(body: str | None) -> list[tuple]:
    """(tile_id, region, detection_id, area_m2, score, prompt, crs, ring, shape, rest) of each feature of a body, in order.

    A null, empty or incomplete body, one with anything after its document and
    one that isn't an object with a list of features hold none. A feature that
    isn't an object counts as one without properties and geometry; it is kept
    in `rest`.
    """
    if not body:
        return []
    try:
        features = json.loads(body.removeprefix("\ufeff"), parse_constant=_no_constant)["features"]
    except (ValueError, TypeError, KeyError, RecursionError):
        return []
    out = []
    for feature in features if isinstance(features, list) else []:
        f = feature if isinstance(feature, dict) else {}
        p = f.get("properties")
        ring, shape = _geometry(f.get("geometry"))
        rest = _rest(feature, f, p, ring)
        p = p if isinstance(p, dict) else {}
        if odd := {k: v for k, v in p.items() if k in _KINDS and not _KINDS[k](v)}:
            shape = json.dumps([shape, odd], sort_keys=True)
        out.append((_text(p.get("tile_id")), _text(p.get("region")), _number(p.get("detection_id")), _number(p.get("area_m2")), _number(p.get("score")), _text(p.get("prompt")), _text(p.get("crs")), ring, shape, rest))
    return out


def _rest(feature, f: dict, p, ring: list[float] | None) -> str | None:
    """What no other column holds, as JSON: members of the feature, of its properties and of its plain geometry; null if there is nothing."""
    rest = {k: v for k, v in f.items() if k not in ("type", "properties", "geometry")}
    if f is not feature:
        rest["feature"] = feature
    if isinstance(p, dict):
        more = {k: v for k, v in p.items() if k not in _KINDS and (k != "crs" or not _is_text(v))}
    else:
        more = p
    if more:
        rest["properties"] = more
    if ring is not None and (more := {k: v for k, v in f["geometry"].items() if k not in ("type", "coordinates")}):
        rest["geometry"] = more
    return json.dumps(rest, sort_keys=True, ensure_ascii=False) if rest else None


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        columns: list[list] = [[] for _ in _ARROW]
        for file_id, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for no, feature in enumerate(features_of(body)):
                for column, v in zip(columns, (file_id, no, *feature)):
                    column.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _ARROW)], schema=_ARROW)


def _bytes(text: str) -> int:
    """Bytes of a setting such as 128MB or 16m."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)i?b?", text.strip().lower()).groups()
    return int(number) << (10 * " kmgt".index(unit or " "))


class CountMismatch(RuntimeError):
    pass


def compact(ws: Workspace, files: DataFrame, target: str, target_bytes: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Writes every feature of every readable body of `files` (file_id, body)
    exactly once to `target`, in files of about `target_bytes` (half of what the
    session reads in one task, if not given), sorted by (tile_id, region), and
    the repeats beside it to `<target>.repeats`; returns (features kept,
    repeats left out).

    Each body is parsed once into a loaded table. That is range-partitioned on
    the clustering keys with sampled boundaries. The keys go on after (tile_id,
    region) with the feature's content, so a hot tile spans many files, and
    equal features meet in one partition, where all but the first (smallest
    file_id, feature_no) are marked. A feature of which there are very many
    copies is salted; its first copy comes from a pre-aggregated count of all
    features. Kept and marked rows are written to a staging folder. Only if
    their numbers add up to what was loaded, in all and per file, does the
    staging folder take the place of `target`; else CountMismatch is raised and
    `target` stays as it was. If a run is stopped while folders are swapped, the
    whole result lies in `<target>.swap`, and the next run moves it first.

    Features are the same if tile_id, region, detection_id, area_m2, score and
    prompt (null equals null) and the rings from whichever corner agree; of
    these the first is kept with all its other members in `rest`. No files, no
    readable body: empty tables are written.
    """
    spark = ws.spark
    swap(spark, target)
    if target_bytes is None:
        target_bytes = _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes")) // 2
    parsed = files.select(F.col("file_id").cast("long"), "body").mapInArrow(_parse, FEATURE_SCHEMA)
    loaded, rows = ws.write_counting(parsed.withColumns({"same": F.xxhash64(*_SAME), "same_too": F.xxhash64(F.lit(1), *reversed(_SAME))}), "loaded", "true")
    parts = max(1, math.ceil(folder_bytes(spark, ws.path("loaded")) / target_bytes))
    first = F.min(F.struct("file_id", "feature_no"))
    hot = loaded.groupBy("same", "same_too").agg(F.count("*").alias("n"), first.alias("first")).filter(F.col("n") > max(2, rows // HOT_SHARE)).collect() if rows else []
    keys, is_hot, is_first = ["tile_id", "region", "same", "same_too"], F.lit(False), F.lit(False)
    if hot:  # fewer than HOT_SHARE
        is_hot = F.concat_ws(" ", "same", "same_too").isin([f"{r.same} {r.same_too}" for r in hot])
        is_first = F.concat_ws(" ", "file_id", "feature_no").isin([f"{r.first.file_id} {r.first.feature_no}" for r in hot])
        keys.append("salt")
        loaded = loaded.withColumn("salt", F.when(is_hot, F.pmod(F.xxhash64("file_id", "feature_no"), F.lit(parts))).otherwise(0))
    copies = Window.partitionBy(*keys).orderBy("file_id", "feature_no")
    marked = loaded.repartitionByRange(parts, *keys).withColumn("repeated", F.when(is_hot, ~is_first).otherwise(F.row_number().over(copies) > 1))
    staging = f"{target}.staging"
    delete(spark, staging)
    ordered = marked.select(*_COLUMNS, "repeated").sortWithinPartitions("repeated", "tile_id", "region", "file_id", "feature_no")
    ordered.write.mode("overwrite").partitionBy("repeated").parquet(staging)
    reconcile(loaded, spark.read.schema(f"{FEATURE_SCHEMA}, repeated boolean").parquet(staging))
    for part in ("false", "true"):  # no such row, no folder of them yet
        if not exists(spark, f"{staging}/repeated={part}"):
            spark.createDataFrame([], FEATURE_SCHEMA).write.parquet(f"{staging}/repeated={part}")
    rename(spark, staging, f"{target}.swap")
    swap(spark, target)
    ws.drop("loaded")
    table = lambda folder: spark.read.schema(FEATURE_SCHEMA).parquet(folder)
    return table(target), table(f"{target}.repeats")


def swap(spark: SparkSession, target: str) -> None:
    """Moves what lies in `<target>.swap`, a whole and reconciled result, into place; may be stopped anywhere and begun again."""
    if not exists(spark, f"{target}.swap"):
        return
    for part, folder in (("false", target), ("true", f"{target}.repeats")):
        new, old = f"{target}.swap/repeated={part}", f"{folder}.old"
        if exists(spark, new):
            if exists(spark, folder):
                delete(spark, old)
                rename(spark, folder, old)
            rename(spark, new, folder)
        delete(spark, old)
    delete(spark, f"{target}.swap")


def reconcile(loaded: DataFrame, written: DataFrame) -> None:
    """Raises CountMismatch unless both tables hold as many rows of each file."""
    count = lambda df, sign: df.groupBy("file_id").agg((F.count("*") * sign).alias("n"))
    off = count(loaded, 1).unionAll(count(written, -1)).groupBy("file_id").agg(F.sum("n").alias("n")).filter("n <> 0")
    wrong = off.agg(F.count("*").alias("files"), F.sum("n").alias("n")).first()
    if wrong.files:
        raise CountMismatch(f"{wrong.files} files have other numbers of features after writing than before ({wrong.n} rows fewer in all)")
