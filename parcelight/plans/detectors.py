"""Detectors as plug-ins: functions from an image and a prompt to scored boxes, run on chips in Arrow batches.

The models here are small deterministic ones on pixel values; a neural model is
plugged in with `register` and loaded once per worker process.
"""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelight.operators.raster import blobs

#: An image (bands, h, w) and a prompt give boxes (x0, y0, x1, y1, score) in pixels.
Detector = Callable[[np.ndarray, str], list[tuple[float, float, float, float, float]]]
_FACTORIES: dict[str, Callable[[], Detector] | str] = {}


def register(name: str, factory: Callable[[], Detector] | str) -> None:
    """Adds a model: a function that loads it, or where to import one from, as `module:function`."""
    _FACTORIES[name] = factory


@functools.lru_cache(maxsize=8)
def _loaded(name: str, factory: Callable[[], Detector] | str) -> Detector:
    if isinstance(factory, str):
        module, _, function = factory.partition(":")
        factory = getattr(importlib.import_module(module), function)
    return factory()


def _threshold(share: float) -> Callable[[], Detector]:
    """Blobs above a share of the greatest value, scored by their mean."""

    def detect(image: np.ndarray, prompt: str):
        band = image[0].astype("float64")
        most = band.max(initial=0.0)
        if most <= 0:
            return []
        return [(x0, y0, x1, y1, round(float(band[y0:y1, x0:x1].mean() / most), 6)) for x0, y0, x1, y1, _ in blobs(band > share * most)]

    return lambda: detect


def _segmenting(threshold: float = 0.5, least: int = 2) -> Callable[[], Detector]:
    """Blobs where the sigmoid of a logit grid is above a threshold; every score is 1."""

    def detect(image: np.ndarray, prompt: str):
        band = image[0].astype("float64")
        logits = (band - band.mean()) / (band.std() + 1e-9)
        return [(x0, y0, x1, y1, 1.0) for x0, y0, x1, y1, _ in blobs(1 / (1 + np.exp(-logits)) > threshold, least)]

    return lambda: detect


def _union_of_masks(shares: tuple[float, ...]) -> Callable[[], Detector]:
    """Blobs of the union of several masks; a blob's score is the greatest of the masks in it."""

    def detect(image: np.ndarray, prompt: str):
        band = image[0].astype("float64")
        most = band.max(initial=0.0)
        if most <= 0:
            return []
        masks = [band > s * most for s in shares]
        out = []
        for x0, y0, x1, y1, _ in blobs(np.logical_or.reduce(masks)):
            out.append((x0, y0, x1, y1, max(s for s, m in zip(shares, masks) if m[y0:y1, x0:x1].any())))
        return out

    return lambda: detect


for _name, _factory in (("langsam", _union_of_masks((0.55, 0.75))), ("gdino", _threshold(0.6)), ("owlv2", _threshold(0.7)), ("clipseg", _segmenting())):
    register(_name, _factory)


def models() -> list[str]:
    return sorted(_FACTORIES)


def chips(pixels: DataFrame, width: int, height: int) -> DataFrame:
    """(raster, width, height, data) of pixel rows (raster, r, c, v); a missing pixel is 0, data is int32, by rows."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        data = np.zeros((height, width), "<i4")
        data[pdf["r"].to_numpy(), pdf["c"].to_numpy()] = pdf["v"].to_numpy()
        return pd.DataFrame({"raster": pdf["raster"].iloc[:1], "width": [width], "height": [height], "data": [data.tobytes()]})

    return pixels.select("raster", "r", "c", "v").groupBy("raster").applyInPandas(run, "raster long, width int, height int, data binary")


def detect(rows: DataFrame, model: str, prompts: list[str], offset: tuple[str, str] | None = None) -> DataFrame:
    """Detections of a model on chips: (raster, model, prompt, no, x0, y0, x1, y1, score, error).

    `offset` names columns with the chip's place in its raster, which is added
    to the boxes. Pixels are int32, or as a column `dtype` says. A chip on which the model fails gives one row with an error
    and no box; the others go on. A chip without detections has no row.
    """
    factory = _FACTORIES.get(model)
    moved = [*offset] if offset else []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for row in b.itertuples(index=False):
                dx, dy = (getattr(row, moved[0]), getattr(row, moved[1])) if moved else (0, 0)
                for prompt in prompts:
                    try:
                        if factory is None:
                            raise LookupError(f"no model {model}")
                        image = np.frombuffer(row.data, getattr(row, "dtype", "<i4")).reshape(-1, row.height, row.width)
                        found = _loaded(model, factory)(image, prompt)
                        out += [(row.raster, model, prompt, i, x0 + dx, y0 + dy, x1 + dx, y1 + dy, score, None) for i, (x0, y0, x1, y1, score) in enumerate(found)]
                    except Exception as e:
                        out.append((row.raster, model, prompt, None, None, None, None, None, None, f"{type(e).__name__}: {e}"))
            frame = pd.DataFrame(out, columns=["raster", "model", "prompt", "no", "x0", "y0", "x1", "y1", "score", "error"])
            yield frame.astype({"no": "Int32", **{c: "float64" for c in ("x0", "y0", "x1", "y1", "score")}})

    kinds = ["dtype"] if "dtype" in rows.columns else []
    return rows.select("raster", "width", "height", "data", *kinds, *moved).mapInPandas(run, "raster long, model string, prompt string, no int, x0 double, y0 double, x1 double, y1 double, score double, error string")


def run_models(rows: DataFrame, names: list[str], prompts: list[str], skip: tuple[str, ...] = ()) -> DataFrame:
    """Detections of several models on the same chips."""
    out = None
    for name in names:
        if name not in skip:
            found = detect(rows, name, prompts)
            out = found if out is None else out.unionAll(found)
    if out is None:
        raise ValueError("every model is skipped")
    return out


def model_table(runs: DataFrame) -> DataFrame:
    """(model, detections, errors, status) per model; detections are N/A if every chip failed."""
    counts = runs.groupBy("model").agg(F.count("no").alias("n"), F.count("error").alias("errors"))
    failed = (F.col("n") == 0) & (F.col("errors") > 0)
    return counts.select("model", F.when(failed, "N/A").otherwise(F.col("n").cast("string")).alias("detections"), "errors", F.when(failed, "error").otherwise("ok").alias("status"))


def versions(spark: SparkSession, packages: tuple[str, ...] = ("numpy", "pandas", "pyarrow", "onnxruntime", "torch")) -> DataFrame:
    """(package, version) as a worker sees them; null if it isn't installed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from importlib import metadata

        for b in batches:
            found = []
            for name in b["package"]:
                try:
                    found.append(metadata.version(name))
                except metadata.PackageNotFoundError:
                    found.append(None)
            yield b.assign(version=found)

    return spark.createDataFrame([(p,) for p in packages], "package string").coalesce(1).mapInPandas(run, "package string, version string")
