"""Configuration: global and module settings in YAML, prompts, and their check."""

from __future__ import annotations

from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys that a global configuration must have.
REQUIRED = ("project_name", "version", "default_module")
#: Thresholds that hold where a module's configuration has none.
FALLBACK = {"box_threshold": 0.40, "text_threshold": 0.30, "subtile_size_px": 800, "subtile_overlap_px": 128, "nms_iou": 0.5, "min_area_m2": 1.0, "max_area_m2": 50000.0, "max_tile_occupancy": 0.25, "max_aspect_ratio": 8.0, "merge_distance_m": 5.0}


class ConfigError(ValueError):
    pass


def load(path: str | Path) -> dict:
    """A global configuration; a missing file is an error, an empty one has no settings."""
    path = Path(path)
    if not path.exists():
        raise ConfigError(f"no configuration at {path}")
    return yaml.safe_load(path.read_text()) or {}


def load_module(modules: str | Path, name: str) -> dict:
    """A module's configuration; nothing if it has none."""
    path = Path(modules) / name / "config.yaml"
    return (yaml.safe_load(path.read_text()) or {}) if path.exists() else {}


def settings(config: dict, module: dict, **given) -> dict:
    """Fallbacks, then global, then the module's settings (key by key at the top level), then what is given and not None."""
    return FALLBACK | config | module | {k: v for k, v in given.items() if v is not None}


def modules(folder: str | Path) -> list[str]:
    """Names of the folders that are packages."""
    folder = Path(folder)
    return sorted(p.parent.name for p in folder.glob("*/__init__.py")) if folder.exists() else []


def check(config: dict, module_names: list[str]) -> list[str]:
    """What is wrong with a configuration; nothing if it is sound."""
    wrong = [f"missing key: {k}" for k in REQUIRED if k not in config]
    default = config.get("default_module")
    if default and default not in module_names:
        wrong.append(f"default module {default} is not one of {module_names}")
    ortho = config.get("ortho_path")
    if ortho and not Path(ortho).exists():
        wrong.append(f"no file at ortho_path {ortho}")
    return wrong


def parameters(pairs: list[str]) -> dict[str, str]:
    """`key=value` texts; what follows the first `=` is the value, without outer blanks."""
    out = {}
    for pair in pairs:
        key, sep, value = pair.partition("=")
        if not sep or not key.strip():
            raise ConfigError(f"not key=value: {pair}")
        out[key.strip()] = value.strip()
    return out


def prompts(spark: SparkSession, path: str) -> DataFrame:
    """(prompt) of each line that isn't blank."""
    return spark.read.text(path).select(F.trim("value").alias("prompt")).filter("prompt <> ''")


def as_table(spark: SparkSession, config: dict) -> DataFrame:
    """(key, value) of a configuration, nested keys joined by dots, values as YAML text."""

    def flat(node: dict, prefix: str = ""):
        for k, v in node.items():
            if isinstance(v, dict) and v:
                yield from flat(v, f"{prefix}{k}.")
            else:
                yield f"{prefix}{k}", yaml.safe_dump(v, default_flow_style=True).removesuffix("...\n").strip()

    return spark.createDataFrame(list(flat(config)), "key string, value string")
