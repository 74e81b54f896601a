"""Reports: delimited text, JSON, YAML, lines and fixed-width tables.

Tables are written by Spark in parallel. `single` writes one file with the
asked name, for reports whose size is checked to be small.
"""

from __future__ import annotations

import json
import os
from pathlib import Path

import yaml
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of which a single-file report may consist.
MOST_ROWS = 1_000_000


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_lines(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


def _bounded(df: DataFrame) -> list:
    rows = df.limit(MOST_ROWS + 1).collect()
    if len(rows) > MOST_ROWS:
        raise ValueError(f"more than {MOST_ROWS} rows; write a folder instead")
    return rows


def _replace(path: str, text: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    part = f"{path}.{os.getpid()}"
    Path(part).write_text(text)
    os.replace(part, path)


def single(df: DataFrame, path: str, kind: str = "csv") -> int:
    """Writes a report as one csv, json (a list of objects), yaml or lines file, whole or not at all; returns its number of rows."""
    rows = _bounded(df)
    if kind == "csv":
        import csv
        import io

        out = io.StringIO()
        writer = csv.writer(out)
        writer.writerow(df.columns)
        writer.writerows(rows)
        text = out.getvalue()
    elif kind == "json":
        text = json.dumps([r.asDict(True) for r in rows], indent=2, ensure_ascii=False, default=str)
    elif kind == "yaml":
        text = yaml.safe_dump([r.asDict(True) for r in rows], sort_keys=False, allow_unicode=True)
    elif kind == "lines":
        text = "".join(f"{r[0]}\n" for r in rows)
    else:
        raise ValueError(kind)
    _replace(path, text)
    return len(rows)


def write_metadata(record: dict, path: str) -> None:
    """A run's metadata as YAML, or as JSON if the name says so."""
    text = json.dumps(record, indent=2, ensure_ascii=False, default=str) if path.endswith(".json") else yaml.safe_dump(record, sort_keys=False, allow_unicode=True)
    _replace(path, text)


def console(df: DataFrame, widths: dict[str, int]) -> DataFrame:
    """One fixed-width line per row: numbers to the right, text to the left, long text cut."""
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in ("integer", "long", "double", "float", "short", "decimal")}
    cells = []
    for name, width in widths.items():
        text = F.coalesce(F.col(name).cast("string"), F.lit("N/A"))
        cells.append(F.lpad(text, width, " ") if name in numeric else F.rpad(text, width, " "))
    return df.select(F.concat_ws(" ", *cells).alias("line"))


def write_images(images: DataFrame, folder: str) -> DataFrame:
    """Writes content (binary) of images (file, content) under their names to a shared folder; returns (file, bytes). Null contents are left out."""
    import pandas as pd

    def run(batches):
        for b in batches:
            os.makedirs(folder, exist_ok=True)
            done = []
            for name, content in zip(b["file"], b["content"]):
                if content is not None:
                    part = os.path.join(folder, f".{name}.{os.getpid()}")
                    with open(part, "wb") as f:
                        f.write(content)
                    os.replace(part, os.path.join(folder, name))
                    done.append((name, len(content)))
            yield pd.DataFrame(done, columns=["file", "bytes"])

    return images.select("file", "content").mapInPandas(run, "file string, bytes long")
