from __future__ import annotations

import json

import numpy as np
import pytest
import yaml

from parcelight import cli
from parcelight.operators import raster
from parcelight.sources import geotiff


def image(kind, shift=0):
    """Two bright blocks and an L on a dark ground, the second block across the border of patches."""
    data = np.full((3, 96, 160), 20, kind)
    data[:, 10:22, 8:32] = 200
    data[:, 40:52, 56 + shift : 80 + shift] = 220
    data[:, 70:90, 120:126] = 210
    data[:, 84:90, 120:144] = 210
    return data * (200 if kind == "uint16" else 1)


@pytest.fixture
def rasters(tmp_path):
    folder = tmp_path / "rasters"
    folder.mkdir()
    for name, kind in (("T1", "uint8"), ("T2", "uint16")):
        (folder / f"{name}.tif").write_bytes(geotiff.write(geotiff.Raster(image(kind), (0.25, 0.0, 340000.0, 0.0, -0.25, 4557000.0), 25831)))
    (folder / "T3.tif").write_bytes(geotiff.write(geotiff.Raster(np.zeros((3, 32, 32), "uint8"), (0.25, 0.0, 340000.0, 0.0, -0.25, 4557000.0), 25831)))
    (folder / "T4.tif").write_bytes(b"no raster")
    return folder


def test_tiles_from_pixels_to_geojson_and_resume(spark, rasters, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "session", lambda: spark)
    out = tmp_path / "out"
    argv = ["run", "--rasters", str(rasters), "--output", str(out), "--patch", "64", "--overlap", "16"]
    cli.main(argv)
    record = yaml.safe_load((out / "run.yaml").read_text())
    assert (record["rasters"], record["skipped"], record["errors"], record["files"]) == (4, 0, 1, 3)
    assert record["first_errors"][0].startswith("T4: ")
    assert sorted(p.name for p in out.glob("*.geojson")) == ["T1_core.geojson", "T2_core.geojson", "T3_core.geojson"]
    for tile in ("T1", "T2"):  # 8 and 16 bits give the same
        features = json.loads((out / f"{tile}_core.geojson").read_text())["features"]
        bounds = sorted((min(p[0] for p in f["geometry"]["coordinates"][0]), max(p[1] for p in f["geometry"]["coordinates"][0]), f["properties"]["area_m2"]) for f in features)
        assert (340002.0, 4556997.5, 18.0) in bounds  # columns 8 to 32, rows 10 to 22
        assert (340014.0, 4556990.0, 18.0) in bounds  # whole in one patch, its parts in others are suppressed or apart
        assert any(abs(b[0] - 340030.0) < 1e-6 and abs(b[1] - 4556982.5) < 1e-6 and b[2] == 14.25 for b in bounds)  # the L, not its box
    assert json.loads((out / "T3_core.geojson").read_text())["features"] == []
    (out / "T2_core.geojson").unlink()
    cli.main(argv)
    record = yaml.safe_load((out / "run.yaml").read_text())
    assert (record["skipped"], record["files"]) == (2, 1)
    assert (out / "T2_core.geojson").exists()


def test_detect_keeps_the_pixel_type(spark, rasters, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "session", lambda: spark)
    cli.main(["detect", "--rasters", str(rasters), "--output", str(tmp_path / "runs")])
    runs = spark.read.parquet(str(tmp_path / "runs"))
    assert runs.filter("error is not null").count() == 0
    assert runs.filter("model = 'langsam'").count() == 6
    assert "T4.tif" in capsys.readouterr().err


def test_outlines():
    mask = np.zeros((5, 6), bool)
    mask[1:4, 1:4] = True
    assert raster.outline(mask) == [[(1, 1), (4, 1), (4, 4), (1, 4), (1, 1)]]
    mask[2, 2] = False
    assert sorted(map(len, raster.outline(mask))) == [5, 5]
    corner = np.array([[1, 0], [0, 1]], bool)
    assert sorted(map(len, raster.outline(corner))) == [5, 5]
    rng = np.random.default_rng(1)
    for _ in range(20):
        m = rng.random((7, 9)) < 0.5
        rings = raster.outline(m)
        signed = sum(p[0] * q[1] - q[0] * p[1] for r in rings for p, q in zip(r, r[1:])) / 2
        assert signed == m.sum()
