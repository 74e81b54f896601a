from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelight.operators import patches, raster
from parcelight.plans import detectors
from parcelight.sources import geotiff


def test_labels_against_flood_fill():
    rng = np.random.default_rng(1)
    for _ in range(20):
        mask = rng.random((9, 12)) < 0.55
        want, n = np.zeros(mask.shape, int), 0
        for r, c in zip(*np.nonzero(mask)):
            if not want[r, c]:
                n += 1
                todo = [(r, c)]
                while todo:
                    y, x = todo.pop()
                    if 0 <= y < 9 and 0 <= x < 12 and mask[y, x] and not want[y, x]:
                        want[y, x] = n
                        todo += [(y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)]
        assert (raster.labelled(mask) == want).all()
    assert raster.blobs(np.zeros((3, 3), bool)) == []


def test_diagonal_pixels_are_apart():
    assert raster.blobs(np.eye(2, dtype=bool)) == [(0, 0, 1, 1, 1), (1, 1, 2, 2, 1)]
    assert raster.blobs(np.ones((2, 3), bool), 7) == []


def test_rescaling():
    assert (raster.to_rgb_u8(np.zeros((1, 2, 2), "uint16")) == 0).all()
    wide = np.array([[[0, 500], [1000, 250]]], "uint16")
    assert raster.to_rgb_u8(wide).shape == (3, 2, 2) and raster.to_rgb_u8(wide)[2].tolist() == [[0, 127], [255, 63]]
    small = np.arange(12, dtype="uint8").reshape(4, 3, 1)
    assert (raster.to_rgb_u8(small) == small[:3]).all()


def test_resampling():
    image = np.random.default_rng(0).integers(0, 255, (2, 8, 10)).astype("uint8")
    assert (raster.resized(image, 8, 10) == image).all()
    flat = np.full((1, 7, 9), 100, "uint8")
    assert (raster.resized(flat, 20, 3) == 100).all() and raster.resized(flat, 20, 3).shape == (1, 20, 3)


def test_clipping_by_a_ring_and_by_data():
    image = np.ones((4, 10, 10), "uint8")
    north_up = (1.0, 0.0, 100.0, 0.0, -1.0, 210.0)
    ring = [(102.0, 208.0), (105.0, 208.0), (105.0, 204.0), (102.0, 204.0), (102.0, 208.0)]
    window, moved = raster.clipped(image, north_up, ring)
    assert window.shape == (4, 4, 3) and moved[2] == 102.0 and moved[5] == 208.0 and window.all()
    assert raster.clipped(image, north_up, [(x + 50, y) for x, y in ring]) is None
    image[3] = 0
    assert raster.clipped(image, north_up, ring) is None
    image[3, 3, 3] = 1  # one pixel of twelve
    assert raster.clipped(image, north_up, ring) is not None
    assert raster.clipped(image, north_up, ring, 0.09) is None
    assert raster.clipped(image[:3], north_up, ring) is not None


@settings(max_examples=12, deadline=None)
@given(st.integers(1, 4), st.sampled_from(["uint8", "uint16", "int16", "float32", "float64"]), st.booleans())
def test_geotiff_round_trip(bands, dtype, deflate):
    data = (np.random.default_rng(bands).random((bands, 7, 5)) * 200).astype(dtype)
    made = geotiff.Raster(data, (0.25, 0.0, 340000.0, 0.0, -0.25, 4557000.0), 25831)
    got = geotiff.read(geotiff.write(made, deflate))
    assert (got.data == data).all() and got.data.dtype == data.dtype and got.transform == made.transform and got.srid == 25831
    assert (geotiff.read(geotiff.write(made), [bands]).data == data[-1:]).all()


@pytest.mark.parametrize("bad", [b"", b"nonsense", b"II*\0", b"II*\0\x08\0\0\0\x01\0"])
def test_unreadable_tiffs(bad):
    with pytest.raises(ValueError):
        geotiff.read(bad)


def test_chips_of_files(spark, tmp_path):
    (tmp_path / "a.tif").write_bytes(geotiff.write(geotiff.Raster(np.arange(24, dtype="uint8").reshape(2, 3, 4), (1, 0, 0, 0, -1, 3), 25831)))
    (tmp_path / "b.tif").write_bytes(b"broken")
    rows = {r.raster_id: r for r in geotiff.read_chips(spark, str(tmp_path)).collect()}
    assert rows["a.tif"].bands == 2 and rows["a.tif"].data == bytes(range(24)) and rows["a.tif"].error is None
    assert rows["b.tif"].data is None and "TIFF" in rows["b.tif"].error


def test_patches(spark):
    one = spark.createDataFrame([("r", 448, 448)], "raster string, w int, h int")
    starts = lambda df: sorted({r.px for r in df.collect()})
    shifted = patches.patch_grid(one, 192, 64)
    assert shifted.count() == 16 and starts(shifted) == [0, 128, 256]
    cut = patches.patch_grid(one, 192, 64, shifted=False)
    assert starts(cut) == [0, 128, 256, 384] and {r.pw for r in cut.filter("px = 384").collect()} == {64}
    edge = spark.createDataFrame([("r", 271, 63), ("none", 0, 5), ("null", None, 3)], "raster string, w int, h int")
    assert patches.patch_grid(edge, 288, 48, shifted=False, least=64).count() == 0
    assert patches.patch_grid(edge, 240, 0, shifted=False, least=32).count() == 1
    assert patches.tiled(one, 448, 64).count() == 1 and patches.tiled(one, 100, 0, enabled=False).count() == 1
    with pytest.raises(ValueError):
        patches.patch_grid(one, 64, 64)


@settings(max_examples=6, deadline=None)
@given(st.integers(1, 700), st.integers(1, 500), st.booleans())
def test_patches_cover_the_raster(spark, w, h, shifted):
    df = spark.createDataFrame([(1, w, h)], "raster int, w int, h int")
    covered = np.zeros((h, w), bool)
    for r in patches.patch_grid(df, 192, 64, shifted).collect():
        covered[r.py : r.py + r.ph, r.px : r.px + r.pw] = True
    assert covered.all()


def _failing():
    def detect(image, prompt):
        raise RuntimeError("no memory")

    return detect


def test_models_fail_alone(spark, monkeypatch):
    monkeypatch.setitem(detectors._FACTORIES, "failing", _failing)
    pixels = spark.createDataFrame([(1, 0, 0, 9), (1, 1, 1, 8), (2, 0, 0, 0)], "raster long, r int, c int, v int")
    chips = detectors.chips(pixels, 4, 4)
    table = {r.model: r for r in detectors.model_table(detectors.run_models(chips, ["gdino", "failing", "absent", "owlv2"], ["p"], ("owlv2",))).collect()}
    assert set(table) == {"gdino", "failing", "absent"}
    assert (table["gdino"].detections, table["gdino"].status) == ("2", "ok")
    assert (table["failing"].detections, table["failing"].errors) == ("N/A", 2) and table["absent"].status == "error"
    moved = detectors.detect(chips.selectExpr("*", "10 as px", "20 as py"), "gdino", ["p"], ("px", "py")).orderBy("x0").collect()
    assert (moved[0].x0, moved[0].y0) == (10.0, 20.0)
