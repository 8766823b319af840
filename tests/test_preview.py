"""Overviews as a source, previews as lines, exact percentiles."""

import json

import numpy as np
import pytest
from packages import ENTRY, FILTERS, ITEM, SESSION, write_package
from pyspark.sql import functions as F

from rasterloom.operators import preview, quality
from rasterloom.operators.quality import Thresholds
from rasterloom.plans import radiance
from rasterloom.sinks import tiff as sink
from rasterloom.sources import tiff


def table_of(spark, values, band="R"):
    return spark.createDataFrame([(band, i, *values.shape, r.tolist()) for i, r in enumerate(values)], "band string, line int, height int, width int, radiance array<float>")


def raster(spark, folder, values, **more):
    (path,) = [r["path"] for r in sink.write_tiff(table_of(spark, values), str(folder), options=sink.TiffOptions(**more)).collect()]
    return path


def test_an_overview_is_read_instead_of_the_image(spark, tmp_path, monkeypatch):
    values = np.random.default_rng(0).normal(size=(1100, 700)).astype(np.float32)
    path = raster(spark, tmp_path, values)
    sizes = tiff.images_of(path)
    assert sizes == [(n, -(-1100 // f), -(-700 // f)) for n, f in enumerate((1, 2, 4, 8, 16, 32))]
    assert [r.asDict() for r in tiff.read_images(spark.createDataFrame([(path,)], "path string")).first()["images"]][1] == {"directory": 1, "height": 550, "width": 350}
    assert tiff.choose_image(sizes, 1100, 700)[0] == 0 and tiff.choose_image(sizes, 275, 100)[0] == 2 and tiff.choose_image(sizes, 276, 1)[0] == 1
    assert tiff.choose_image(sizes, 5000, 5000)[0] == 0
    found = tiff.read_tiff(spark, [path], real=True, directory=2, window_lines=100)
    assert found.rdd.getNumPartitions() == 3
    got = np.array([r["values"] for r in found.orderBy("line").collect()], dtype=np.float32)
    np.testing.assert_array_equal(got, sink.average_blocks(values, 4))
    # no byte of a full tile is touched
    with open(path, "rb") as file:
        header = tiff.read_header(file)
        file.seek(0)
        data = bytearray(file.read())
    for at, size in zip(header.offsets, header.sizes, strict=True):
        data[at : at + size] = bytes(size)
    (tmp_path / "blank.tif").write_bytes(bytes(data))
    again = tiff.read_tiff(spark, [str(tmp_path / "blank.tif")], real=True, directory=2)
    np.testing.assert_array_equal(np.array([r["values"] for r in again.orderBy("line").collect()], dtype=np.float32), got)


def test_a_file_without_overviews(spark, tmp_path):
    path = raster(spark, tmp_path, np.ones((40, 30), np.float32), overviews=False)
    assert tiff.images_of(path) == [(0, 40, 30)]
    with pytest.raises(Exception, match="no such image"):
        tiff.read_tiff(spark, [path], directory=1, real=True).count()


@pytest.mark.parametrize("shape", [(7, 5, 7, 5), (50, 33, 20, 10), (130, 9, 13, 1), (9, 40, 1, 40)])
def test_decimated_lines_equal_decimated_pixels(spark, shape):
    height, width, out_height, out_width = shape
    values = np.random.default_rng(1).normal(size=(height, width)).astype(np.float32)
    values[2:5, 1:3] = np.nan
    values[0, 0] = np.inf
    both = table_of(spark, values).unionByName(table_of(spark, values[::-1], "G"))
    pixels = both.select("band", "line", F.posexplode("radiance").alias("col", "radiance"))
    want = {(r["band"], r["line"], r["col"]): r["radiance"] for r in preview.decimate(pixels, ["band"], F.lit(height), F.lit(width), F.lit(out_height), F.lit(out_width)).collect()}
    rows = preview.decimate_lines(both.repartition(3), ["band"], height, width, out_height, out_width, value="radiance").collect()
    got = {(r["band"], r["line"], c): v for r in rows for c, v in enumerate(r["values"])}
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-12, nan_ok=True)


CASES = {
    "normal": np.random.default_rng(2).normal(size=5000),
    "skewed": np.exp(np.random.default_rng(3).normal(size=4000) * 40),
    "ties": np.repeat([1.0, 2.0, 3.0], [10, 4000, 3]),
    "one": np.array([4.5]),
    "two": np.array([-1.0, 1.0]),
    "huge": np.array([-1.7e308, 1.7e308, 0.0, 5e-324] * 700),
    "none": np.array([]),
}


@pytest.mark.parametrize("small", [1, 1024])
def test_percentiles_equal_a_sort(spark, monkeypatch, small):
    monkeypatch.setattr(preview, "SORTED", small)
    rows = [(k, float(v)) for k, values in CASES.items() for v in values] + [(k, None) for k in CASES]
    wanted = (0.0, 2.0, 37.3, 50.0, 98.0, 100.0)
    table = spark.createDataFrame(rows, "k string, v double").repartition(5)
    found = {r["k"]: r["found"] for r in preview.percentiles(table, ["k"], wanted, F.col("v")).collect()}
    exact = {r["k"]: r["p"] for r in table.groupBy("k").agg(F.percentile("v", [p / 100 for p in wanted]).alias("p")).collect()}
    assert found.keys() == CASES.keys() and found["none"] == [None] * 6
    for k in CASES:
        if k != "none":
            assert found[k] == exact[k], k
    assert preview.percentiles(table.where("false"), ["k"], wanted, F.col("v")).count() == 0


def test_stretched_lines_equal_stretched_pixels(spark):
    values = np.random.default_rng(4).normal(size=(30, 20))
    values[3, 4], values[5, 6] = np.nan, np.inf
    lines = spark.createDataFrame([("a", i, r.tolist()) for i, r in enumerate(values)] + [("flat", 0, [2.0, 2.0]), ("empty", 0, [float("nan")] * 2)], "k string, line int, values array<double>")
    got = {(r["k"], r["line"]): list(r["data"]) for r in preview.stretch_lines(lines, ["k"]).collect()}
    pixels = lines.select("k", "line", F.posexplode("values").alias("col", "radiance"))
    want = preview.stretched(pixels, ["k"]).select("k", "line", "col", preview.to_byte(F.col("level")).alias("b")).collect()
    for r in want:
        if not np.isinf(values[5, 6]) or (r["k"], r["line"], r["col"]) != ("a", 5, 6):
            assert abs(got[r["k"], r["line"]][r["col"]] - r["b"]) <= 1, r


def test_quicklook_of_a_product(spark, tmp_path):
    names = ("R", "G", "B")
    counts = {b: (np.arange(64 * 48).reshape(64, 48) * (i + 3) % 1000 + 1).astype("<u2") for i, b in enumerate(names)}
    session = SESSION | {"ImagerConfiguration": SESSION["ImagerConfiguration"] | {"SpectralBands": 3, "BandSetup": [4] * 3, "BandStartRow": [0] * 3, "BandCWL": [665.0, 560.0, 490.0]}}
    entries = [ENTRY | {"band": b, "coefficients": [[1.0] * 48, [10.0] * 48, [0.5] * 48]} for b in names]
    item = ITEM | {"assets": {b: {"href": f"{b}.tif", "type": "image/tiff"} for b in names}}
    folder = write_package(tmp_path / "p", item=item, session=session, entries=entries, filters=[{"name": b, "id": i} for i, b in enumerate(names)], rasters=counts)
    options = radiance.Options(quicklook_size=16)
    product = radiance.run(spark, folder, str(tmp_path / "out"), options)
    image = radiance.quicklook(spark, {b: product["bands"][b] for b in names}, options)
    assert image.shape == (16, 12, 3) and image.min() == 0 and image.max() == 255
    assert (tmp_path / "out" / "quicklook.png").stat().st_size > 100
    assert json.loads((tmp_path / "out" / "qa_report.json").read_text())
    full = radiance.quicklook(spark, {b: product["bands"][b] for b in names}, radiance.Options(quicklook_size=64))
    for k, b in enumerate(names):
        (_, tall, wide), *_ = tiff.images_of(product["bands"][b])
        with open(product["bands"][b], "rb") as f:
            h = tiff.read_header(f)
            values = tiff.read_lines(f, h, 0, tall).astype(np.float64)
        low, high = np.percentile(values, [2, 98])
        np.testing.assert_array_equal(full[:, :, k], (np.clip((values - low) / (high - low), 0, 1) * 255).astype(np.uint8))
    with pytest.raises(KeyError, match="missing bands"):
        radiance.quicklook(spark, {"R": product["bands"]["R"]})


def test_quality_of_lines_equals_that_of_pixels(spark):
    rng = np.random.default_rng(9)
    bands = {"plain": rng.normal(40, 20, (60, 30)), "flat": np.full((5, 4), 3.7), "none": np.full((3, 3), np.nan), "odd": rng.normal(0, 1, (9, 7)), "one": np.array([[5.0]])}
    bands["odd"][0, :3] = [np.nan, np.inf, -np.inf]
    rows = [("s", k, i, r.astype(np.float32).tolist(), [int(x) for x in np.nan_to_num(r, posinf=0, neginf=0)]) for k, v in bands.items() for i, r in enumerate(v)]
    lines = spark.createDataFrame(rows, "scene string, band string, line int, radiance array<float>, dn array<int>").repartition(7)
    for given, thresholds in ((lines, Thresholds(30)), (lines.drop("dn"), Thresholds(30)), (lines, Thresholds())):
        arrays = [c for c in ("dn", "radiance") if c in given.columns]
        pixels = given.select("scene", "band", F.inline(F.arrays_zip(*arrays)))
        want = {r["band"]: r.asDict() for r in quality.band_report(pixels, ["scene", "band"], thresholds).collect()}
        got = {r["band"]: r.asDict() for r in quality.line_report(given, ["scene", "band"], thresholds).collect()}
        assert got.keys() == want.keys() == bands.keys()
        for band in bands:
            assert got[band].keys() == want[band].keys()
            for name, value in want[band].items():
                assert got[band][name] == (pytest.approx(value, rel=1e-12, abs=1e-12, nan_ok=True) if isinstance(value, float) else value), (band, name)
    assert quality.line_report(lines.where("false"), ["band"]).count() == 0
