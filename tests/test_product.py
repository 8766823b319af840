"""Rasters, products, command line and streams."""

import io
import json
import os
import struct
import zlib

import numpy as np
import pytest
from packages import COUNTS, ENTRY, FILTERS, ITEM, RADIANCE, SESSION, strip_tiff, write_package
from pyspark.sql import functions as F

from rasterloom import cli
from rasterloom.operators.quality import Thresholds
from rasterloom.plans import radiance
from rasterloom.sinks import catalogue, png
from rasterloom.sinks import tiff as sink
from rasterloom.sources import tiff
from rasterloom.streaming import intake


def image(path, level=0):
    with open(path, "rb") as f:
        h = tiff.read_header(f, level)
        return h, tiff.read_lines(f, h, 0, h.height)


def lines_of(spark, values, band="R"):
    rows = [(band, i, values.shape[0], values.shape[1], [float(x) for x in r]) for i, r in enumerate(values)]
    return spark.createDataFrame(rows, "band string, line int, height int, width int, radiance array<float>")


@pytest.mark.parametrize("predictor", [1, 2, 3])
def test_predictors_round_trip(predictor):
    rng = np.random.default_rng(predictor)
    kinds = ["<f4"] if predictor == 3 else ["<u2", "<u1", "<i4"]
    for kind in kinds:
        values = rng.integers(0, 200, (5, 7)).astype(kind)
        data = tiff.apply_predictor(values, predictor)
        assert (tiff.undo_predictor(data, 5, 7, np.dtype(kind), predictor) == values).all()


def test_strips_are_read(tmp_path):
    (tmp_path / "a.tif").write_bytes(strip_tiff(COUNTS, 0))
    h, values = image(tmp_path / "a.tif")
    assert (h.nodata, h.dtype, h.block_height) == (0.0, "u2", 2) and (values == COUNTS).all()
    with open(tmp_path / "a.tif", "rb") as f:
        assert (tiff.read_lines(f, h, 1, 3) == COUNTS[1:3]).all()
    with pytest.raises(ValueError):
        tiff.read_header(io.BytesIO(b"no tiff at all...."))


@pytest.mark.parametrize("compress", ["deflate", "none"])
def test_tiled_file_with_overviews(spark, tmp_path, compress):
    rng = np.random.default_rng(0)
    values = rng.normal(size=(1100, 700)).astype(np.float32)
    values[5:40, 3:90] = np.nan
    options = sink.TiffOptions(compress=compress)
    (path,) = [r["path"] for r in sink.write_tiff(lines_of(spark, values), str(tmp_path / "out"), options=options).collect()]
    h, full = image(path)
    assert (h.block_width, h.block_height, h.predictor) == (512, 512, 3 if compress == "deflate" else 1) and np.isnan(h.nodata)
    np.testing.assert_array_equal(full, values)
    for level, factor in enumerate(options.factors, start=1):
        _, small = image(path, level)
        np.testing.assert_array_equal(small, sink.average_blocks(values, factor))
    found = tiff.read_tiff(spark, [path], window_lines=512, real=True)
    assert found.count() == 1100
    assert found.where("line >= 600 and line < 610").count() == 10


def test_big_layout_is_readable():
    one = sink.Directory(10, 10, 16, 16, [99], [5], False)
    small, big = one.encode(8, True, False), one.encode(16, True, True)
    head = struct.pack("<2sHHHQ", b"II", 43, 8, 0, 16)
    h = tiff.read_header(io.BytesIO(head + big))
    assert (h.width, h.offsets, h.sizes) == (10, (99,), (5,))
    assert len(big) > len(small)


def test_averages_ignore_invalid_pixels():
    values = np.array([[1, 2, np.nan], [3, np.inf, np.nan]], dtype=np.float32)
    np.testing.assert_array_equal(sink.average_blocks(values, 2), np.array([[2, np.nan]], dtype=np.float32))


def test_png(tmp_path):
    pixels = np.arange(24, dtype=np.uint8).reshape(2, 4, 3)
    data = png.encode_png(pixels)
    size = struct.unpack(">II", data[16:24])
    start = data.index(b"IDAT") + 4
    raw = zlib.decompress(data[start : start + struct.unpack(">I", data[start - 8 : start - 4])[0]])
    assert size == (4, 2) and raw == b"\0" + pixels[0].tobytes() + b"\0" + pixels[1].tobytes()


def three_bands(folder):
    session = json.loads(json.dumps(SESSION))
    session["ImagerConfiguration"] |= {"BandSetup": [4, 4, 4], "BandStartRow": [0, 0, 0], "BandCWL": [665.0, 560.0, 490.0]}
    item = dict(ITEM, assets={b: {"href": f"{b}.tif", "type": "image/tiff"} for b in "BGR"})
    return write_package(
        folder, item=item, session=session, entries=[dict(ENTRY, band=b) for b in "RGB"],
        filters=[*FILTERS, {"name": "G", "id": 1}, {"name": "B", "id": 2}], rasters={b: COUNTS for b in "RGB"},
    )


def test_whole_product(spark, tmp_path):
    product = radiance.run(spark, three_bands(tmp_path / "p"), str(tmp_path / "out"), radiance.Options(thresholds=Thresholds(saturation_dn=400)), created="2020-01-01T00:00:00Z")
    report = json.loads((tmp_path / "out" / "qa_report.json").read_text())
    assert list(report["bands"]) == ["R", "G", "B"] and not report["passed"]
    assert report["bands"]["R"]["flags"] == ["saturation"] and report["bands"]["R"]["saturated"] == 1
    assert report["bands"]["R"]["mean"] == pytest.approx(RADIANCE.mean()) and report["bands"]["R"]["std"] == pytest.approx(RADIANCE.std())
    for b in "RGB":
        np.testing.assert_array_equal(image(tmp_path / "out" / f"{b}.tif")[1], RADIANCE)
    item = json.loads((tmp_path / "out" / "SCENE_7_L1B.json").read_text())
    assert item["assets"]["G"]["eo:bands"] == [{"name": "G", "center_wavelength": 0.56}] and item["properties"]["created"] == "2020-01-01T00:00:00Z"
    assert item["assets"]["thumbnail"]["href"] == "quicklook.png" and item["assets"]["qa"]["href"] == "qa_report.json"
    assert (tmp_path / "out" / "quicklook.png").read_bytes()[:8] == b"\x89PNG\r\n\x1a\n"
    assert product["provenance"]["calibration_uuids"] == dict.fromkeys("RGB", "first")
    assert product["provenance"]["processing"]["temperature_model"] == "per_line_timestamped_interpolation"
    again = radiance.validate(spark, product)
    assert again["passed"] and "saturated" not in again["bands"]["R"]


def test_command_line(spark, tmp_path, capsys):
    package = three_bands(tmp_path / "p")
    assert cli.main(["-i", package, "-o", str(tmp_path / "a"), "-b", "R", "--no-quicklook", "--no-stac", "-q"]) == 0
    assert (tmp_path / "a" / "R.tif").exists() and not (tmp_path / "a" / "quicklook.png").exists()
    assert "quality passed" in capsys.readouterr().out
    assert cli.main(["-i", package, "-o", str(tmp_path / "b"), "--saturation-dn", "400", "-q"]) == 1
    with pytest.raises(KeyError):
        cli.main(["-i", package, "-o", str(tmp_path / "c"), "-b", "NIR", "-q"])


def test_nan_in_report_is_bare():
    row = {"band": "R", "pixels": 1, "valid": 0, "mean": float("nan"), "flags": ["all_invalid"], "passed": False}
    assert "NaN" in catalogue.to_json(catalogue.quality_document([row], "s", "L1B"))
    assert catalogue.quality_document([], "s", "L1B")["passed"]


def test_streaming_quality(spark, tmp_path):
    lines_of(spark, RADIANCE).repartition(2).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("band string, line int, height int, width int, radiance array<float>").parquet(str(tmp_path / "in"))
    q = intake.streaming_quality(stream, ["band"]).writeStream.outputMode("complete").format("memory").queryName("quality_now").start()
    q.processAllAvailable()
    q.stop()
    (row,) = spark.sql("select * from quality_now").collect()
    assert (row["pixels"], row["passed"]) == (12, True) and row["mean"] == pytest.approx(RADIANCE.mean())


def test_windowed_streaming_quality(spark, tmp_path):
    timed = lines_of(spark, RADIANCE).withColumn("at", F.timestamp_seconds(F.col("line") * 60))
    timed.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(timed.schema).parquet(str(tmp_path / "in"))
    q = intake.windowed_quality(stream, "at", "2 minutes", "1 minute", ["band"]).writeStream.outputMode("append").format("memory").queryName("quality_windows").start()
    q.processAllAvailable()
    q.stop()
    assert [r["pixels"] for r in spark.sql("select * from quality_windows order by window").collect()] == [6]


def test_package_intake(spark, tmp_path):
    for i in range(2):
        write_package(tmp_path / "in" / f"p{i}")
    taken = []
    for _ in range(2):  # the second run finds nothing new
        intake.watch_packages(spark, str(tmp_path / "in"), lambda s, folders: taken.extend(folders), str(tmp_path / "state")).awaitTermination()
    assert sorted(os.path.basename(p) for p in taken) == ["p0", "p1"]
