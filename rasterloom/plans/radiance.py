"""From packages of raw counts to radiance products.

`radiance_lines` is one lazy plan over any number of packages. `run` writes
the product of one package: radiance as Parquet by band, rasters, the quality
report, a preview and the catalogue item.
"""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import __version__
from ..operators import calibration, interpolation, preview, quality
from ..sinks import catalogue, png
from ..sinks.tiff import TiffOptions, write_tiff
from ..sources import package as source
from ..sources import tiff as source_tiff
from ..sources.tiff import read_tiff

log = logging.getLogger(__name__)
LEVEL, UNITS = "L1B", "W / (m2 sr um)"
RGB = ("R", "G", "B")


@dataclass(frozen=True)
class Options:
    bands: tuple[str, ...] | None = None
    window_lines: int = 2048
    thresholds: quality.Thresholds = quality.Thresholds()
    model: str = "linear_thermal"
    nodata: float = float("nan")
    nearest_calibration: bool = False
    tiff: TiffOptions = TiffOptions()
    quicklook: bool = True
    quicklook_size: int = 2048
    stretch: tuple[float, float] = (2.0, 98.0)
    item: bool = True


def band_contexts(packages: source.Packages, options: Options = Options()) -> DataFrame:
    """(package, band, ...): what calibrating a line of each band needs, one row per band."""
    look_up = calibration.look_up_nearest if options.nearest_calibration else calibration.look_up
    bands = packages.bands if not options.bands else packages.bands.where(F.col("band").isin(*options.bands))
    entries = packages.entries.drop("geometric")
    found = look_up(bands.drop("ord"), entries, ["package"]).drop("ord", "uuid")
    samples = source.band_positions(packages.samples, bands)
    return found.join(samples, ["package", "band"], "left").withColumn("samples", interpolation.require_samples(F.col("samples")))


def count_lines(spark: SparkSession, contexts: DataFrame, paths: list[str], options: Options = Options(), heights: list[int] | None = None) -> DataFrame:
    """Lines of counts with their band's context and temperature `t`.

    The temperature is worked out before the join with the coefficients, else
    Spark would fold it into the per-pixel expression and repeat it there.
    """
    lines = read_tiff(spark, paths, window_lines=options.window_lines, heights=heights).withColumnRenamed("values", "dn")
    timed = lines.join(contexts.select("path", "samples"), "path")
    timed = timed.select("path", "line", "dn", interpolation.by_array(F.col("line"), F.col("samples")).alias("t"))
    return calibration.check_lines(timed.join(contexts.drop("samples"), "path"))


def radiance_lines(spark: SparkSession, contexts: DataFrame, paths: list[str], options: Options = Options(), heights: list[int] | None = None) -> DataFrame:
    """(package, band, line, height, width, radiance), arrays over columns, and `dn` if saturation is checked. With the rasters' heights the driver opens none of them."""
    lines = count_lines(spark, contexts, paths, options, heights)
    counts = ["dn"] if options.thresholds.saturation_dn is not None else []  # only saturation asks for them
    value = calibration.calibrate_lines(lines, model=options.model, fill=options.nodata, keep_dn=bool(counts))
    return value.select("package", "band", "line", "height", "width", *counts, "radiance")


def pixel_report(lines: DataFrame, keys: list[str], thresholds: quality.Thresholds) -> DataFrame:
    """Quality of radiance lines, counts included where they are there."""
    return quality.line_report(lines, keys, thresholds)


def quicklook(spark: SparkSession, paths: dict[str, str], options: Options = Options()) -> np.ndarray:
    """The RGB preview of rasters by band, as bytes. An error if a band is missing.

    The smallest overview that is still larger than the preview is read, as
    lines; no pixel becomes a row.
    """
    if missing := [b for b in RGB if b not in paths]:
        raise KeyError(f"missing bands for the quicklook: {missing}")
    first = source_tiff.images_of(paths[RGB[0]])
    _, height, width = first[0]
    out_height, out_width = preview.output_shape(height, width, options.quicklook_size)
    directory, tall, wide = source_tiff.choose_image(first, out_height, out_width)
    picked = [paths[b] for b in RGB]
    lines = read_tiff(spark, picked, real=True, heights=[tall] * len(picked), directory=directory, window_lines=512)
    small = preview.decimate_lines(lines, ["path"], tall, wide, out_height, out_width)
    return png.collect_channels(preview.stretch_lines(small, ["path"], *options.stretch), "path", tuple(picked), out_height, out_width)


def _write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Write a small file through Hadoop, so that any file system Spark knows will do."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(data))
    out.close()


def run(spark: SparkSession, package: str, output: str, options: Options = Options(), *, created: str | None = None) -> dict:
    """Write the product of one package to the folder `output`; returns the product with its report."""
    began = time.perf_counter()
    packages = source.kept(source.read_packages(spark, package))
    for row in packages.unmatched.collect():  # one package's bands
        log.warning("Skipping band %r: the filter map does not have it, so it cannot be calibrated.", row["band"])
    scene = packages.scenes.first()
    catalogued = packages.bands.collect()
    known = {r["band"]: r for r in catalogued}
    chosen = list(options.bands or known)
    if unknown := [b for b in chosen if b not in known]:
        raise KeyError(f"unknown bands: {unknown}")
    timing = packages.samples.agg(F.coalesce(F.bool_and(F.col("sample_line").isNotNull()), F.lit(False)).alias("timed"), F.coalesce(F.max("n_missing"), F.lit(0)).alias("missing"), F.count("*").alias("n")).first()
    if timing["missing"]:
        log.warning("Discarding temperature timing: %d of %d samples lack a time; samples are spread evenly instead.", timing["missing"], timing["n"])
    log.info("Read acquisition %s (%d bands to process)", scene["scene_id"], len(chosen))
    store = f"{output.rstrip('/')}/radiance.parquet"
    found = band_contexts(packages, options)
    # one package's bands are few: worked out once, and small enough for Spark to broadcast to the lines
    contexts = spark.createDataFrame(found.collect(), found.schema)
    lines = radiance_lines(spark, contexts, [known[b]["path"] for b in chosen], options, [known[b]["height"] for b in chosen]) if chosen else None
    rows: list[dict] = []
    if lines is not None:
        # measured values hardly repeat: a dictionary would be built and thrown away
        lines.write.mode("overwrite").option("parquet.enable.dictionary", "false").partitionBy("band").parquet(store)
        stored = spark.read.parquet(store)
        rows = [r.asDict() for r in pixel_report(stored, ["band"], options.thresholds).collect()]
        rows.sort(key=lambda r: chosen.index(r["band"]))
        write_tiff(stored, output, options=options.tiff)
    report = catalogue.quality_document(rows, scene["scene_id"], LEVEL)
    uuids = {r["band"]: r["uuid"] for r in calibration.last_uuids(packages.entries, ["band"]).collect()}
    product = {
        "level": LEVEL, "scene_id": scene["scene_id"], "units": UNITS,
        "bands": {b: f"{output.rstrip('/')}/{b}{options.tiff.suffix}" for b in chosen},
        "metadata": {
            "scene_id": scene["scene_id"], "acquired_at": scene["acquired_at"], "level": LEVEL, "units": UNITS,
            "imager_configuration": {"line_period_us": scene["line_period_us"], "band_setup": scene["band_setup"], "band_start_row": scene["band_start_row"], "scan_direction": scene["scan_direction"]},
            "bands": {b: {"cwl_nm": known[b]["cwl_nm"], "band_id": known[b]["band_id"]} for b in chosen}, "qa": report,
        },
        "provenance": {
            "source_scene_id": scene["scene_id"], "software": {"name": "rasterloom", "version": __version__}, "calibration_uuids": uuids,
            "processing": {"temperature_model": f"per_line_{'timestamped' if timing['timed'] else 'uniform'}_interpolation", "window_lines": options.window_lines, "nodata": options.nodata, "clipping": "none"},
        },
    }
    _write_bytes(spark, f"{output}/qa_report.json", catalogue.to_json(report).encode())
    thumbnail = None
    if options.quicklook:
        if all(b in product["bands"] for b in RGB):
            places = {b: source_tiff.qualified(spark, product["bands"][b]) for b in RGB}
            _write_bytes(spark, f"{output}/quicklook.png", png.encode_png(quicklook(spark, places, options)))
            thumbnail = "quicklook.png"
        else:
            log.warning("No preview is written: it takes the bands %s, and not all of them are here.", ", ".join(RGB))
    if options.item:
        item = catalogue.catalogue_item(product, quicklook_href=thumbnail, qa_href="qa_report.json", created=created)
        _write_bytes(spark, f"{output}/{item['id']}.json", catalogue.to_json(item).encode())
    source.release(packages)
    product["metadata"]["runtime_seconds"] = round(time.perf_counter() - began, 2)
    return product


def validate(spark: SparkSession, product: dict, thresholds: quality.Thresholds = quality.Thresholds()) -> dict:
    """Quality of a written product, from its rasters; counts are not at hand, so saturation is not checked."""
    paths = {b: source_tiff.qualified(spark, p) for b, p in product["bands"].items()}
    bands = spark.createDataFrame(list(paths.items()), "band string, path string")
    lines = read_tiff(spark, list(paths.values()), real=True).join(bands, "path").select("band", F.col("values").alias("radiance"))
    rows = [r.asDict() for r in pixel_report(lines, ["band"], quality.Thresholds(None, thresholds.max_negative_fraction, thresholds.max_nodata_fraction)).collect()]
    rows.sort(key=lambda r: list(product["bands"]).index(r["band"]))
    return catalogue.quality_document(rows, product["scene_id"], product["level"])
