"""Streams of radiance lines and of packages.

`streaming_quality` keeps the band accumulators as Spark's own aggregation
state. `watch_packages` calibrates each package once, as its metadata file
turns up; the query's checkpoint remembers which were taken.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality


def streaming_quality(lines: DataFrame, keys: list[str], thresholds: quality.Thresholds = quality.Thresholds()) -> DataFrame:
    """Statistics and flags per key of a stream of lines (keys, dn array?, radiance array); use output mode complete or update."""
    arrays = [c for c in ("dn", "radiance") if c in lines.columns]
    pixels = lines.select(*keys, F.inline(F.arrays_zip(*arrays)))
    return quality.band_report(pixels, keys, thresholds)


def windowed_quality(lines: DataFrame, time: str, window: str, delay: str, keys: list[str], thresholds: quality.Thresholds = quality.Thresholds()) -> DataFrame:
    """The same per window of event time; lines later than `delay` are dropped, so append mode works."""
    arrays = [c for c in ("dn", "radiance") if c in lines.columns]
    pixels = lines.withWatermark(time, delay).select(*keys, F.window(time, window).alias("window"), F.inline(F.arrays_zip(*arrays)))
    return quality.with_flags(pixels.groupBy(*keys, "window").agg(*quality.statistics(thresholds, dn="dn" if "dn" in arrays else None)), thresholds)


def watch_packages(spark: SparkSession, root: str, handle: Callable[[SparkSession, list[str]], None], checkpoint: str, *, per_trigger: int = 20):
    """Start a query that calls `handle(spark, folders)` for packages whose metadata.json is new below `root`."""
    files = (
        spark.readStream.format("binaryFile").option("pathGlobFilter", "metadata.json").option("recursiveFileLookup", True).option("maxFilesPerTrigger", per_trigger)
        .schema("path string, modificationTime timestamp, length long, content binary").load(root)
    )
    folders = files.select(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("package"))

    def batch(found: DataFrame, _: int) -> None:
        handle(spark, [r["package"] for r in found.distinct().orderBy("package").collect()])  # at most `per_trigger` names

    return folders.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
