"""Before calibration: summing detector rows, binning, gaps and dead detectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import ordered


def accumulate_rows(raw: DataFrame, setup: DataFrame, keys: list[str]) -> DataFrame:
    """Sum the rows [start_row, start_row + tdi) of raw pixels (keys, row, line, col, dn) for each band of `setup`, in 64 bits.

    A detector row sees a scene line `row - start_row` line periods later (earlier, if scanning backwards).
    """
    joined = raw.join(setup, keys).where((F.col("row") >= F.col("start_row")) & (F.col("row") < F.col("start_row") + F.col("tdi")))
    seen = F.col("line") - F.col("scan_direction") * (F.col("row") - F.col("start_row"))
    return joined.groupBy(*keys, "band", seen.alias("line"), "col").agg(F.sum(F.col("dn").cast("bigint")).alias("dn"))


def bin_pixels(pixels: DataFrame, keys: list[str], factor: int) -> DataFrame:
    """Sum factor x factor blocks."""
    return pixels.groupBy(*keys, F.floor(F.col("line") / factor).alias("line"), F.floor(F.col("col") / factor).alias("col")).agg(F.sum(F.col("dn").cast("bigint")).alias("dn"))


def line_gaps(lines: DataFrame, keys: list[str], *, line: str = "line", span: float = 65_536.0) -> DataFrame:
    """(keys, line, missing, repeated): lines after which some are missing, and lines that occur more than once.

    Lines are cut into ranges of `span`, so a scene of any length spreads over many tasks.
    """
    counted = lines.groupBy(*keys, line).agg(F.count("*").alias("n"))
    near = ordered.neighbours(counted, keys, line, [], F.lit(True), F.col(line), span=span)
    found = near.select(*keys, line, F.coalesce(F.col("after") - F.col(line) - 1, F.lit(0)).alias("missing"), (F.col("n") - 1).alias("repeated"))
    return found.where("missing > 0 or repeated > 0")


def fill_dead_columns(pixels: DataFrame, keys: list[str], value: str = "radiance") -> DataFrame:
    """Replace pixels whose `dead` is true by the mean of their nearest live neighbours in the line."""
    before = Window.partitionBy(*keys, "line").orderBy("col").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*keys, "line").orderBy(F.desc("col")).rowsBetween(Window.unboundedPreceding, -1)
    live = F.when(~F.col("dead"), F.col(value))
    left, right = F.last(live, True).over(before), F.last(live, True).over(after)
    mean = F.when(left.isNull(), right).when(right.isNull(), left).otherwise((left + right) / 2)
    return pixels.withColumn(value, F.when(F.col("dead"), mean.cast(pixels.schema[value].dataType)).otherwise(F.col(value)))


def destripe(pixels: DataFrame, keys: list[str], value: str = "radiance") -> DataFrame:
    """Shift every column so that its mean over the lines is the band's mean; NaN pixels take no part."""
    good = F.when(~F.isnan(value), F.col(value).cast("double"))
    columns = pixels.groupBy(*keys, "col").agg(F.avg(good).alias("column_mean"))
    bands = pixels.groupBy(*keys).agg(F.avg(good).alias("band_mean"))
    shift = columns.join(bands, keys).select(*keys, "col", (F.col("band_mean") - F.col("column_mean")).alias("shift"))
    moved = (F.col(value) + F.coalesce("shift", F.lit(0.0))).cast(pixels.schema[value].dataType)
    return pixels.join(shift, [*keys, "col"]).withColumn(value, moved).drop("shift")
