"""Clock alignment: from telemetry clocks to positions along the scan.

Times of the imager are microseconds, platform and epoch times milliseconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Time format that ties the imager clock to the platform's epoch clock.
ANCHOR_FORMAT = 1


def epoch_ms(iso: Column) -> Column:
    """Milliseconds since 1970 of an ISO 8601 time, null if it is none; without a zone it is UTC (the session's zone must be UTC)."""
    return F.unix_micros(F.try_to_timestamp(iso)) / F.lit(1000.0)


def first_anchor(entries: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, imager_us, platform_ms): the first entry, by `ord`, of anchor format that has both clocks."""
    both = entries.where((F.col("time_format") == ANCHOR_FORMAT) & F.col("imager_time").isNotNull() & F.col("platform_time").isNotNull())
    clocks = F.struct(F.col("imager_time").cast("double").alias("imager_us"), F.col("platform_time").cast("double").alias("platform_ms"))
    return both.groupBy(*keys).agg(F.min_by(clocks, "ord").alias("a")).select(*keys, "a.*")


def drop_partial_times(samples: DataFrame, keys: list[str]) -> DataFrame:
    """If any sample of a scene lacks its time, none of the scene's times counts; `n_missing` tells how many did."""
    missing = F.col("imager_time").isNull() | F.isnan("imager_time")
    counted = samples.groupBy(*keys).agg(F.count_if(missing).alias("n_missing"))  # combined before the shuffle; a scene may have any number of samples
    return samples.join(counted, keys).withColumn("imager_time", F.when(F.col("n_missing") == 0, F.col("imager_time")))


def line_zero_us(imager_us: Column, platform_ms: Column, start_ms: Column, offset_s: Column) -> Column:
    """The imager clock at the first line."""
    return imager_us + (start_ms - platform_ms) * 1000.0 + offset_s * 1e6


def sample_lines(samples: DataFrame, scenes: DataFrame, keys: list[str]) -> DataFrame:
    """Add `sample_line` to samples: the line that each was taken at, null for a scene that lacks an anchor, a start, times, or a line period.

    `scenes` has (keys, imager_us, platform_ms, start_ms, offset_s, line_period_us).
    """
    origin = line_zero_us(F.col("imager_us"), F.col("platform_ms"), F.col("start_ms"), F.coalesce("offset_s", F.lit(0.0)))
    period = F.when(F.col("line_period_us") != 0, F.col("line_period_us").cast("double"))
    return drop_partial_times(samples, keys).join(scenes, keys, "left").withColumn("sample_line", (F.col("imager_time") - origin) / period)
