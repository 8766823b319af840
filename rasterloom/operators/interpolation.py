"""Samples along the scan and linear interpolation between them.

Samples are rows (keys, ord, x, y). Three forms of the same interpolation,
equal to the bit: `by_array` for the few samples that a scene's telemetry has,
`by_segments` as a join on ranges of lines, and `by_window` as one sort per
range. The last two take any number of samples and lines of one scene.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ordered

#: Lines of a range that is sorted, or joined, at once.
SORTED, JOINED = 4096, 256


def _between(x: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """(y1 - y0) / (x1 - x0) * (x - x0) + y0, with the nearer end where one side is missing."""
    step = (y1 - y0) / F.when(x1 != x0, x1 - x0)
    return F.when(x1.isNull() | (x0 == x), y0).when(x0.isNull(), y1).otherwise(step * (x - x0) + y0)


def uniform_positions(samples: DataFrame, height: Column, keys: list[str]) -> DataFrame:
    """Give samples (keys, ord, y) evenly spaced positions x from 0 to the last line."""
    placed = ordered.places(samples, keys, "ord", name="_place", count="_total")
    count, place = F.col("_total"), F.col("_place")
    last = (height - 1).cast("double")
    spaced = F.when(place == count - 1, F.when(count > 1, last).otherwise(0.0)).otherwise(place * (last / F.greatest(count - 1, F.lit(1))))
    return placed.withColumn("x", spaced.cast("double")).drop("_place", "_total")


def segments(samples: DataFrame, keys: list[str]) -> DataFrame:
    """Half-open pieces [x0, x1) between neighbouring samples, the two clamped ends included (null bounds); those of length zero drop out."""
    point = F.struct(F.col("x"), F.col("y"))
    along = ordered.neighbours(samples.select(*keys, "ord", "x", "y"), keys, "x", ["ord"], F.lit(True), point, span=SORTED)
    inner = along.select(*keys, F.col("x").alias("x0"), F.col("y").alias("y0"), F.col("after.x").alias("x1"), F.col("after.y").alias("y1")).where("x1 is null or x1 > x0")
    first = samples.groupBy(*keys).agg(F.min(F.struct("x", "ord", "y")).alias("first"))
    before = first.select(*keys, F.lit(None).cast("double").alias("x0"), F.lit(None).cast("double").alias("y0"), F.col("first.x").alias("x1"), F.col("first.y").alias("y1"))
    return inner.unionByName(before)


def by_segments(lines: DataFrame, samples: DataFrame, keys: list[str]) -> DataFrame:
    """Join of `lines` (keys, line) to the segment that holds each line; adds `t` (float).

    Lines and segments meet by ranges of lines: a range has the segments that
    begin in it, and the one that reaches into it from before.
    """
    cut = lambda x: F.floor(x / JOINED)
    pieces = segments(samples, keys).withColumn("_range", F.coalesce(cut(F.col("x0")), F.lit(-(1 << 62))))
    placed = lines.withColumn("_range", cut(F.col("line")))
    piece = F.struct("x0", "y0", "x1", "y1")
    last = pieces.groupBy(*keys, "_range").agg(F.max_by(piece, F.coalesce("x0", F.lit(float("-inf")))).alias("_last"))
    ranges = last.unionByName(placed.select(*keys, "_range").distinct().withColumn("_last", F.lit(None).cast(last.schema["_last"].dataType)))
    ranges = ranges.groupBy(*keys, "_range").agg(F.max("_last").alias("_last"))
    reach = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ranges.withColumn("_last", F.last("_last", True).over(reach)).where(F.col("_last").isNotNull()).select(*keys, "_range", "_last.*")
    x = F.col("line").cast("double")
    held = placed.join(pieces.unionByName(carried), [*keys, "_range"]).where((F.col("x0").isNull() | (F.col("x0") <= x)) & (F.col("x1").isNull() | (x < F.col("x1"))))
    return held.select(*lines.columns, _between(x, F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")).cast("float").alias("t"))


def by_window(lines: DataFrame, samples: DataFrame, keys: list[str]) -> DataFrame:
    """The same by sorting ranges: the last sample at or before each line and the first after it."""
    marked = samples.select(*keys, "x", "y", F.lit(0).alias("kind"), F.col("ord").cast("long").alias("ord")).unionByName(
        lines.select(*keys, "line").distinct().select(*keys, F.col("line").cast("double").alias("x"), F.lit(None).cast("double").alias("y"), F.lit(1).alias("kind"), F.col("line").cast("long").alias("ord"))
    )
    found = ordered.neighbours(marked, keys, "x", ["kind", "ord"], F.col("kind") == 0, F.struct(F.col("x"), F.col("y")), span=SORTED)
    found = found.where("kind = 1").select(*keys, F.col("ord").alias("line"), _between(F.col("x"), F.col("before.x"), F.col("before.y"), F.col("after.x"), F.col("after.y")).cast("float").alias("t"))
    return lines.join(found, [*keys, "line"])


def sample_array(samples: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, samples): the samples of each key as an array sorted by position, then order."""
    return samples.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("x", "ord", "y"))).alias("samples"))


def by_array(line: Column, samples: Column) -> Column:
    """The interpolated value (float) at `line`, given the sorted sample array of its scene."""
    x = line.cast("double")
    a = F.try_element_at(F.filter(samples, lambda s: s["x"] <= x), F.lit(-1))
    b = F.try_element_at(F.filter(samples, lambda s: s["x"] > x), F.lit(1))
    return _between(x, a["x"], a["y"], b["x"], b["y"]).cast("float")


def require_samples(samples: Column) -> Column:
    """The array itself; an error where a scene has no sample at all."""
    return F.when(F.coalesce(F.size(samples), F.lit(0)) > 0, samples).otherwise(F.raise_error(F.lit("a scene has no temperature sample")).cast("array<struct<x:double,ord:int,y:double>>"))
