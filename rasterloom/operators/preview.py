"""Overviews, decimation, contrast stretch and RGB stacking."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import workspace
from ..functions.columns import nan, stretch, to_byte, valid_or_null

OVERVIEW_FACTORS = (2, 4, 8, 16, 32)


def output_shape(height: int, width: int, longest: int) -> tuple[int, int]:
    """Preview size: the longer side at most `longest`, rounded half to even, never 0."""
    scale = max(max(height, width) / longest, 1.0)
    return max(1, round(height / scale)), max(1, round(width / scale))


def _average(pixels: DataFrame, keys: list[str], line: Column, col: Column) -> DataFrame:
    mean = F.coalesce(F.avg(valid_or_null(F.col("radiance").cast("double"))), nan("double"))
    return pixels.groupBy(*keys, line.alias("line"), col.alias("col")).agg(mean.alias("radiance"))


def overview(pixels: DataFrame, keys: list[str], factor: int) -> DataFrame:
    """Averages of the valid pixels of factor x factor blocks; NaN where a block has none."""
    return _average(pixels, keys, F.floor(F.col("line") / factor).cast("int"), F.floor(F.col("col") / factor).cast("int"))


def decimate(pixels: DataFrame, keys: list[str], height: Column, width: Column, out_height: Column, out_width: Column) -> DataFrame:
    """Average to a grid of out_height x out_width."""
    return _average(pixels, keys, F.expr("0").cast("int") + F.floor(F.col("line") * out_height / height).cast("int"), F.floor(F.col("col") * out_width / width).cast("int"))


#: Output lines that are put together at once.
TOGETHER = 64


def _matrix(lists: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Lines of one width as an array."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if (lists.value_lengths().to_numpy(zero_copy_only=False) != width).any():
        raise ValueError("a line does not fit its raster")
    return flat.reshape(len(lists), width)


def _lists(values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), pa.array(values.ravel()))


def _runs(keys: list[str], table: pa.RecordBatch | pa.Table, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows, and where in it a new (keys, line) starts."""
    codes = [np.unique(np.array(table.column(k).to_pylist(), dtype=object).astype(str), return_inverse=True)[1] for k in keys]
    order = np.lexsort([line, *codes])
    change = np.zeros(len(line), dtype=bool)
    for column in (line, *codes):
        change |= np.diff(column[order], prepend=-1) != 0
    return order, np.flatnonzero(change)


def _line_sums(keys: list[str], value: str, height: int, width: int, out_height: int, out_width: int):
    """Sums and counts of the valid pixels per output line and column, combined over the lines of a batch."""
    starts = np.flatnonzero(np.diff(np.arange(width) * out_width // width, prepend=-1))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            line = batch.column("line").to_numpy().astype(np.int64) * out_height // height
            pixels = _matrix(batch.column(value), width).astype(np.float64)
            good = np.isfinite(pixels)
            sums = np.add.reduceat(np.where(good, pixels, 0.0), starts, axis=1)
            counts = np.add.reduceat(good, starts, axis=1, dtype=np.int64)
            order, first = _runs(keys, batch, line)
            columns = [batch.column(k).take(pa.array(order[first])) for k in keys]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(line[order[first]].astype(np.int32)), _lists(np.add.reduceat(sums[order], first, axis=0)), _lists(np.add.reduceat(counts[order], first, axis=0))], [*keys, "line", "sums", "counts"]
            )

    return run


def decimate_lines(lines: DataFrame, keys: list[str], height: int, width: int, out_height: int, out_width: int, *, value: str = "values") -> DataFrame:
    """(keys, line, values): as `decimate`, from and to lines as arrays; no pixel becomes a row.

    What is shuffled is some rows of sums for each output line; they are put
    together for some output lines at once.
    """
    kinds = ", ".join(f"`{k}` {lines.schema[k].dataType.simpleString()}" for k in keys)
    sums = lines.select(*keys, "line", value).mapInArrow(_line_sums(keys, value, height, width, out_height, out_width), f"{kinds}, line int, sums array<double>, counts array<long>")

    def add(key, table):
        line = table.column("line").to_numpy().astype(np.int64)
        order, first = _runs(keys, table, line)
        total, count = (np.add.reduceat(_matrix(table.column(c), out_width)[order], first, axis=0) for c in ("sums", "counts"))
        mean = np.where(count > 0, total / np.maximum(count, 1), np.nan)
        columns = [table.column(k).take(pa.array(order[first])) for k in keys]
        return pa.table([*columns, pa.array(line[order[first]].astype(np.int32)), _lists(mean)], [*keys, "line", "values"])

    dealt = sums.withColumn("_part", F.floor(F.col("line") / TOGETHER))
    return dealt.groupBy(*keys, "_part").applyInArrow(lambda key, table: add(key, table.drop_columns(["_part"])), f"{kinds}, line int, values array<double>")


#: Buckets that a range of values is cut into to find a rank, and values of a bucket that are sorted instead of cut again.
BUCKETS, SORTED = 4096, 1024


def percentiles(pixels: DataFrame, keys: list[str], wanted: tuple[float, ...], value: Column) -> DataFrame:
    """(keys, found): exact percentiles (0 to 100) of the non-null values, interpolated; an array of nulls where there are none.

    A rank is found by counting: the range of a key's values is cut into
    buckets, the one that holds the rank is cut again, from its least to its
    largest value, until it is small or a single value. A task holds counts of
    buckets, never the values of a key. The rounds are some logarithm of how
    unevenly the values lie; one or two for most.
    """
    held = workspace.cut(pixels.select(*keys, value.cast("double").alias("_v")))
    whole = workspace.cut(held.groupBy(*keys).agg(F.count("_v").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high")))
    place = lambda p: F.lit(p / 100) * (F.col("_n") - 1)
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(place(p)), F.ceil(place(p))) for p in wanted])))
    # a rank is in the values from `low` to `high`, `k` of its key's, before which there are `below`
    now = whole.where("_n > 0").select(*keys, F.explode(ranks).alias("_rank"), F.lit(0).cast("long").alias("_below"), F.col("_n").alias("_k"), "_low", "_high")
    small = (F.col("_k") <= SORTED) | (F.col("_low") == F.col("_high"))
    done = []
    while True:
        done.append(now.where(small))
        now = now.where(~small)
        if now.isEmpty():
            break
        near = held.join(now.drop("_k"), keys).where("_v >= _low and _v <= _high")
        v, low, high = F.col("_v"), F.col("_low"), F.col("_high")
        part = F.when(high - low < 1e308, (v - low) / (high - low)).otherwise((v / 2 - low / 2) / (high / 2 - low / 2))  # a range may exceed all numbers
        bucket = F.least(F.floor(part * BUCKETS), F.lit(BUCKETS - 1))
        counts = near.groupBy(*keys, "_rank", "_below", bucket.alias("_bucket")).agg(F.count("*").alias("_k"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        before = F.sum("_k").over(Window.partitionBy(*keys, "_rank").orderBy("_bucket")) - F.col("_k")
        counted = counts.withColumn("_below", F.col("_below") + before)
        now = workspace.cut(counted.where("_rank >= _below and _rank < _below + _k").select(*keys, "_rank", "_below", "_k", "_low", "_high"))
    last = reduce(DataFrame.unionByName, done)
    alike = last.where("_low = _high").select(*keys, "_rank", F.col("_low").alias("_v"))
    near = held.join(last.where("_low < _high"), keys).where("_v >= _low and _v <= _high")
    listed = near.groupBy(*keys, "_rank", "_below").agg(F.sort_array(F.collect_list("_v")).alias("_vs"))  # SORTED values at most
    single = alike.unionByName(listed.select(*keys, "_rank", F.get("_vs", (F.col("_rank") - F.col("_below")).cast("int")).alias("_v")))
    at = single.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at"))

    def one(p):
        low, high = F.floor(place(p)), F.ceil(place(p))
        a, b = F.element_at("_at", low), F.element_at("_at", high)
        return F.when((low == high) | (a == b), a).otherwise((high - place(p)) * a + (place(p) - low) * b)

    return whole.join(at, keys, "left").select(*keys, F.array(*map(one, wanted)).alias("found"))


def stretch_bounds(pixels: DataFrame, keys: list[str], low: float = 2.0, high: float = 98.0) -> DataFrame:
    """(keys, low, high): exact percentiles of the valid pixels, interpolated; null where there are none."""
    bounds = percentiles(pixels, keys, (low, high), valid_or_null(F.col("radiance").cast("double")))
    return bounds.select(*keys, F.get("found", F.lit(0)).alias("low"), F.get("found", F.lit(1)).alias("high"))


def stretched(pixels: DataFrame, keys: list[str], low: float = 2.0, high: float = 98.0) -> DataFrame:
    """Add `level`, the pixel on a scale of 0 to 1 (NaN stays NaN). The pixels are read several times."""
    bounds = stretch_bounds(pixels, keys, low, high)
    return pixels.join(bounds, keys).withColumn("level", stretch(F.col("radiance").cast("double"), F.col("low"), F.col("high"))).drop("low", "high")


def stretch_lines(small: DataFrame, keys: list[str], low: float = 2.0, high: float = 98.0, *, value: str = "values") -> DataFrame:
    """(keys, line, data): bytes of the stretched lines (keys, line, value array) of a preview; NaN is black.

    The preview of a key is worked on whole, so its size must be bounded, as
    `decimate_lines` makes it; for pixels of full size there is `stretched`.
    """

    def run(table):
        line = table.column("line").to_pylist()
        lists = table.column(value)
        image = _matrix(lists, len(lists[0])).astype(np.float64)
        good = image[np.isfinite(image)]
        bottom, top = np.percentile(good, [low, high]) if len(good) else (0.0, 0.0)
        level = (image - bottom) / ((top - bottom) if top > bottom else 1.0) if len(good) else np.zeros_like(image)
        data = (np.clip(np.nan_to_num(level, nan=0.0), 0, 1) * 255).astype(np.uint8)
        return pa.table([*(table.column(k) for k in keys), pa.array(line, pa.int32()), pa.array([row.tobytes() for row in data], pa.binary())], [*keys, "line", "data"])

    kinds = ", ".join(f"`{k}` {small.schema[k].dataType.simpleString()}" for k in keys)
    return small.groupBy(*keys).applyInArrow(run, f"{kinds}, line int, data binary")


def stack_rgb(levels: DataFrame, keys: list[str], rgb: tuple = ("R", "G", "B"), band: str = "band") -> DataFrame:
    """(keys, line, col, r, g, b): bytes of three bands side by side; one shuffle, no join."""
    channel = lambda name: F.coalesce(to_byte(F.max(F.when(F.col(band) == name, F.col("level")))), F.lit(0))
    picked = levels.where(F.col(band).isin(*rgb))
    return picked.groupBy(*keys, "line", "col").agg(*[channel(name).alias(c) for name, c in zip(rgb, "rgb", strict=True)])


def missing_bands(have: DataFrame, rgb: tuple = ("R", "G", "B"), band: str = "band") -> DataFrame:
    """(missing): those of the wanted bands that are not there."""
    return have.agg(F.array_except(F.array(*map(F.lit, rgb)), F.collect_set(F.when(F.col(band).isin(*rgb), F.col(band)))).alias("missing"))
