"""Resampling lines onto another grid.

For each output pixel a model gives the place in the source (inverse mapping).
Source tiles carry a margin as wide as the kernel, so an output pixel needs one
source tile only, that of the pixel at or before its place. Which source tiles
an output tile touches is found from its own pixels; the pairs of tiles are
brought together, not pixels.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import dealing

BILINEAR, CUBIC = "bilinear", "cubic"
#: Pixels that a kernel takes before and behind the one at or before a place.
BEFORE, BEHIND = 1, 2
TILE = 128


def places(terms: Sequence[float], line: np.ndarray, col: np.ndarray) -> np.ndarray:
    """The polynomial of an output pixel: constant, col, line, col col, col line, line line; missing terms are 0."""
    total = np.full(line.shape, float(terms[0]))
    for c, power in zip(terms[1:], (col, line, col * col, col * line, line * line), strict=False):
        total = total + c * power
    return total


def kernel(name: str, u: np.ndarray) -> np.ndarray:
    """Weights of the pixels from one before to two behind, at a fraction u past a pixel."""
    if name == BILINEAR:
        return np.stack([np.zeros_like(u), 1 - u, u, np.zeros_like(u)])
    return np.stack([((2 - u) * u - 1) * u / 2, ((3 * u - 5) * u * u + 2) / 2, ((4 - 3 * u) * u + 1) * u / 2, (u - 1) * u * u / 2])


def _pixels(oy: int, ox: int, height: int, width: int, tile: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines and columns of an output tile."""
    return np.mgrid[oy * tile : min(height, (oy + 1) * tile), ox * tile : min(width, (ox + 1) * tile)].astype(np.float64)


def _sources(request: dict, tile: int) -> tuple[np.ndarray, ...]:
    """For the pixels of an output tile: places in the source, which of them are inside, and source tiles."""
    line, col = _pixels(request["oy"], request["ox"], request["out_height"], request["out_width"], tile)
    y, x = places(request["to_line"], line, col).ravel(), places(request["to_col"], line, col).ravel()
    inside = (y >= 0) & (y <= request["height"] - 1) & (x >= 0) & (x <= request["width"] - 1)
    i, j = np.floor(np.where(inside, y, 0)).astype(np.int64), np.floor(np.where(inside, x, 0)).astype(np.int64)
    return y, x, inside, i, j


def _requests(keys: list[str], tile: int):
    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                _, _, inside, i, j = _sources(r, tile)
                for ty, tx in np.unique(np.stack([i[inside] // tile, j[inside] // tile], axis=1), axis=0).tolist():
                    rows.append(r | {"ty": ty, "tx": tx})
            yield pa.RecordBatch.from_pylist(rows, schema=batch.schema.append(pa.field("ty", pa.int32())).append(pa.field("tx", pa.int32())))

    return run


def _resample(keys: list[str], how: str, tile: int):
    side = tile + BEFORE + BEHIND

    def run(asking: pa.Table, pieces: pa.Table) -> pa.Table:
        rows, source, top, left = [], None, 0, 0
        for r in asking.to_pylist():
            if source is None:
                top, left = r["ty"] * tile - BEFORE, r["tx"] * tile - BEFORE
                source = np.full((side, side), np.nan)
                for line, first, values in zip(pieces.column("line").to_pylist(), pieces.column("first").to_pylist(), pieces.column("values").to_pylist(), strict=True):
                    source[line - top, first - left : first - left + len(values)] = values
            y, x, inside, i, j = _sources(r, tile)
            mine = np.flatnonzero(inside & (i // tile == r["ty"]) & (j // tile == r["tx"]))
            i, j, y, x = i[mine], j[mine], y[mine], x[mine]
            down, across = kernel(how, y - i), kernel(how, x - j)
            total = np.zeros(len(mine))
            for a in range(4):
                # pixels past the edge repeat it
                row = np.clip(i + a - BEFORE, 0, r["height"] - 1) - top
                part, seen = np.zeros(len(mine)), down[a] != 0
                for b in range(4):
                    value = source[row, np.clip(j + b - BEFORE, 0, r["width"] - 1) - left]
                    part = part + np.where(across[b] != 0, across[b] * value, 0)
                total = total + np.where(seen, down[a] * part, 0)
            rows.append((*(r[k] for k in keys), r["oy"], r["ox"], r["out_height"], r["out_width"], mine.astype(np.int32), total.astype(np.float32)))
        kinds = [*(asking.schema.field(k).type for k in keys), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float32())]
        names = [*keys, "oy", "ox", "out_height", "out_width", "place", "found"]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def _assemble(keys: list[str], tile: int):
    def run(key: tuple, parts: pa.Table) -> pa.Table:
        *own, oy, ox, height, width = [k.as_py() for k in key]
        tall, wide = min(tile, height - oy * tile), min(tile, width - ox * tile)
        values = np.full(tall * wide, np.nan, dtype=np.float32)
        for place, found in zip(parts.column("place").to_pylist(), parts.column("found").to_pylist(), strict=True):
            values[place] = found
        lists = pa.ListArray.from_arrays(pa.array(np.arange(tall + 1, dtype=np.int32) * wide), pa.array(values))
        same = [pa.array([v] * tall, parts.schema.field(k).type) for k, v in zip(keys, own, strict=True)]
        return pa.table([*same, pa.array(np.arange(tall, dtype=np.int32) + oy * tile), pa.array(np.full(tall, ox * tile, dtype=np.int32)), lists], [*keys, "line", "first", "values"])

    return run


def pieces(lines: DataFrame, keys: list[str], value: str, tile: int) -> DataFrame:
    """(keys, ty, tx, line, first, values) from lines (keys, line, height, width, value array): what of each line goes to which tile, margins included."""
    last = lambda n: F.floor((n - 1) / tile).cast("int")
    down = F.sequence(F.greatest(F.floor((F.col("line") - BEHIND) / tile), F.lit(0)).cast("int"), F.least(F.floor((F.col("line") + BEFORE) / tile).cast("int"), last(F.col("height"))))
    dealt = lines.withColumn("ty", F.explode(down)).withColumn("tx", F.explode(F.sequence(F.lit(0), last(F.col("width")))))
    first = F.greatest(F.col("tx") * tile - BEFORE, F.lit(0))
    until = F.least((F.col("tx") + 1) * tile + BEHIND, F.col("width"))
    return dealt.select(*keys, "ty", "tx", F.col("line").cast("int").alias("line"), first.cast("int").alias("first"), F.slice(value, first + 1, until - first).cast("array<float>").alias("values"))


def warp(lines: DataFrame, models: DataFrame, keys: list[str], *, value: str = "radiance", how: str = BILINEAR, tile: int = TILE) -> DataFrame:
    """(keys, line, values): lines (keys, line, value array) resampled to the grid of each key's model.

    `models` has one row a key: `height` and `width` of the source, `out_height`
    and `out_width`, and `to_line` and `to_col`, the polynomials (see `places`)
    that lead from an output pixel to the source. Output pixels whose place is
    outside the source are NaN, as are those to which a NaN or missing pixel
    contributes; the cubic kernel (a = -0.5) repeats pixels at the edges. Keys
    without lines are NaN throughout.
    """
    if how not in (BILINEAR, CUBIC):
        raise ValueError(f"no such kernel: {how}")
    wanted = models.select(*keys, *(F.col(c).cast("int").alias(c) for c in ("height", "width", "out_height", "out_width")), *(F.col(c).cast("array<double>").alias(c) for c in ("to_line", "to_col")))
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.floor((F.col(c) - 1) / tile).cast("int")))
    tiles = wanted.where("out_height > 0 and out_width > 0 and height > 0 and width > 0").withColumn("oy", upto("out_height")).withColumn("ox", upto("out_width"))
    tiles = tiles.repartition(*keys, "oy", "ox")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tiles.schema)
    asking = tiles.mapInArrow(_requests(keys, tile), f"{kinds}, ty int, tx int")
    held = pieces(lines.join(wanted.select(*keys, "height", "width"), keys), keys, value, tile)
    own = ", ".join(f"`{k}` {wanted.schema[k].dataType.simpleString()}" for k in keys)
    found = dealing.answer(asking, held, [*keys, "ty", "tx"], ["oy", "ox"], 16, _resample(keys, how, tile), f"{own}, oy int, ox int, out_height int, out_width int, place array<int>, found array<float>")
    none = tiles.select(*keys, "oy", "ox", "out_height", "out_width", F.array().cast("array<int>").alias("place"), F.array().cast("array<float>").alias("found"))
    parts = found.unionByName(none).groupBy(*keys, "oy", "ox", "out_height", "out_width").applyInArrow(_assemble(keys, tile), f"{own}, line int, first int, values array<float>")
    across = F.array_sort(F.collect_list(F.struct("first", "values")))  # a line's pieces
    return parts.groupBy(*keys, "line").agg(F.flatten(F.transform(across, lambda p: p["values"])).alias("values"))
