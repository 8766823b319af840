"""Connected regions of a mask, and the shadows they cast.

A line of a mask is kept as runs of set pixels. Strips of lines are labelled
each in one task, by joining runs that touch; then only runs on the first and
last line of a strip meet those of the next strip, and what touches there joins
labels. A region may reach over any number of strips; no task holds more than
one, and labels, not pixels, take part in the merging.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import workspace

#: Lines of a strip.
STRIP = 512


def runs(lines: DataFrame, keys: list[str], mask: str = "mask") -> DataFrame:
    """(keys, line, start, stop): runs of true pixels of lines (keys, line, array of booleans); null pixels and lines have none."""
    n = F.size(mask)
    at = lambda i: F.coalesce(F.get(mask, i), F.lit(False))
    places = F.sequence(F.lit(0), n)
    starts = F.filter(places, lambda i: at(i) & ~at(i - 1))
    stops = F.filter(places, lambda i: ~at(i) & at(i - 1))
    pairs = F.when(n > 0, F.arrays_zip(starts.alias("start"), stops.alias("stop")))
    return lines.select(*keys, F.col("line").cast("long").alias("line"), F.inline(pairs))


def _touching(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of runs of two neighbouring lines (start, stop, sorted) that touch."""
    low = np.searchsorted(b[1], a[0] - reach, side="right")
    high = np.searchsorted(b[0], a[1] + reach, side="left")
    many = np.maximum(high - low, 0)
    first = np.repeat(np.arange(len(many)), many)
    return first, np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)


def _merge(n: int, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The least number of each node's group, for nodes 0 to n - 1 and links between them."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[one], label[other])
        before = label.copy()
        np.minimum.at(label, label[one], low)
        np.minimum.at(label, label[other], low)
        while (label != label[label]).any():
            label = label[label]
        if (label == before).all():
            return label


def _label_strip(keys: list[str], reach: int):
    def run(key, table):
        table = table.sort_by([("line", "ascending"), ("start", "ascending")])
        line, start, stop = (table.column(c).to_numpy() for c in ("line", "start", "stop"))
        cuts = np.append(np.flatnonzero(np.diff(line, prepend=line[0] - 1)), len(line))
        one, other = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in range(1, len(cuts) - 1):
            if line[cuts[i]] == line[cuts[i - 1]] + 1:
                a, b = slice(cuts[i - 1], cuts[i]), slice(cuts[i], cuts[i + 1])
                u, v = _touching((start[a], stop[a]), (start[b], stop[b]), reach)
                one.append(u + cuts[i - 1])
                other.append(v + cuts[i])
        label = _merge(len(line), np.concatenate(one), np.concatenate(other))
        return table.append_column("head_line", pa.array(line[label])).append_column("head_start", pa.array(start[label].astype(np.int32)))

    return run


def _join_labels(links: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, label, root): of labels that links (keys, u, v) lead from one to another, the least that is reached.

    Each round every root takes the least root that it is linked with, then
    chains of roots are cut short; the number of rounds grows with the
    logarithm of the longest chain.
    """
    links = workspace.cut(links.where("u <> v").distinct())
    nodes = links.select(*keys, F.col("u").alias("label")).unionByName(links.select(*keys, F.col("v").alias("label"))).distinct()
    roots = workspace.cut(nodes.withColumn("root", F.col("label")))
    while True:
        end = lambda x: roots.select(*keys, F.col("label").alias(x), F.col("root").alias(f"r{x}"))
        between = links.join(end("u"), [*keys, "u"]).join(end("v"), [*keys, "v"]).where("ru <> rv")
        hooks = between.groupBy(*keys, F.greatest("ru", "rv").alias("root")).agg(F.min(F.least("ru", "rv")).alias("to"))
        hooks = workspace.cut(hooks)
        if hooks.isEmpty():
            return roots
        while True:  # hooks lead to smaller roots, so chains end
            onward = hooks.select(*keys, F.col("root").alias("to"), F.col("to").alias("then"))
            longer = workspace.cut(hooks.join(onward, [*keys, "to"], "left").select(*keys, "root", F.coalesce("then", "to").alias("to"), F.col("then").isNotNull().alias("moved")))
            hooks = longer.drop("moved")
            if longer.where("moved").isEmpty():
                break
        roots = workspace.cut(roots.join(hooks, [*keys, "root"], "left").select(*keys, "label", F.coalesce("to", "root").alias("root")))


def label(found: DataFrame, keys: list[str], *, diagonal: bool = False, strip: int = STRIP) -> DataFrame:
    """Add `region`, a struct (line, start) of the first run of the region, to runs (keys, line, start, stop).

    Runs of neighbouring lines touch if they share a column, or with `diagonal`
    a corner. Runs of a line must not overlap. An empty table gives no rows.
    """
    kinds = {f.name: f.dataType.simpleString() for f in found.schema}
    dealt = found.select(*keys, F.col("line").cast("long").alias("line"), F.col("start").cast("int").alias("start"), F.col("stop").cast("int").alias("stop"), F.floor(F.col("line") / strip).alias("strip"))
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "line long, start int, stop int, strip long, head_line long, head_start int"])
    local = workspace.cut(dealt.groupBy(*keys, "strip").applyInArrow(_label_strip(keys, int(diagonal)), schema))
    named = local.select(*keys, "line", "start", "stop", F.struct(F.col("head_line").alias("line"), F.col("head_start").alias("start")).alias("label"))
    edge = F.pmod("line", F.lit(strip))
    last = named.where(edge == strip - 1).select(*keys, (F.col("line") + 1).alias("line"), F.col("start").alias("s"), F.col("stop").alias("e"), F.col("label").alias("u"))
    first = named.where(edge == 0).select(*keys, "line", "start", "stop", F.col("label").alias("v"))
    reach = int(diagonal)
    # a run over the edge meets those of the other line that start in the same span of columns, or in one that either covers
    span = 256
    over = lambda a, b: F.explode(F.sequence(F.floor((F.col(a) - reach) / span), F.floor((F.col(b) - 1 + reach) / span)))
    met = last.withColumn("part", over("s", "e")).join(first.withColumn("part", over("start", "stop")), [*keys, "line", "part"]).where((F.col("s") < F.col("stop") + reach) & (F.col("start") < F.col("e") + reach))
    joined = _join_labels(met.select(*keys, "u", "v"), keys)
    whole = named.join(joined, [*keys, "label"], "left")
    return whole.select(*keys, "line", "start", "stop", F.coalesce("root", "label").alias("region"))


def measure(labelled: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, region, pixels, top, bottom, left, right, mid_line, mid_col): size, box (ends included) and centre of each region."""
    n = (F.col("stop") - F.col("start")).cast("long")
    middle = (F.col("start") + F.col("stop") - 1) / 2
    return labelled.groupBy(*keys, "region").agg(
        F.sum(n).alias("pixels"), F.min("line").alias("top"), F.max("line").alias("bottom"), F.min("start").alias("left"), (F.max("stop") - 1).alias("right"),
        (F.sum(n * F.col("line")) / F.sum(n)).alias("mid_line"), (F.sum(n * middle) / F.sum(n)).alias("mid_col"),
    )


def large(labelled: DataFrame, keys: list[str], least: int) -> DataFrame:
    """The runs of regions of at least so many pixels."""
    kept = measure(labelled, keys).where(F.col("pixels") >= least).select(*keys, "region")
    return labelled.join(kept, [*keys, "region"], "left_semi")


def shadow_step(sun_azimuth_deg: Column, sun_zenith_deg: Column, pixel_metres: Column) -> tuple[Column, Column]:
    """Lines and columns by which a shadow moves per metre of height, north up: away from the sun."""
    length = F.tan(F.radians(sun_zenith_deg)) / pixel_metres
    return F.cos(F.radians(sun_azimuth_deg)) * length, -F.sin(F.radians(sun_azimuth_deg)) * length


def cast_shadows(found: DataFrame, keys: list[str], per_metre: tuple[Column, Column], lowest: float, highest: float, *, step: float, height: Column, width: Column) -> DataFrame:
    """(keys, line, start, stop): where runs throw shadows for heights from `lowest` to `highest` in steps of `step` metres; runs of a line are joined where they touch."""
    n = int((highest - lowest) / step)
    if n < 0 or step <= 0:
        raise ValueError("no heights to cast shadows from")
    metres = F.explode(F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: F.lit(float(lowest)) + i * F.lit(float(step)))).alias("metres")
    moved = found.select(*keys, "line", "start", "stop", height.alias("tall"), width.alias("wide"), per_metre[0].alias("dy"), per_metre[1].alias("dx"), metres)
    by = lambda c: F.floor(F.col("metres") * F.col(c) + 0.5)
    moved = moved.select(*keys, (F.col("line") + by("dy")).alias("line"), F.greatest(F.col("start") + by("dx"), F.lit(0)).alias("start"), F.least(F.col("stop") + by("dx"), F.col("wide")).alias("stop"), "tall")
    inside = moved.where("line >= 0 and line < tall and start < stop").groupBy(*keys, "line", "start").agg(F.max("stop").alias("stop"))
    return united(inside, keys)


def united(found: DataFrame, keys: list[str]) -> DataFrame:
    """Runs of each line joined where they overlap or touch; a line's runs are as many as it has columns at most."""
    listed = found.groupBy(*keys, "line").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("r"))
    empty = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    wide = F.transform("r", lambda x: F.struct(x["start"].cast("long").alias("start"), x["stop"].cast("long").alias("stop")))

    def add(done, x):
        last = F.element_at(done, -1)
        more = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["stop"], x["stop"]).alias("stop"))))
        return F.when(F.size(done) == 0, F.array(x)).when(x["start"] <= last["stop"], more).otherwise(F.concat(done, F.array(x)))

    return listed.select(*keys, "line", F.inline(F.aggregate(wide, empty, add)))
