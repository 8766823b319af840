"""Radiometric quality: statistics per band, flags, verdict.

Everything is built from mergeable aggregates, so Spark combines partial
results before the one small shuffle on the band.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.columns import is_infinite, is_valid, nan, ratio

#: Flags in the order in which a report lists them.
FLAGS = ("all_invalid", "zero_dynamic_range", "high_nodata", "negative_radiance", "non_finite_values", "saturation")


@dataclass(frozen=True)
class Thresholds:
    saturation_dn: int | None = None
    max_negative_fraction: float = 0.05
    max_nodata_fraction: float = 0.50


def statistics(thresholds: Thresholds = Thresholds(), radiance: str = "radiance", dn: str | None = "dn") -> list[Column]:
    """Aggregates of a band's pixels; `saturated` (over all pixels, by count) only if a threshold is set and counts are there."""
    x = F.col(radiance).cast("double")
    ok = is_valid(x)
    good = F.when(ok, x)
    out = [
        F.count(F.lit(1)).alias("pixels"),
        F.count_if(ok).alias("valid"),
        F.count_if(F.isnan(x)).alias("nodata"),
        F.count_if(is_infinite(x)).alias("non_finite"),
        F.count_if(ok & (x < 0)).alias("negative"),
        F.coalesce(F.min(good), nan("double")).alias("min"),
        F.coalesce(F.max(good), nan("double")).alias("max"),
        F.coalesce(F.avg(good), nan("double")).alias("mean"),
        F.coalesce(F.stddev_pop(good), nan("double")).alias("std"),
    ]
    if dn is not None and thresholds.saturation_dn is not None:
        out.append(F.count_if(F.col(dn) >= thresholds.saturation_dn).alias("saturated"))
    return out


def with_flags(stats: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Add fractions, the ordered array `flags`, and `passed` (no flag); thresholds are exceeded strictly."""
    rated = stats.withColumns({"nodata_fraction": ratio(F.col("nodata"), F.col("pixels")), "negative_fraction": ratio(F.col("negative"), F.col("valid"))})
    raised = {
        "all_invalid": F.col("valid") == 0,
        "zero_dynamic_range": (F.col("valid") > 0) & (F.col("max") == F.col("min")),
        "high_nodata": F.col("nodata_fraction") > thresholds.max_nodata_fraction,
        "negative_radiance": F.col("negative_fraction") > thresholds.max_negative_fraction,
        "non_finite_values": F.col("non_finite") > 0,
        "saturation": F.col("saturated") > 0 if "saturated" in stats.columns else F.lit(False),
    }
    flags = F.array_compact(F.array(*[F.when(raised[name], F.lit(name)) for name in FLAGS]))
    return rated.withColumn("flags", flags).withColumn("passed", F.size("flags") == 0)


def band_report(pixels: DataFrame, keys: list[str], thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Statistics and flags per key; counts (`dn`) are used where the pixels have them."""
    dn = "dn" if "dn" in pixels.columns else None
    return with_flags(pixels.groupBy(*keys).agg(*statistics(thresholds, dn=dn)), thresholds)


#: What a partition says of a key: counts, extremes, and mean and sum of squared distances from it.
COUNTS = ("pixels", "valid", "nodata", "non_finite", "negative", "saturated")


def _of_lines(values: np.ndarray, counts: np.ndarray | None, saturation: int | None) -> list:
    """`COUNTS`, least, largest, mean and squares of the pixels of some lines."""
    x = values.astype(np.float64)
    good = x[np.isfinite(x)]
    tallies = [x.size, good.size, int(np.isnan(x).sum()), int(np.isinf(x).sum()), int((good < 0).sum()), 0 if counts is None else int((counts >= saturation).sum())]
    if not good.size:
        return [*tallies, np.inf, -np.inf, 0.0, 0.0]
    mean = good.mean()
    return [*tallies, good.min(), good.max(), mean, np.square(good - mean).sum()]


def _merged(a: list, b: list) -> list:
    """Two such summaries as one."""
    tallies = [x + y for x, y in zip(a[:6], b[:6], strict=True)]
    n, m = a[1], b[1]
    far = b[8] - a[8]
    mean = a[8] + far * (m / (n + m)) if n + m else 0.0
    return [*tallies, min(a[6], b[6]), max(a[7], b[7]), mean, a[9] + b[9] + (far * far * (n * m / (n + m)) if n + m else 0.0)]


def line_report(lines: DataFrame, keys: list[str], thresholds: Thresholds = Thresholds()) -> DataFrame:
    """As `band_report`, from lines as arrays (`radiance`, and `dn` where it is there): a row per partition and key is shuffled, no pixel is one."""
    threshold = thresholds.saturation_dn if "dn" in lines.columns else None
    asked = lines.select(*keys, "radiance", *(["dn"] if threshold is not None else []))

    def run(batches):
        held: dict = {}
        for batch in batches:
            own = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
            first = [0, *(i for i in range(1, len(own)) if own[i] != own[i - 1]), len(own)]
            for a, b in zip(first, first[1:], strict=False):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                counts = part.column("dn").flatten().to_numpy(zero_copy_only=False) if threshold is not None else None
                found = _of_lines(part.column("radiance").flatten().to_numpy(zero_copy_only=False), counts, threshold)
                held[own[a]] = _merged(held[own[a]], found) if own[a] in held else found
        if held:
            columns = [*zip(*held, strict=True), *zip(*held.values(), strict=True)]
            kinds = [*(f.type for f in schema), *[pa.int64()] * 6, *[pa.float64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [*keys, *COUNTS, "low", "high", "mean", "squares"])

    schema = to_arrow_schema(lines.select(*keys).schema)
    kinds = ", ".join(f"`{k}` {lines.schema[k].dataType.simpleString()}" for k in keys)
    parts = asked.mapInArrow(run, f"{kinds}, " + ", ".join(f"{c} long" for c in COUNTS) + ", low double, high double, mean double, squares double")
    start = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("squares"))

    def add(a, b):
        n = a["n"] + b["n"]
        far = b["mean"] - a["mean"]
        return F.when(b["n"] == 0, a).otherwise(F.struct(n.alias("n"), (a["mean"] + far * b["n"] / n).alias("mean"), (a["squares"] + b["squares"] + far * far * a["n"] * b["n"] / n).alias("squares")))

    listed = F.array_sort(F.collect_list(F.struct("mean", F.col("valid").cast("double").alias("n"), "squares")))  # an entry per partition
    whole = parts.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in COUNTS), F.min("low").alias("low"), F.max("high").alias("high"), F.aggregate(listed, start, add).alias("m"))
    some = lambda x: F.when(F.col("valid") > 0, x).otherwise(nan("double"))
    counted = [c for c in COUNTS if c != "saturated" or threshold is not None]
    stats = whole.select(*keys, *[c for c in counted if c != "saturated"], some(F.col("low")).alias("min"), some(F.col("high")).alias("max"), some(F.col("m.mean")).alias("mean"), some(F.sqrt(F.col("m.squares") / F.col("m.n"))).alias("std"), *[c for c in counted if c == "saturated"])
    return with_flags(stats, thresholds)


def verdict(report: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Whether all bands passed; without any band, True."""
    grouped = report.groupBy(*keys) if keys else report.groupBy()
    return grouped.agg(F.coalesce(F.bool_and("passed"), F.lit(True)).alias("passed"), F.count(F.lit(1)).alias("bands"))
