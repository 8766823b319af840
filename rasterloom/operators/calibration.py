"""Choosing calibration entries and turning counts into radiance."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.models import LINE_MODELS, MODELS, dark_signal, radiance

#: What identifies a calibration entry.
ENTRY_KEY = ["band", "start_row", "tdi"]
#: Per-column arrays of an entry and the names that models know them by.
ARRAYS = {"non_uniformity": "non_uniformity", "thermal_intercept": "intercept", "thermal_gradient": "gradient"}
SCALARS = ("absolute", "absolute_offset")


def first_entries(entries: DataFrame, keys: list[str] = ENTRY_KEY) -> DataFrame:
    """Of entries with the same key the first in document order (`ord`)."""
    first = Window.partitionBy(*keys).orderBy("ord")
    return entries.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def last_uuids(entries: DataFrame, keys: list[str]) -> DataFrame:
    """The uuid that provenance names for each band: that of the last entry in document order, used or not."""
    return entries.groupBy(*keys).agg(F.max_by("uuid", "ord").alias("uuid"))


def look_up(bands: DataFrame, entries: DataFrame, scope: list[str]) -> DataFrame:
    """Each band with its entry for exactly its start row and TDI setting; a band without one is an error when its row is read."""
    keys = [*scope, *ENTRY_KEY]
    found = bands.join(first_entries(entries, keys), keys, "left")
    name = F.concat(F.lit("no calibration entry for band "), F.col("band"), F.lit(" start row "), F.col("start_row").cast("string"), F.lit(" tdi "), F.col("tdi").cast("string"))
    return found.withColumn("absolute", F.when(F.col("non_uniformity").isNull(), F.raise_error(name).cast("double")).otherwise(F.col("absolute")))


def look_up_nearest(bands: DataFrame, entries: DataFrame, scope: list[str]) -> DataFrame:
    """As `look_up`, but a band without an exact entry takes the one with the nearest setting (then the first)."""
    renamed = first_entries(entries, [*scope, *ENTRY_KEY]).withColumnsRenamed({"start_row": "_row", "tdi": "_tdi"})
    far = F.abs(F.col("_tdi") - F.col("tdi")) * 65_536 + F.abs(F.col("_row") - F.col("start_row"))
    order = Window.partitionBy(*scope, "band", "band_id").orderBy(far, "ord")
    return bands.join(renamed, [*scope, "band"]).withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n", "_row", "_tdi")


def check_lines(lines: DataFrame) -> DataFrame:
    """Lines (with `dn`, `line`, `height` and the entry's arrays); an error for a line whose width or place does not fit."""
    width = F.size("non_uniformity")
    fits = (F.size("dn") == width) & (F.size("thermal_intercept") == width) & (F.size("thermal_gradient") == width)
    inside = (F.col("line") >= 0) & (F.col("line") < F.col("height"))
    message = F.when(~fits, F.lit("line width differs from the calibration entry")).otherwise(F.lit("line outside the band"))
    return lines.withColumn("dn", F.when(fits & inside, F.col("dn")).otherwise(F.raise_error(message).cast("array<int>")))


def to_pixels(lines: DataFrame, keep: list[str]) -> DataFrame:
    """One row per pixel (keep, col, dn, intercept, gradient, non_uniformity); arrays are walked side by side, no join is needed."""
    zipped = F.arrays_zip(F.col("dn").alias("dn"), *[F.col(a).alias(n) for a, n in ARRAYS.items()])
    return lines.select(*keep, F.posexplode(zipped).alias("col", "px")).select(*keep, "col", "px.*")


def calibrate_pixels(pixels: DataFrame, *, model: str = "linear_thermal", fill: float = float("nan")) -> DataFrame:
    """Add `radiance` to pixel rows that carry dn, t, nodata and the coefficients."""
    names = [c for c in (*ARRAYS.values(), *SCALARS, "polynomial") if c in pixels.columns]
    value = radiance(model, F.col("dn"), F.col("t"), {c: F.col(c) for c in names}, F.col("nodata"), fill)
    return pixels.withColumn("radiance", value)


def calibrate_lines(lines: DataFrame, *, model: str = "linear_thermal", fill: float = float("nan"), keep_dn: bool = False) -> DataFrame:
    """Line form: replace `dn` and the coefficient arrays by an array `radiance`, without a row per pixel; `keep_dn` leaves the counts.

    A model of `LINE_MODELS` runs on blocks of lines as arrays. Any other is
    evaluated element by element, which Spark does not compile.
    """
    if model not in MODELS:
        raise KeyError(model)
    if model in LINE_MODELS:
        return _calibrate_blocks(lines, LINE_MODELS[model], fill, keep_dn)
    zipped = F.arrays_zip(F.col("dn").alias("dn"), *[F.col(a).alias(n) for a, n in ARRAYS.items()])

    def one(px):
        coefficients = {n: px[n] for n in ARRAYS.values()} | {c: F.col(c) for c in SCALARS}
        if "polynomial" in lines.columns:
            coefficients["polynomial"] = F.col("polynomial")
        return radiance(model, px["dn"], F.col("t"), coefficients, F.col("nodata"), fill)

    return lines.withColumn("radiance", F.transform(zipped, one)).drop(*([] if keep_dn else ["dn"]), *ARRAYS)


def _calibrate_blocks(lines: DataFrame, model, fill: float, keep_dn: bool) -> DataFrame:
    once = [*SCALARS, "t"]
    kept = [c for c in lines.columns if c not in (*ARRAYS, *([] if keep_dn else ["dn"]))]
    nodata = F.col("nodata").cast("double")
    asked = lines.select(
        *[F.col(c).alias(f"k{i}") for i, c in enumerate(kept)], F.col("dn").alias("dn"), nodata.alias("nodata"),
        *[F.col(c).cast("array<float>").alias(c) for c in ARRAYS], *[F.col(c).cast("float").alias(c) for c in once],
    )
    names = [f"k{i}" for i in range(len(kept))]

    def rows(column, kind):
        """Lines of one width as an array, nulls as NaN."""
        lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        flat = lists.flatten()
        values = flat.cast(pa.float32()) if kind == np.float32 and flat.null_count else flat
        width = len(flat) // max(1, len(lists))
        if len(flat) != width * len(lists) or (np.diff(lists.offsets.to_numpy()) != width).any():
            raise ValueError("lines of one block differ in width")
        return values.to_numpy(zero_copy_only=False).reshape(len(lists), width)

    def run(batches):
        for batch in batches:
            widths = pa.compute.fill_null(pa.compute.list_value_length(batch.column("dn")), -1).to_numpy(zero_copy_only=False)
            for first, stop in blocks(widths):
                part = batch.slice(first, stop - first)
                counts = rows(part.column("dn"), None)
                column = {c: part.column(c).to_numpy(zero_copy_only=False).astype(np.float32)[:, None] for c in once}
                arrays = {n: rows(part.column(a), np.float32).astype(np.float32) for a, n in ARRAYS.items()}
                with np.errstate(all="ignore"):
                    value = model(counts.astype(np.float32), column["t"], arrays | {c: column[c] for c in SCALARS})
                empty = counts == part.column("nodata").to_numpy(zero_copy_only=False)[:, None]  # a null NoData is NaN here and matches nothing
                value = np.where(empty, np.float32(fill), value)
                offsets = np.arange(0, value.size + 1, max(1, value.shape[1]), dtype=np.int32) if value.size else np.zeros(len(part) + 1, np.int32)
                out = pa.ListArray.from_arrays(pa.array(offsets), pa.array(value.ravel(), pa.float32()))
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), out], [*names, "radiance"])

    def blocks(widths):
        """Neighbouring lines of equal width, of some millions of pixels at most."""
        first = 0
        for i in range(1, len(widths) + 1):
            if i == len(widths) or widths[i] != widths[first] or (i - first) * widths[first] >= 1 << 21:
                yield first, i
                first = i

    schema = ", ".join([*(f"{n} {asked.schema[n].dataType.simpleString()}" for n in names), "radiance array<float>"])
    return asked.mapInArrow(run, schema).select(*[F.col(n).alias(c) for n, c in zip(names, kept, strict=True)], "radiance")


def dark_pixels(pixels: DataFrame) -> DataFrame:
    """Add `dark`, the dark signal alone."""
    return pixels.withColumn("dark", dark_signal(F.col("t"), {c: F.col(c) for c in ("intercept", "gradient")}))
