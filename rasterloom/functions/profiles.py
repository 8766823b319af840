"""Sensor profiles: which model a sensor's bands take, under what names, and by what their calibration entries are found.

An entry's coefficients are one map of named arrays (a single number is an
array of one), so entries of sensors with different models are rows of one
table. A profile is a row too: several sensors, each with its own model and
key, are calibrated in one plan.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .models import CONTAINER_MODELS

CONTAINER = "map<string,array<double>>"


@dataclass(frozen=True)
class Profile:
    """`parameters` gives the name in the container of each of the model's coefficients, where they differ; `keys` are the columns that an entry must share with a band."""

    sensor: str
    model: str
    keys: tuple[str, ...] = ("band", "start_row", "tdi")
    parameters: dict[str, str] = field(default_factory=dict)
    fill: float = float("nan")


def profile_table(spark: SparkSession, profiles: Iterable[Profile]) -> DataFrame:
    """(sensor, model, keys, parameters, fill); an unknown model is an error."""
    rows = [(p.sensor, p.model, list(p.keys), dict(p.parameters), p.fill) for p in profiles]
    if unknown := sorted({r[1] for r in rows} - set(CONTAINER_MODELS)):
        raise KeyError(f"no such models: {unknown}")
    return spark.createDataFrame(rows, "sensor string, model string, keys array<string>, parameters map<string,string>, fill double")


def container(entries: DataFrame, arrays: Iterable[str] = ("non_uniformity", "thermal_intercept", "thermal_gradient", "polynomial"), scalars: Iterable[str] = ("absolute", "absolute_offset")) -> DataFrame:
    """Replace the coefficient columns of calibration entries by one map, `coefficients`; nulls are left out. Other schemas bring their own adapter."""
    arrays, scalars = ([c for c in names if c in entries.columns] for names in (arrays, scalars))
    pairs = [F.struct(F.lit(c).alias("key"), F.col(c).cast("array<double>").alias("value")) for c in arrays]
    pairs += [F.struct(F.lit(c).alias("key"), F.when(F.col(c).isNotNull(), F.array(F.col(c).cast("double"))).alias("value")) for c in scalars]
    held = F.map_from_entries(F.filter(F.array(*pairs), lambda p: p["value"].isNotNull()))
    return entries.withColumn("coefficients", held).drop(*arrays, *scalars)


def _key(rows: DataFrame) -> F.Column:
    """The values of the columns that the profile names, in its order; a name that the rows lack is null and finds nothing."""
    plain = [f.name for f in rows.schema if f.dataType.typeName() in ("string", "byte", "short", "integer", "long", "double", "float") and f.name not in ("sensor", "model", "fill")]
    values = F.create_map(*[x for c in plain for x in (F.lit(c), F.col(c).cast("string"))])
    return F.transform("keys", lambda k: F.element_at(values, k))


def look_up(bands: DataFrame, entries: DataFrame, profiles: DataFrame) -> DataFrame:
    """Bands (sensor, ...) with `model`, `parameters`, `fill` and the `coefficients` of their entry: the first, by `ord`, whose key columns are the band's.

    `coefficients` is null for a band without an entry. Bands of a sensor
    without a profile are an error when their row is read.
    """
    known = bands.join(profiles, "sensor", "left")
    known = known.withColumn("model", F.when(F.col("model").isNull(), F.raise_error(F.concat(F.lit("no profile for sensor "), "sensor"))).otherwise(F.col("model")))
    keyed = known.withColumn("_key", _key(known.select(*bands.columns, "keys")))
    offered = entries.join(profiles.select("sensor", "keys"), "sensor")
    offered = offered.withColumn("_key", _key(offered)).groupBy("sensor", "_key").agg(F.min_by("coefficients", "ord").alias("coefficients"))
    return keyed.join(offered, ["sensor", "_key"], "left").drop("_key", "keys")


def _arrays(column: pa.MapArray, row: int) -> dict[str, np.ndarray]:
    """The named arrays of one row, in single precision."""
    if not column[row].is_valid:
        raise ValueError("a band has no coefficients")
    a, b = column.offsets[row].as_py(), column.offsets[row + 1].as_py()
    items = column.items
    return {column.keys[i].as_py(): items[i].values.to_numpy(zero_copy_only=False).astype(np.float32) for i in range(a, b)}


def calibrate_lines(lines: DataFrame, unit: list[str]) -> DataFrame:
    """Replace `dn`, `coefficients`, `parameters`, `model`, `fill` of lines by `radiance`.

    `unit` are the columns that say whose coefficients a line has: neighbouring
    lines alike in them are worked on together. Besides, lines have `t` and
    `nodata` (null: matches nothing). All is done in single precision.
    """
    taken = ("dn", "coefficients", "parameters", "model", "fill")
    kept = [c for c in lines.columns if c not in taken]
    code = F.xxhash64(*unit, "model")
    asked = lines.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(kept)], "dn", F.col("coefficients").cast(CONTAINER).alias("coefficients"), "parameters", "model", F.col("fill").cast("double").alias("fill"), F.col("t").cast("float").alias("t"), F.col("nodata").cast("double").alias("nodata"), code.alias("unit"))
    names = [f"k{i}" for i in range(len(kept))]

    def run(batches):
        for batch in batches:
            widths = batch.column("dn").value_lengths().to_numpy(zero_copy_only=False)
            change = np.flatnonzero((np.diff(batch.column("unit").to_numpy(), prepend=0) != 0) | (np.diff(widths, prepend=-1) != 0))
            for first, stop in zip(change, np.append(change[1:], batch.num_rows), strict=True) if batch.num_rows else ():
                part = batch.slice(int(first), int(stop - first))
                names_of = dict(part.column("parameters")[0].as_py() or [])
                held = _arrays(part.column("coefficients"), 0)
                needed, function = CONTAINER_MODELS[part.column("model")[0].as_py()]
                if lacking := [n for n in needed if names_of.get(n, n) not in held]:
                    raise ValueError(f"coefficients lack {lacking}")
                c = {n: held[names_of.get(n, n)] for n in needed}
                counts = part.column("dn").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                if any(len(v) not in (1, counts.shape[1]) for n, v in c.items() if n in ("non_uniformity", "intercept", "gradient")):
                    raise ValueError("line width differs from the calibration entry")
                with np.errstate(all="ignore"):
                    value = function(counts.astype(np.float32), part.column("t").to_numpy(zero_copy_only=False).astype(np.float32)[:, None], c)
                empty = counts == part.column("nodata").to_numpy(zero_copy_only=False)[:, None]
                value = np.where(empty, np.float32(part.column("fill")[0].as_py()), value).astype(np.float32)
                offsets = np.arange(part.num_rows + 1, dtype=np.int32) * counts.shape[1]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.ListArray.from_arrays(pa.array(offsets), pa.array(value.ravel()))], [*names, "radiance"])

    schema = ", ".join([*(f"{n} {asked.schema[n].dataType.simpleString()}" for n in names), "radiance array<float>"])
    return asked.mapInArrow(run, schema).select(*[F.col(n).alias(c) for n, c in zip(names, kept, strict=True)], "radiance")
