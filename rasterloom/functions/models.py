"""Radiometric models: functions that build a radiance Column from a count, a temperature and coefficients.

Register another model with `register`; plans take the name. A model
may also be given for whole lines as arrays (`LINE_MODELS`), in the same single
precision and the same order of operations, so with the same bits.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import nan, real

#: (count, temperature, coefficients by name) -> radiance, before NoData.
Model = Callable[[Column, Column, dict[str, Column]], Column]
MODELS: dict[str, Model] = {}


def register(name: str) -> Callable[[Model], Model]:
    def put(model: Model) -> Model:
        MODELS[name] = model
        return model

    return put


def dark_signal(temperature: Column, coefficients: dict[str, Column]) -> Column:
    """Counts of an unlit detector at this temperature."""
    return real(coefficients["intercept"]) + real(coefficients["gradient"]) * real(temperature)


def flat_field(count: Column, dark: Column, coefficients: dict[str, Column]) -> Column:
    """Counts above dark, evened out over detectors."""
    return (real(count) - dark) * real(coefficients["non_uniformity"])


@register("linear_thermal")
def linear_thermal(count: Column, temperature: Column, coefficients: dict[str, Column]) -> Column:
    """absolute * ((count - (intercept + gradient * t)) * non_uniformity) + offset, all in single precision."""
    relative = flat_field(count, dark_signal(temperature, coefficients), coefficients)
    return real(coefficients["absolute"]) * relative + real(coefficients["absolute_offset"])


@register("polynomial")
def polynomial(count: Column, temperature: Column, coefficients: dict[str, Column]) -> Column:
    """sum of c[i] * (count - dark) ** i over the array `polynomial`, by Horner's rule in single precision."""
    x = real(count) - dark_signal(temperature, coefficients)
    return F.aggregate(F.reverse(coefficients["polynomial"]), real(0.0), lambda total, c: (total * x + real(c)).cast("float"))


def radiance(model: str, count: Column, temperature: Column, coefficients: dict[str, Column], nodata: Column, fill: float = float("nan")) -> Column:
    """The model's value as float, `fill` where the count equals the band's NoData value; a null NoData matches nothing."""
    value = MODELS[model](count, temperature, coefficients).cast("float")
    empty = nan() if fill != fill else F.lit(fill).cast("float")
    return F.when(count.cast("double") == nodata.cast("double"), empty).otherwise(value)


# ---- whole lines --------------------------------------------------------------------

#: (counts, temperature of each line, coefficients) -> radiance: float32 arrays (lines, columns), or (lines, 1) for what a line has once.
LineModel = Callable[[np.ndarray, np.ndarray, dict[str, np.ndarray]], np.ndarray]


def _above_dark(counts: np.ndarray, temperature: np.ndarray, c: dict[str, np.ndarray]) -> np.ndarray:
    return counts - (c["intercept"] + c["gradient"] * temperature)


def _linear_lines(counts: np.ndarray, temperature: np.ndarray, c: dict[str, np.ndarray]) -> np.ndarray:
    return c["absolute"] * (_above_dark(counts, temperature, c) * c["non_uniformity"]) + c["absolute_offset"]


#: Models that `calibrate_lines` runs on arrays; the others it evaluates as Columns, element by element.
LINE_MODELS: dict[str, LineModel] = {"linear_thermal": _linear_lines}


def _polynomial_lines(counts: np.ndarray, temperature: np.ndarray, c: dict[str, np.ndarray]) -> np.ndarray:
    x = _above_dark(counts, temperature, c)
    total = np.zeros_like(x)
    for coefficient in c["polynomial"][::-1]:
        total = total * x + coefficient
    return total


def _table_lines(counts: np.ndarray, temperature: np.ndarray, c: dict[str, np.ndarray]) -> np.ndarray:
    """Radiance by a table over counts, in between by a straight line, the ends held."""
    return np.interp(counts, c["counts"], c["radiances"]).astype(np.float32)


#: Models over a container of named arrays: the coefficients that they need, and the function. A new sensor's model is one entry here.
CONTAINER_MODELS: dict[str, tuple[tuple[str, ...], LineModel]] = {
    "linear_thermal": (("intercept", "gradient", "non_uniformity", "absolute", "absolute_offset"), _linear_lines),
    "polynomial": (("intercept", "gradient", "polynomial"), _polynomial_lines),
    "table": (("counts", "radiances"), _table_lines),
}
