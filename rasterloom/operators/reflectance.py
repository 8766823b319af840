"""From radiance to reflectance: band solar irradiance, top of atmosphere, surface, and a simple mask."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def solar_irradiance(spectrum: DataFrame, response: DataFrame, keys: list[str], scale: float = 1000.0) -> DataFrame:
    """(keys, esun): the spectrum (wavelength, irradiance) averaged with each band's response (keys, wavelength, response).

    `scale` turns per-nanometre into per-micrometre. A band without response is null.
    """
    joined = response.join(spectrum, "wavelength")
    total = F.sum("response")
    return joined.groupBy(*keys).agg((F.sum(F.col("irradiance") * F.col("response")) / F.when(total != 0, total) * scale).alias("esun"))


def top_of_atmosphere(radiance: Column, esun: Column, sun_distance: Column, sun_zenith_deg: Column) -> Column:
    """pi * L * d^2 / (ESUN * cos zenith)."""
    return F.lit(math.pi) * radiance * sun_distance * sun_distance / (esun * F.cos(F.radians(sun_zenith_deg)))


def surface(radiance: Column, xa: Column, xb: Column, xc: Column) -> Column:
    """y / (1 + xc * y) with y = xa * L - xb, the coefficients of an atmospheric model."""
    y = xa * radiance - xb
    return y / (1 + xc * y)


def scene_mask(blue: Column, red: Column, near_infrared: Column, bright: float = 0.25, dark: float = 0.05) -> Column:
    """cloud, shadow, glint or clear, by reflectance thresholds."""
    return (
        F.when((blue > bright) & (red > bright) & (near_infrared > bright), "cloud")
        .when((blue < dark) & (red < dark) & (near_infrared < dark), "shadow")
        .when((near_infrared > bright) & (blue > bright), "glint")
        .otherwise("clear")
    )
