"""Column helpers shared by all operators.

NaN marks NoData in radiance and is never NULL. Spark ranks NaN above every
number and equal to itself, so every minimum, sum or comparison over radiance
must first pass `is_valid`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITY = float("inf")


def nan(kind: str = "float") -> Column:
    return F.lit(float("nan")).cast(kind)


def real(value) -> Column:
    """A single-precision operand; literals must be cast too, or Spark computes in double."""
    return (value if isinstance(value, Column) else F.lit(value)).cast("float")


def is_valid(x: Column) -> Column:
    """Neither NaN nor infinite (nor null)."""
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(INFINITY))


def is_infinite(x: Column) -> Column:
    return F.abs(x) == F.lit(INFINITY)


def valid_or_null(x: Column) -> Column:
    return F.when(is_valid(x), x)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole in double, 0 where the whole is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / F.when(whole != 0, whole).cast("double"))


def optional_double(text: Column, default: float = 0.0) -> Column:
    """A number that may be absent or null; anything else must be a number (an ANSI cast raises on junk)."""
    return F.coalesce(text.cast("double"), F.lit(default))


def stretch(x: Column, low: Column, high: Column) -> Column:
    """Contrast stretch to 0..1; `low` is null where a channel has no valid pixel, which gives 0.

    A channel without range is stretched over one unit, and NaN stays NaN.
    """
    top = F.when(high <= low, low + 1.0).otherwise(high)
    scaled = (x - low) / (top - low)
    return F.when(low.isNull(), F.lit(0.0)).when(F.isnan(x), nan("double")).otherwise(F.least(F.greatest(scaled, F.lit(0.0)), F.lit(1.0)))


def to_byte(x: Column) -> Column:
    """0..1 to 0..255, truncated; NaN is black."""
    return (F.least(F.greatest(F.nanvl(x, F.lit(0.0)), F.lit(0.0)), F.lit(1.0)) * 255).cast("int")


def micrometres(nanometres: Column) -> Column:
    return F.when(is_valid(nanometres), F.bround(nanometres / 1000.0, 4))


def item_id(scene: Column, level: Column) -> Column:
    return F.concat_ws("_", scene, level)
