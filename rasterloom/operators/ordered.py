"""Places and neighbours along an order, without one task per key.

Rows of a key are cut into ranges of the order. What happens inside a range is
a window over it; what passes from range to range is a window over one row a
range, so a key with any number of rows spreads over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def places(rows: DataFrame, keys: list[str], order: str, *, name: str = "place", count: str | None = None, span: int = 65_536) -> DataFrame:
    """Add the place (from 0) of each row among those of its key by the whole number `order`, and with `count` how many there are.

    `order` must tell the rows of a key apart, or equal ones get places in any order.
    """
    cut = rows.withColumn("_range", F.floor(F.col(order) / span))
    sizes = cut.groupBy(*keys, "_range").agg(F.count("*").alias("_n"))
    every = Window.partitionBy(*keys)
    held = sizes.select(*keys, "_range", (F.sum("_n").over(every.orderBy("_range")) - F.col("_n")).alias("_before"), F.sum("_n").over(every).alias("_count"))
    inside = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(order)) - 1
    joined = cut.withColumn("_inside", inside).join(held, [*keys, "_range"])
    more = {name: F.col("_before") + F.col("_inside")} | ({count: F.col("_count")} if count else {})
    return joined.withColumns(more).drop("_range", "_before", "_inside", "_count")


def neighbours(points: DataFrame, keys: list[str], x: str, tie: list[str], known: Column, value: Column, *, span: float) -> DataFrame:
    """Add `before`, the `value` of the last known row at or before each row, and `after`, that of the first known row behind it.

    Rows are ordered by `x`, then `tie`; `known` says which of them have a value.
    """
    cut = points.withColumn("_range", F.floor(F.col(x) / span)).withColumn("_value", F.when(known, value))
    inside = Window.partitionBy(*keys, "_range")
    along = inside.orderBy(x, *tie).rowsBetween(Window.unboundedPreceding, 0)
    # looking ahead is looking back in the opposite order: a running frame, where one that ends at infinity is read anew for each row
    ahead = inside.orderBy(F.desc(x), *map(F.desc, tie)).rowsBetween(Window.unboundedPreceding, -1)
    near = cut.withColumn("before", F.last("_value", True).over(along)).withColumn("after", F.last("_value", True).over(ahead))
    place = F.when(known, F.struct(x, *tie))
    ends = cut.groupBy(*keys, "_range").agg(F.min_by("_value", place).alias("_first"), F.max_by("_value", place).alias("_last"))
    ranges = Window.partitionBy(*keys)
    ends = ends.select(
        *keys, "_range",
        F.last("_last", True).over(ranges.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)).alias("_earlier"),
        F.last("_first", True).over(ranges.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)).alias("_later"),
    )
    joined = near.join(ends, [*keys, "_range"])
    return joined.withColumns({"before": F.coalesce("before", "_earlier"), "after": F.coalesce("after", "_later")}).drop("_range", "_value", "_earlier", "_later")
