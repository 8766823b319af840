"""Bringing rows that ask to what they ask about, when one key may be asked about by very many."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def answer(asking: DataFrame, held: DataFrame, keys: list[str], spread: list[str], most: int, function: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Apply `function` to the rows of both tables that share `keys`.

    Rows that ask are dealt, by the columns `spread`, into slices of about
    `most` rows a key; what is held under the key goes to every slice, so no
    task holds all that ask. Keys that nobody asks about are left out.
    """
    sizes = asking.groupBy(*keys).agg(F.ceil(F.count("*") / most).cast("int").alias("_slices"))
    dealt = asking.join(sizes, keys).withColumn("_slice", F.pmod(F.xxhash64(*spread), F.col("_slices").cast("long")).cast("int")).drop("_slices")
    copies = held.join(sizes, keys).withColumn("_slice", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1))).drop("_slices")
    return dealt.groupBy(*keys, "_slice").cogroup(copies.groupBy(*keys, "_slice")).applyInArrow(function, schema)
