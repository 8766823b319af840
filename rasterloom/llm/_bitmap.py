"""A bitmap of fixed size over hashed numbers, to leave out rows before a shuffle.

It has no false negatives. However many numbers there are, it takes 8 MB on the
driver and in each executor; the fuller it is, the more it lets through, and
the join that follows decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits, as a power of two.
BITS = 26


def _places(values: np.ndarray) -> np.ndarray:
    x = values.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BITS)


def of(values: DataFrame) -> Broadcast:
    """The bitmap of the one column of `values` (long, no nulls), combined by word before it is collected."""

    def run(batches):
        for batch in batches:
            place = np.unique(_places(batch.column(0).to_numpy()))
            if len(place):
                word, first = np.unique(place >> np.uint64(6), return_index=True)
                bits = np.bitwise_or.reduceat(np.uint64(1) << (place & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int32)), pa.array(bits.view(np.int64))], ["word", "bits"])

    words = values.mapInArrow(run, "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    held = np.zeros(1 << (BITS - 6), dtype=np.uint64)
    held[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return values.sparkSession.sparkContext.broadcast(held)


def holds(bitmap: Broadcast, values: np.ndarray) -> np.ndarray:
    """Which of the numbers may be among those that the bitmap was made of."""
    place = _places(values)
    return (bitmap.value[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
