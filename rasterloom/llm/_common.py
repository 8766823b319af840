"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import threading
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters between words: space, and tab to carriage return.
SPACE_CLASS = r"\x20\x09-\x0D"
WORD_PATTERN = rf"[^{SPACE_CLASS}]+"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder of `spark.checkpoint.dir`. Where it is unset, a local session (tests) gets one of its own and a cluster an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="spark-checkpoint-", dir="/tmp"))


#: Seconds after which what Python has let go of is known to the driver's JVM.
SETTLED = 1.5
_looking: list[threading.Timer] = []


def _look_for_unused(sc: SparkContext) -> None:
    """Spark deletes shuffle files, and checkpoints where it is told to, once the driver's JVM has found their owners unused: let it look now and a little later."""

    def look() -> None:
        _looking.clear()
        if sc._jsc is not None:  # else the session has ended
            sc._jvm.System.gc()

    sc._jvm.System.gc()
    if not _looking:
        timer = threading.Timer(SETTLED, look)
        timer.daemon = True
        _looking.append(timer)
        timer.start()


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder and go on from there; the shuffle files behind it can go."""
    ensure_checkpoint_dir(df.sparkSession)
    kept = df.checkpoint(eager=True)
    del df  # else the plan behind it is in use
    _look_for_unused(kept.sparkSession.sparkContext)
    return kept


def partitions(spark: SparkSession) -> int:
    """Partitions of a shuffle, as the session has them now."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bytes of an Arrow batch that goes to a Python worker.
BATCH_BYTES = 8 << 20


def arrow_map(rows: DataFrame, function, schema: str) -> DataFrame:
    """`mapInArrow` with batches bounded in bytes, not only in rows: texts may be long. The bound is a session setting; a tighter one stays."""
    conf, name = rows.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    bound = conf.get(name)  # Spark has a default
    if not bound.isdigit() or not 0 < int(bound) <= BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))
    return rows.mapInArrow(function, schema)


def _give_back() -> None:
    """Return freed memory to the system, as idle workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterable[pa.RecordBatch], text_col: str = "text", limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each piece holds about `limit` bytes of text (one row at least)."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text_col)), 0).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)
    _give_back()
