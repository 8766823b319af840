"""Where intermediate files go that all executors must see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """A new folder name below `spark.checkpoint.dir`. Where that is unset, a local session gets a temporary folder and a cluster an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    if not base:
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-work-", dir="/tmp")
    return f"{base.rstrip('/')}/{uuid.uuid4()}"


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to the checkpoint folder and go on from there; the shuffle files behind it can go."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder(df.sparkSession))
    kept = df.checkpoint(eager=True)
    del df  # else the plan behind it is in use
    sc._jvm.System.gc()  # Spark deletes shuffle files once their owners are found unused
    return kept
