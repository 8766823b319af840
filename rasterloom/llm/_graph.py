"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import cut, partitions


def _with_least_neighbour(pairs: DataFrame) -> DataFrame:
    """Add to each (u, v) the least of u and all its neighbours; the minimum is combined before the shuffle."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # dealt anew, so that the join does not inherit the grouping's partitions and Spark can split a node with many neighbours
    least = least.repartition(partitions(pairs.sparkSession))
    return pairs.join(least, "u")


def connected_components(edges: DataFrame) -> DataFrame:
    """From edges (u long, v long) to (node, component): each linked node with the least node it can reach.

    Self links and repeated edges are allowed; nodes without a link to another
    node get no row. Each round ends in a checkpoint, so lineage stays short
    and no node, edge or label reaches the driver but for two sums. Rounds go
    on until nothing changes, some log(longest chain) of them.
    """
    now = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (state["n"], state["h"]) == seen or state["n"] == 0:
            break
        seen = (state["n"], state["h"])
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least_neighbour(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = _with_least_neighbour(large)
        now = cut(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
            .distinct()
        )
    pairs = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return pairs.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
