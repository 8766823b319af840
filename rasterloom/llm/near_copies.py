"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

SimHash proposes links first: five-word fingerprints, searched with BK-trees as
in `simhash`. At a similarity of 0.8 two fingerprints differ in some ten of 64
bits, far beyond a radius that any exact search of Hamming balls can afford,
so most such links would be missed. MinHash bands therefore complete the
candidates: a pair at 0.8 shares none of the 32 bands of five once in 300,000
times. Every link is confirmed on the whole shingle sets.

Each text of a bucket first meets the bucket's most central text, that which
shares the most buckets with others; this joins large groups at a linear cost.
What is still outside the main group then meets all others: pair by pair in
buckets of a few texts; larger buckets with the same central text are taken
together and compared in blocks inside a task. So no candidate goes unseen, no
list of a large bucket's pairs is written, and texts that share many buckets
are compared once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash
from ._common import arrow_map, cut, partitions, slices
from ._graph import connected_components

WIDTH, SIMILARITY = 5, 0.8
BANDS, ROWS = 32, 5
#: Shingles that are hashed at once.
CHUNK = 50_000
#: Texts of a block that asks, and of a block that answers.
ASKING, ANSWERING = 64, 128
#: Buckets up to this size are compared as pairs.
SMALL = 12
#: Distinct shingles that a product of two blocks takes at once.
COLUMNS = 4096


def _hashes(text: str | None) -> np.ndarray:
    """Hashes of all shingles of a text, repeats included."""
    pieces = [np.array(own, dtype=np.uint64) for own in simhash.shingle_hashes(text, WIDTH)]
    return np.concatenate(pieces) if pieces else np.zeros(0, np.uint64)


def _buckets(sets: list[np.ndarray]) -> np.ndarray:
    """(text, band): one number per band from the least of each of its hash functions; no set is empty."""
    draw = np.random.default_rng(42)
    times, plus = (draw.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) for _ in range(2))
    hashes = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    found = np.zeros((len(sets), BANDS), dtype=np.uint64)
    for band in range(BANDS):
        key = np.full(len(sets), band + 1, dtype=np.uint64)
        for i in range(band * ROWS, (band + 1) * ROWS):
            mixed = (hashes ^ plus[i]) * (times[i] | np.uint64(1))
            least = np.minimum.reduceat(mixed ^ (mixed >> np.uint64(32)), starts)
            key = (key ^ least) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        found[:, band] = key
    return found.view(np.int64)


def _entries(texts: DataFrame) -> DataFrame:
    """(node, bucket), for each band of each text that has words."""

    def run(batches):
        def settle():
            nodes = np.array([n for n, _ in held], dtype=np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(nodes, BANDS)), pa.array(_buckets([s for _, s in held]).ravel())], ["node", "bucket"])

        for part in slices(batches):
            held, size = [], 0
            for node, text in zip(part.column("node").to_pylist(), part.column("text").to_pylist(), strict=True):
                own = _hashes(text)
                if len(own):
                    held.append((node, own))
                    size += len(own)
                if size > CHUNK:
                    yield settle()
                    held, size = [], 0
            if held:
                yield settle()

    return arrow_map(texts, run, "node long, bucket long")


def _sets(texts: DataFrame) -> DataFrame:
    """(node, shingles): the distinct shingle hashes, in order."""

    def run(batches):
        for part in slices(batches):
            found = [np.unique(_hashes(x)).view(np.int64) for x in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(found, pa.list_(pa.int64()))], ["node", "shingles"])

    return arrow_map(texts, run, "node long, shingles array<long>")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) that are as similar as wanted; a pair whose sizes rule it out is not compared."""
    left, right = (sets.select(F.col("node").alias(x), F.col("shingles").alias(f"s{x}")) for x in "uv")
    both = pairs.join(left, "u").join(right, "v").withColumn("nu", F.size("su")).withColumn("nv", F.size("sv"))
    possible = F.least("nu", "nv") >= SIMILARITY * F.greatest("nu", "nv")
    same = F.when(possible, F.size(F.array_intersect("su", "sv"))).otherwise(0)
    return both.withColumn("same", same).where(F.col("same") >= SIMILARITY * (F.col("nu") + F.col("nv") - F.col("same"))).select("u", "v")


def _block_links(key, table):
    """Stars of the links between the texts of a block that ask and those that answer."""
    nodes = table.column("node").to_numpy()
    lists = table.column("shingles").combine_chunks()
    flat = lists.flatten().to_numpy()
    sizes = np.diff(lists.offsets.to_numpy())
    row = np.repeat(np.arange(len(nodes)), sizes)
    asks = np.flatnonzero(table.column("asks").to_numpy(zero_copy_only=False))
    words = np.unique(flat[np.isin(row, asks)])
    column = np.searchsorted(words, flat)
    known = words[np.minimum(column, len(words) - 1)] == flat
    row, column = row[known], column[known]
    same = np.zeros((len(asks), len(nodes)), dtype=np.float32)
    for first in range(0, len(words), COLUMNS):  # counts are small, so single precision holds them exactly
        part = (column >= first) & (column < first + COLUMNS)
        holds = np.zeros((len(nodes), min(COLUMNS, len(words) - first)), dtype=np.float32)
        holds[row[part], column[part] - first] = 1
        same += holds[asks] @ holds.T
    near = same >= SIMILARITY * (sizes[asks][:, None] + sizes[None, :] - same)
    near[nodes[asks][:, None] == nodes[None, :]] = False
    one, other = np.nonzero(near)
    label = simhash._merge(np.arange(len(nodes)), asks[one], other)
    linked = np.flatnonzero(label != np.arange(len(nodes)))
    return pa.table({"u": nodes[linked], "v": nodes[label[linked]]})


def _outside(members: DataFrame) -> DataFrame:
    """Members (cluster, node, label) of clusters with several labels, with the most frequent one (`major`) and numbers of blocks."""
    counts = members.groupBy("cluster", "label").agg(F.count("*").alias("n"))
    mixed = counts.groupBy("cluster").agg(F.max_by("label", F.struct("n", "label")).alias("major"), F.max("n").alias("most"), F.sum("n").alias("n"), F.count("*").alias("k")).where("k > 1")
    mixed = mixed.select(
        "cluster", "major", F.ceil((F.col("n") - F.col("most")) / ASKING).cast("int").alias("askers"), F.ceil(F.col("n") / ANSWERING).cast("int").alias("answerers")
    ).repartition(partitions(members.sparkSession))  # dealt anew, so that Spark can split a large cluster
    return members.join(mixed, "cluster")


def _rest(shared: DataFrame, labels: DataFrame, known: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of texts that are outside the largest group of a bucket with any text of the bucket; `known` pairs are not compared again."""
    placed = cut(shared.join(labels, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component"))

    few = cut(_outside(placed.where(F.col("n") <= SMALL).select(F.col("bucket").alias("cluster"), "node", "label")))
    one = few.where("label <> major").select("cluster", F.col("node").alias("a"), F.col("label").alias("la"))
    other = few.select("cluster", F.col("node").alias("b"), F.col("label").alias("lb"), "major")
    pairs = one.join(other, "cluster").where("la <> lb and (lb = major or a < b)").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()
    linked = _confirmed(pairs.join(known, ["u", "v"], "left_anti"), sets)

    many = cut(_outside(placed.where(F.col("n") > SMALL).select(F.col("pivot").alias("cluster"), "node", "label").distinct()))
    place = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "node"), F.col(n)).cast("int")
    asking = many.where("label <> major").select("cluster", "node", F.lit(True).alias("asks"), place(1, "askers").alias("a"), F.explode(F.sequence(F.lit(0), F.col("answerers") - 1)).alias("b"))
    answering = many.select("cluster", "node", F.lit(False).alias("asks"), F.explode(F.sequence(F.lit(0), F.col("askers") - 1)).alias("a"), place(2, "answerers").alias("b"))
    blocks = asking.unionByName(answering).join(sets, "node")
    return linked.unionByName(blocks.groupBy("cluster", "a", "b").applyInArrow(_block_links, "u long, v long"))


def groups(texts: DataFrame) -> DataFrame:
    """From (node long, text), one row per distinct text, to (node, component) of all texts that have a near copy.

    A text without words is near to none. A long text is hashed piece by
    piece; its set of hashes is held whole. The table may be empty.
    """
    spark = texts.sparkSession
    prints = cut(simhash.fingerprints(texts, id_col="node", width=WIDTH))
    first = cut(prints.groupBy("fp").agg(F.min("node").alias("first"), F.count("*").alias("n")))
    close = simhash.links(first.select("fp"), 4)
    ends = first.select("fp", "first")
    proposed = close.join(ends.select(F.col("fp").alias("u"), F.col("first").alias("a")), "u").join(ends.select(F.col("fp").alias("v"), F.col("first").alias("b")), "v").select("a", "b")
    twice = first.where("n > 1").select("fp", "first").repartition(partitions(spark))
    proposed = proposed.unionByName(prints.join(twice, "fp").where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b")))

    entries = cut(_entries(texts))
    sizes = entries.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").repartition(partitions(spark))
    shared = entries.join(sizes, "bucket").select("bucket", "node", "n")
    central = shared.groupBy("node").agg(F.sum("n").alias("c"))
    pivots = shared.join(central, "node").groupBy("bucket").agg(F.max_by("node", F.struct("c", "node")).alias("pivot")).repartition(partitions(spark))
    shared = cut(shared.join(pivots, "bucket"))
    stars = shared.where("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b"))

    ordered = (F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
    pairs = cut(proposed.unionByName(stars).select(*ordered).distinct())
    needed = pairs.select(F.explode(F.array("u", "v")).alias("node")).unionByName(shared.select("node")).distinct()
    sets = cut(_sets(texts.join(needed, "node", "left_semi").select("node", "text")).where(F.size("shingles") > 0))
    near = cut(_confirmed(pairs, sets))
    more = _rest(shared, connected_components(near), pairs, sets)
    return connected_components(near.unionByName(more))
