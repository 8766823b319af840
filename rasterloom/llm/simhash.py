"""SimHash near-duplicate groups, searched with BK-trees.

Each text becomes a 64-bit fingerprint. Equal fingerprints collapse first, so
a group of exact copies is one tree entry. Two fingerprints within `radius`
bits agree in `blocks - radius` of `blocks` bit blocks; one shard per such
choice of agreeing blocks and their value therefore sees every link. A shard's
BK-tree (children keyed by integer distance to the parent, held in flat
arrays) is searched along the edges within the radius only, and a subtree that
already lies in the query's own component is skipped, so a dense group costs
about as much as its size. A shard reports a spanning star of each of its
components, never all pairs; the stars are joined by a distributed
connected-components job.

Trees grow with the corpus, so they are not broadcast: each tree is built in
the task that the shuffle of its shard's fingerprints ends in. A shard of many
fingerprints goes to several tasks, each of which searches its tree for a
share of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import arrow_map, cut, partitions, slices
from ._graph import connected_components

FINGERPRINT_BITS = 64
SEED = 42


BLANK = re.compile(rb"[\x20\x09-\x0d]")
#: Bytes of text that are split into words at once.
PIECE = 1 << 20
#: Fingerprints of a shard that one task searches for.
SHARD = 16_384


def shingle_hashes(text: str | None, width: int, piece: int = PIECE) -> Iterator[list[int]]:
    """Hashes of all shingles, repeats included, some for each piece of the text; none if it has no word."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    digest = xxhash.xxh64_intdigest
    at, held, fresh = 0, [], True
    while at < len(data):
        blank = BLANK.search(data, at + piece) if len(data) - at > piece else None
        stop = blank.start() if blank else len(data)
        words = held + data[at:stop].split()
        at = stop
        if len(words) >= width:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            starts = np.concatenate([[0], ends[: len(words) - width]]).tolist()
            yield [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist(), strict=True)]
            fresh = False
        held = words[max(0, len(words) - width + 1) :]
    if fresh and held:
        yield [digest(b" ".join(held), SEED)]


def _fingerprint_chunk(texts: list[str | None], width: int) -> np.ndarray:
    """Signed 64-bit fingerprints; a text without words has fingerprint 0."""
    totals = np.zeros((len(texts), FINGERPRINT_BITS), dtype=np.int64)
    sizes = np.zeros(len(texts), dtype=np.int64)
    hashes: list[int] = []
    owners: list[int] = []
    counts: list[int] = []

    def settle() -> None:
        if not owners:
            return
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        np.add.at(totals, owners, np.add.reduceat(bits, np.concatenate([[0], np.cumsum(counts)[:-1]]), axis=0, dtype=np.int64))
        np.add.at(sizes, owners, counts)
        hashes.clear(), owners.clear(), counts.clear()

    for i, text in enumerate(texts):
        for own in shingle_hashes(text, width):
            hashes.extend(own)
            owners.append(i)
            counts.append(len(own))
            if len(hashes) > 100_000:
                settle()
    settle()
    return np.packbits(totals * 2 > sizes[:, None], axis=1, bitorder="little").view("<i8").ravel()


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """(id, fp long) for every row; ASCII letters are lower-cased, shingles of `width` words count with repeats."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(_fingerprint_chunk(part.column("text").to_pylist(), width))], ["id", "fp"])

    return arrow_map(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, fp long").withColumnRenamed("id", id_col)


class BKForest:
    """BK-trees of many shards at once, in flat arrays.

    `values` are distinct inside each shard; rows of a shard are contiguous.
    Node i has parent `parent[i]` (-1 at a root) at distance `edge[i]`; the
    children of a node are `children[first[i]:first[i + 1]]`, by edge.
    """

    def __init__(self, shards: np.ndarray, values: np.ndarray):
        n = len(values)
        self.values = values
        self.parent = np.full(n, -1, dtype=np.int64)
        self.edge = np.zeros(n, dtype=np.int64)
        self.levels: list[np.ndarray] = []
        self.roots = np.flatnonzero(np.diff(shards, prepend=shards[0] - 1)) if n else np.zeros(0, np.int64)
        self.root_of = np.repeat(self.roots, np.diff(np.append(self.roots, n)))
        waiting = np.setdiff1d(np.arange(n), self.roots, assume_unique=True)
        under = self.root_of[waiting]
        self.levels.append(self.roots)
        while len(waiting):  # each round hangs one child under every (node, distance) in use
            distance = np.bitwise_count(values[waiting] ^ values[under]).astype(np.int64)
            slot = under * (FINGERPRINT_BITS + 1) + distance
            order = np.argsort(slot, kind="stable")
            head = np.diff(slot[order], prepend=-1) != 0
            new = waiting[order[head]]
            self.parent[new], self.edge[new] = under[order[head]], distance[order[head]]
            self.levels.append(new)
            placed = np.repeat(new, np.diff(np.append(np.flatnonzero(head), len(order))))
            waiting, under = waiting[order[~head]], placed[~head]
        linked = np.flatnonzero(self.parent >= 0)
        self.children = linked[np.lexsort((self.edge[linked], self.parent[linked]))]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(self.parent[linked], minlength=n))])

    def components(self, radius: int, frontier: int = 1 << 21, asking: np.ndarray | None = None) -> np.ndarray:
        """The least row number of each value's group, values of a shard within `radius` being linked.

        With `asking`, only links of these rows count. Queries go in blocks,
        so that the (query, node) pairs in flight stay near `frontier`.
        """
        n = len(self.values)
        label = np.arange(n)
        asking = label if asking is None else asking
        largest = int(np.diff(np.append(self.roots, n)).max(initial=1))
        block = max(1, min(1 << 16, frontier // largest))
        uniform, again = None, 0
        for start in range(0, len(asking), block):
            if start >= again:  # an old answer is still right, only later than it could be
                uniform, again = self._uniform(label), start + max(block, len(asking) // 64)
            query = asking[start : start + block]
            node = self.root_of[query]
            links = []
            while len(query):
                go = uniform[node] != label[query]  # a subtree of the query's own group holds no news
                query, node = query[go], node[go]
                distance = np.bitwise_count(self.values[query] ^ self.values[node]).astype(np.int64)
                near = (distance <= radius) & (query != node)
                links.append((query[near], node[near]))
                fan = self.first[node + 1] - self.first[node]
                at = np.repeat(np.arange(len(node)), fan)
                step = np.arange(len(at)) - np.repeat(np.cumsum(fan) - fan, fan)
                child = self.children[self.first[node[at]] + step]
                follow = np.abs(self.edge[child] - distance[at]) <= radius
                query, node = query[at[follow]], child[follow]
            label = _merge(label, np.concatenate([x for x, _ in links]), np.concatenate([x for _, x in links]))
        return label

    def _uniform(self, label: np.ndarray) -> np.ndarray:
        """The label that a node's whole subtree shares, or -1."""
        low, high = label.copy(), label.copy()
        for level in reversed(self.levels[1:]):
            np.minimum.at(low, self.parent[level], low[level])
            np.maximum.at(high, self.parent[level], high[level])
        return np.where(low == high, low, -1)


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after linking rows `a` and `b` pairwise; a label is the least row of its group."""
    while True:
        low = np.minimum(label[a], label[b])
        high = np.maximum(label[a], label[b])
        if (low == high).all():
            return label
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]


def _shard_keys(radius: int) -> list[list[tuple[int, int]]]:
    """Bit ranges (offset, length) whose joint value is one shard key; two fingerprints within `radius` share one."""
    blocks = radius + 2
    edges = [FINGERPRINT_BITS * i // blocks for i in range(blocks + 1)]
    return [[(edges[i], edges[i + 1] - edges[i]) for i in pick] for pick in combinations(range(blocks), 2)]


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """Spanning stars (u, v) of the links of at most `radius` bits between the distinct values of column `fp`."""
    keys = []
    for number, ranges in enumerate(_shard_keys(radius)):
        key, width = F.lit(number).cast("long"), 0
        for offset, length in ranges:
            part = F.shiftrightunsigned("fp", offset).bitwiseAND(F.lit((1 << length) - 1))
            key, width = F.shiftleft(key, length).bitwiseOR(part), width + length
        keys.append(key)
    sharded = distinct.select("fp", F.explode(F.array(*keys)).alias("shard"))
    # counts are dealt anew, so that the join does not inherit the grouping's partitions and Spark can split a large shard
    large = sharded.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > SHARD)
    large = large.select("shard", F.ceil(F.col("n") / SHARD).cast("int").alias("slices")).repartition(partitions(distinct.sparkSession))
    placed = sharded.join(large, "shard", "left").select("fp", "shard", F.coalesce("slices", F.lit(1)).alias("slices"))
    placed = placed.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    shared = placed.repartition("shard", "slice").sortWithinPartitions("shard", "slice", "fp")

    def stars(batch):
        shard, part, slices, fp = (batch.column(c).to_numpy() for c in ("shard", "slice", "slices", "fp"))
        edge = (np.diff(shard, prepend=shard[0]) != 0) | (np.diff(part, prepend=part[0]) != 0)
        forest = BKForest(np.cumsum(edge), fp.view(np.uint64))
        share = ((fp.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % slices
        asks = np.flatnonzero(share == part)
        label = forest.components(radius, asking=asks)
        linked = np.flatnonzero(label != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[label[linked]])], ["u", "v"])

    def search(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < 4 * SHARD:
                continue
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            shard, part = rows.column("shard").to_numpy(), rows.column("slice").to_numpy()
            whole = int(np.flatnonzero((shard != shard[-1]) | (part != part[-1]))[-1] + 1) if (shard[0], part[0]) != (shard[-1], part[-1]) else 0
            if whole:  # the last shard may go on
                yield stars(rows.slice(0, whole))
                rows = rows.slice(whole)
                held, size = [rows], rows.num_rows
        if size:
            yield stars(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return shared.select("shard", "slice", "slices", "fp").mapInArrow(search, "u long, v long")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", radius: int = 4, width: int = 4) -> DataFrame:
    """One row per input row: id, `fingerprint` (16 hex digits), `component_id`, `is_representative`.

    Fingerprints within `radius` bits are linked and `component_id` is the
    smallest id reachable. Null and wordless texts have fingerprint zero and
    are linked like any other. Rows that repeat an id each get a row; a null
    id joins its group but is never its least id unless all are null. The
    table may be empty; columns besides id and text are not read. A long text
    is hashed piece by piece.
    """
    prints = cut(fingerprints(docs, id_col=id_col, text_col=text_col, width=width).withColumnRenamed(id_col, "id"))
    distinct = cut(prints.groupBy("fp").agg(F.min("id").alias("least")))
    groups = connected_components(links(distinct.select("fp"), radius))
    grouped = distinct.join(groups, distinct.fp == groups.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    # the least ids are combined before their shuffle and dealt anew, so that Spark can split a large component in the join
    named = grouped.groupBy("component").agg(F.min("least").alias("component_id")).repartition(partitions(docs.sparkSession))
    labels = grouped.select("fp", "component").join(named, "component").select("fp", "component_id")
    return prints.join(labels, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("is_representative"),
    )
