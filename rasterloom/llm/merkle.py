"""Merkle manifest of a table: one leaf per row, one tree per group, one tree over the groups, and a proof per row.

Leaves are sorted by range, so that each partition holds runs of consecutive
leaves of some groups. Counts per partition and group give every run its
offset. A run builds all nodes whose children it holds; the nodes at its two
ends that miss their neighbour (two a level at most) are shuffled by their
coordinate, the ancestor they share, and finished in two rounds; then each run
gets back what lies above its end nodes, and a leaf's proof is its way inside
the run followed by the way of the end node above it. Neither leaves nor
groups reach the driver, and no task holds more than a run or the end nodes of
some hundred runs.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import cut, partitions

#: Leaves of a partition of the sorted table.
LEAVES = 20_000
#: Neighbouring partitions whose end nodes meet in the first round, as a power of two.
NEAR = 4


def join_digests(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """A value as it enters a leaf: `-` if null, else byte count, colon, value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def fold(digest: Column, siblings: Column, sides: Column) -> Column:
    """The root that a leaf and its proof give: each sibling joins from its side, a missing one leaves the node alone."""
    steps = F.zip_with(siblings, F.when(sides != "", F.split(sides, "")).otherwise(F.array().cast("array<string>")), lambda x, side: F.struct(x.alias("x"), side.alias("side")))
    joined = lambda acc, s: F.when(s["side"] == "L", F.concat(s["x"], acc)).when(s["side"] == "R", F.concat(acc, s["x"])).otherwise(acc)
    return F.aggregate(steps, digest, lambda acc, s: F.sha2(joined(acc, s), 256))


def _levels(first: int, digests: list[str], total: int) -> tuple[list, list]:
    """All nodes above a run of leaves: per level (place of the first node, digests, places whose parent is here), and the end nodes (level, place, digest)."""
    levels, ends, size, level = [], [], total, 0
    while digests:
        low, high = first, first + len(digests)
        if size == 1:
            ends.append((level, first, digests[0]))
            low = high
        else:
            if low % 2:
                ends.append((level, low, digests[0]))
                low += 1
            if low < high < size and high % 2:
                ends.append((level, high - 1, digests[-1]))
                high -= 1
        levels.append((first, digests, low, high))
        at = range(low - first, high - first, 2)
        digests = [join_digests("".join(digests[i : min(i + 2, high - first)])) for i in at]
        first, size, level = low // 2, (size + 1) // 2, level + 1
    return levels, ends


def _way(levels: list, place: int) -> tuple[list, int, int]:
    """Siblings of a leaf up to the end node above it, and that node's level and place."""
    found = []
    for level, (first, digests, low, high) in enumerate(levels):
        if not low <= place < high:
            return found, level, place
        found.append(digests[(place ^ 1) - first] if (place ^ 1) < first + len(digests) else None)
        place >>= 1
    raise ValueError("the leaf is not in this run")


def _sides(siblings: Sequence, place: int) -> str:
    return "".join("-" if x is None else "L" if place >> i & 1 else "R" for i, x in enumerate(siblings))


def _runs(table: pa.Table, segments: list[dict]) -> dict:
    """Per group of a partition: (first place, its rows in order, total)."""
    table = table.sort_by("seq")
    rows = defaultdict(list)
    for i, g in enumerate(table.column("g").to_pylist()):
        rows[g].append(i)
    return {s["g"]: (s["before"], rows[s["g"]], s["total"]) for s in segments}


def _end_nodes(placed: pa.Table, segments: pa.Table) -> pa.Table:
    runs = segments.to_pylist()
    leaves = placed.sort_by("seq").column("leaf").to_pylist()
    found = []
    for s in runs:
        first, rows, total = _runs(placed, [s])[s["g"]]
        for level, place, digest in _levels(first, [leaves[i] for i in rows], total)[1]:
            found.append((s["pid"], s["g"], first, total, s["meet"], s["top"], level, place, digest))
    columns = list(zip(*found, strict=True))
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string()), strict=True)], list(END))


END = ("pid", "g", "before", "total", "meet", "top", "level", "place", "digest")
END_SCHEMA = "pid int, g string, before long, total long, meet int, top int, level int, place long, digest string"
#: `digest` is set in the row of the node that all others lead to; the others hold their way to it.
WAY_SCHEMA = "g string, level int, place long, siblings array<string>, digest string, total long, top int"


def _climb(table: pa.Table, goal: str) -> pa.Table:
    """From nodes that cover one ancestor at level `goal`, the siblings of each up to it, and the ancestor."""
    nodes = list(zip(*(table.column(c).to_pylist() for c in ("level", "place", "digest")), strict=True))
    g, total, top, upto = (table.column(c)[0].as_py() for c in ("g", "total", "top", goal))
    known = defaultdict(dict)
    for level, place, digest in nodes:
        known[level][place] = digest
    for level in range(min(known), upto):
        here, size = known[level], (total + (1 << level) - 1) >> level
        for place in [p for p in here if p % 2 == 0]:
            pair = here[place] + (here[place + 1] if place + 1 < size else "")
            known[level + 1][place >> 1] = join_digests(pair)
    out = []
    for level, place, _ in nodes:
        way = [known[up].get((place >> (up - level)) ^ 1) for up in range(level, upto)]
        out.append((g, level, place, way, None, total, top))
    (place,) = known[upto]
    out.append((g, upto, place, None, known[upto][place], total, top))
    kinds = (pa.string(), pa.int32(), pa.int64(), pa.list_(pa.string()), pa.string(), pa.int64(), pa.int32())
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["g", "level", "place", "siblings", "digest", "total", "top"])


def _proofs(carry: list[str]):
    def run(placed: pa.Table, ends: pa.Table) -> pa.Table:
        above, segments = {}, {}
        for e in ends.to_pylist():
            above[e["g"], e["level"], e["place"]] = e
            segments[e["g"]] = e
        placed = placed.sort_by("seq")
        leaves = placed.column("leaf").to_pylist()
        n = placed.num_rows
        siblings, sides, subroots, roots, places, totals = ([None] * n for _ in range(6))
        for g, (first, rows, total) in _runs(placed, list(segments.values())).items():
            levels, _ = _levels(first, [leaves[i] for i in rows], total)
            for offset, i in enumerate(rows):
                way, level, place = _way(levels, first + offset)
                end = above[g, level, place]
                way = way + end["siblings"]
                siblings[i] = way + end["top_siblings"]
                sides[i] = _sides(way, first + offset) + end["top_sides"]
                subroots[i], roots[i], places[i], totals[i] = end["subroot"], end["root"], first + offset, total
        new = [pa.array(subroots, pa.string()), pa.array(roots, pa.string()), pa.array(places, pa.int64()), pa.array(totals, pa.int64()), pa.array(siblings, pa.list_(pa.string())), pa.array(sides, pa.string())]
        return pa.table([*(placed.column(c) for c in ["leaf", *carry]), *new], ["leaf", *carry, "subroot", "root", "place", "total", "siblings", "sides"])

    return run


def _trees(rows: DataFrame, carry: list[str], over_groups: bool) -> DataFrame:
    """Proofs of rows (g, o, leaf, carried columns); with `over_groups` a tree over the groups' roots follows."""
    spark = rows.sparkSession
    rows = cut(rows.withColumn("tie", F.monotonically_increasing_id()))  # the sort samples its input first
    order = ["g", F.col("o").asc_nulls_first(), "leaf", "tie"]
    n = max(partitions(spark), math.ceil(rows.count() / LEAVES)) if over_groups else max(1, math.ceil(rows.count() / LEAVES))
    sorted_rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = cut(sorted_rows.select("g", "leaf", *carry, F.spark_partition_id().alias("pid"), F.monotonically_increasing_id().alias("seq")))

    whole = Window.partitionBy("g")
    counts = placed.groupBy("pid", "g").agg(F.count("*").alias("k"))
    before = F.coalesce(F.sum("k").over(whole.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bits = lambda x: F.length(F.bin(x))
    counts = counts.select("pid", "g", "k", before.alias("before"), F.sum("k").over(whole).alias("total"), F.count("*").over(whole).alias("runs"))
    top = F.when(F.col("total") == 1, 0).otherwise(bits(F.col("total") - 1)).cast("int")
    near = (bits(F.floor(F.col("total") / F.col("runs"))) + NEAR).cast("int")
    segments = counts.select("pid", "g", "before", "total", F.least(top, near).alias("meet"), top.alias("top"))

    ends = cut(placed.groupBy("pid").cogroup(segments.groupBy("pid")).applyInArrow(_end_nodes, END_SCHEMA))
    below, high = ends.where("level < meet"), ends.where("level >= meet").select("g", "level", "place", "digest", "total", "top")
    coordinate = F.expr("shiftright(place, meet - level)").alias("at")
    met = cut(below.groupBy("g", coordinate).applyInArrow(lambda t: _climb(t, "meet"), WAY_SCHEMA))
    last = high.unionByName(met.where("digest is not null").select("g", "level", "place", "digest", "total", "top"))
    done = cut(last.groupBy("g").applyInArrow(lambda t: _climb(t, "top"), WAY_SCHEMA))
    subroots = done.where("digest is not null").select("g", F.col("digest").alias("subroot"))
    ways = done.where("digest is null").select("g", "level", "place", F.col("siblings").alias("upper"))

    if over_groups:
        tree = _trees(subroots.select(F.lit("").alias("g"), F.col("g").alias("o"), F.col("subroot").alias("leaf"), F.col("g").alias("of")), ["of"], False)
        tops = tree.select(F.col("of").alias("g"), F.col("leaf").alias("subroot"), F.col("subroot").alias("root"), F.col("siblings").alias("top_siblings"), F.col("sides").alias("top_sides"))
    else:
        tops = subroots.select("g", "subroot", F.col("subroot").alias("root"), F.array().cast("array<string>").alias("top_siblings"), F.lit("").alias("top_sides"))

    first = met.where("digest is null").select("g", "level", "place", F.col("siblings").alias("lower"))
    starts = ends.where("level < meet").join(first, ["g", "level", "place"])
    starts = starts.select("pid", "g", "before", "total", "level", "place", "lower", F.col("meet").alias("on"), coordinate)
    straight = ends.where("level >= meet").select("pid", "g", "before", "total", "level", "place", F.array().cast("array<string>").alias("lower"), F.col("level").alias("on"), F.col("place").alias("at"))
    ways = ways.select("g", F.col("level").alias("on"), F.col("place").alias("at"), "upper")
    above = starts.unionByName(straight).join(ways, ["g", "on", "at"]).withColumn("siblings", F.concat("lower", "upper")).join(tops, "g")
    above = above.select("pid", "g", "before", "total", "level", "place", "siblings", "subroot", "root", "top_siblings", "top_sides")
    fields = {f.name: f.dataType.simpleString() for f in placed.schema}
    schema = ", ".join(f"`{c}` {fields[c]}" for c in ["leaf", *carry]) + ", subroot string, root string, place long, total long, siblings array<string>, sides string"
    return placed.groupBy("pid").cogroup(above.groupBy("pid")).applyInArrow(_proofs(carry), schema)


def manifest(rows: DataFrame, digest: Column, *, group_col: str = "lang", order_col: str = "doc_id", carry: Sequence[str] = ()) -> DataFrame:
    """Per row: its order column, `leaf`, `subroot` of its group, `root`, `place` and `total` in the group, the proof, and carried columns.

    The proof is `siblings`, from leaf to root, with null where a node is
    alone, and `sides`, one of L, R and - each; `fold` replays it. Leaves
    ascend by the order column, nulls first, ties by digest; rows alike in both
    are interchangeable. Groups ascend by the bytes of their name, null first.
    An empty table gives no rows. Texts are read once and only their digests
    are shuffled.
    """
    name = F.col(group_col).cast("string")
    g = F.when(name.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), name))  # bytewise order, null first
    kept = {f"c{i}": c for i, c in enumerate(dict.fromkeys([order_col, *carry]))}
    found = _trees(rows.select(g.alias("g"), F.col(order_col).alias("o"), digest.alias("leaf"), *(F.col(c).alias(k) for k, c in kept.items())), list(kept), True)
    return found.select(*(F.col(k).alias(c) for k, c in kept.items()), "leaf", "subroot", "root", "place", "total", "siblings", "sides")
