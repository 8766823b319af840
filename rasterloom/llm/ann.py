"""Approximate nearest neighbours by inner product: one HNSW graph per shard.

Equal vectors collapse to one node. Nodes are dealt to shards of bounded size
by the power of two of their length and a hash, so that lengths inside a shard
differ by a factor of two at most; each shard's hierarchical navigable
small-world graph is kept as one row of flat arrays. A walk costs little more
in a large graph than in a small one, so shards are as large as a task can
hold; tasks link a piece of a shard each to the pieces before it. Each shard's
graph goes to some tasks, once each, and packed queries stream past it: they
walk it in lockstep (beams through all layers), the whole beam is scored
exactly, and shard results are merged.

Largest inner product becomes nearest distance by one extra coordinate,
sqrt(longest^2 - length^2), which is 0 for queries; graphs are built and
walked in that space, each band of lengths scaled to its own longest vector.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import arrow_map, cut, partitions


@dataclass(frozen=True)
class GraphOptions:
    """`links`: neighbours a node keeps in the lowest layer (half of it above); `beam`, `upper_beam`: candidates kept in a search of the lowest layer and of those above; the beam is doubled while the `settled` nearest still change, up to `widest`; for a query that has not settled by then the shard is scanned. `piece_rows`: rows of a shard that one task links; `block_queries`: queries packed in one row."""

    shard_rows: int = 131_072
    piece_rows: int = 8192
    links: int = 48
    candidates: int = 96
    beam: int = 48
    widest: int = 192
    upper_beam: int = 64
    settled: int = 21
    expand: int = 8
    layer_ratio: int = 4
    block_queries: int = 256


def usable(vector: Column) -> Column:
    """Not null, not zero, without null, NaN or infinite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def log_length(vector: Column) -> Column:
    """The vector's length, as a power of two; taken over its largest component first, so that nothing overflows."""
    top = F.array(F.array_max(F.transform(vector, F.abs)))  # a variable of the outer function, else it is found anew for each component
    squares = lambda t: F.aggregate(vector, F.lit(0.0), lambda total, x: total + (x / t) * (x / t))
    return F.element_at(F.transform(top, lambda t: F.log2(t) + F.log2(squares(t)) / 2), 1)


def band(power: Column) -> Column:
    """The power of two that a length is nearest to, so that vectors of unit length share a band however they are rounded."""
    return F.floor(power + 0.5).cast("int")


# ---- graphs, in numpy -------------------------------------------------------


#: Nodes that one node leads to so that all can be reached, and the nearest ones that are asked for it.
TREE, ASKED = 4, 24
#: A beam sees some so many times its width.
SCAN = 16
#: Columns of a block of products, and nodes times queries of a walk in lockstep.
WIDTH, SEEN = 16_384, 1 << 23


def _points(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors scaled by the longest length (a power of two) with the extra coordinate."""
    whole = int(np.floor(longest))
    scaled = np.ldexp(vectors.astype("<f8"), -whole) * 2.0 ** (whole - longest)
    extra = np.sqrt(np.maximum(1 - np.einsum("nd,nd->n", scaled, scaled), 0))
    return np.hstack([scaled, extra[:, None]]).astype("<f4")


def _diverse(points: np.ndarray, pick: np.ndarray, value: np.ndarray, links: int) -> tuple[np.ndarray, np.ndarray]:
    """Of candidates in order of nearness, those nearer to the row than to every candidate kept before, and their nearness; if these are few, the nearest of the rest follow."""
    own = points[pick]
    among = own @ own.transpose(0, 2, 1)
    width = pick.shape[1]
    stays = np.zeros(pick.shape, dtype=bool)
    for c in range(width):
        closest = np.where(stays[:, :c], among[:, c, :c], -np.inf).max(axis=1, initial=-np.inf)
        stays[:, c] = value[:, c] > closest
    rank = np.where(stays, 0, width) + np.arange(width)
    order = np.argsort(rank, axis=1)[:, :links]
    first, near = np.take_along_axis(pick, order, 1), np.take_along_axis(value, order, 1)
    first[near == -np.inf] = -1
    return first, near


def _candidates(points: np.ndarray, start: int, stop: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """For rows start to stop, the nearest of all rows before each, nearest first, and their nearness (-inf: there are fewer)."""
    rows, m = np.arange(start, stop), stop - start
    pick, value = np.zeros((m, 0), np.int64), np.zeros((m, 0), np.float32)
    for left in range(0, stop, WIDTH):
        right = min(stop, left + WIDTH)
        near = points[start:stop] @ points[left:right].T
        if right > start:
            near[np.arange(left, right)[None, :] >= rows[:, None]] = -np.inf
        if value.shape[1] < count:
            at = np.broadcast_to(np.arange(left, right), near.shape)
        else:  # only what is nearer than the last one kept
            who, at = np.divmod(np.flatnonzero(near > value.min(axis=1)[:, None]), right - left)
            if not len(who):
                continue
            place = np.arange(len(who)) - np.searchsorted(who, who)
            wide = np.full((m, place.max() + 1), -np.inf, np.float32)
            wide[who, place] = near[who, at]
            index = np.zeros(wide.shape, np.int64)
            index[who, place] = at + left
            near, at = wide, index
        pick, value = np.hstack([pick, at]), np.hstack([value, near])
        if value.shape[1] > count:
            keep = np.argpartition(-value, count - 1, axis=1)[:, :count]
            pick, value = np.take_along_axis(pick, keep, 1), np.take_along_axis(value, keep, 1)
    order = np.argsort(-value, axis=1, kind="stable")
    return np.take_along_axis(pick, order, 1), np.take_along_axis(value, order, 1)


def _ahead(points: np.ndarray, start: int, half: int, candidates: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What the rows from start on link to among the rows before them: links (rows, half), their nearness, and the nearest (rows, ASKED); -1 where there are fewer."""
    m = len(points) - start
    ahead, value, nearest = np.full((m, half), -1, "<i4"), np.full((m, half), -np.inf, "<f4"), np.full((m, ASKED), -1, "<i4")
    for left in range(start, len(points), 256):
        right = min(len(points), left + 256)
        pick, near = _candidates(points, left, right, candidates)
        first, known = _diverse(points, pick, near, half)
        own = slice(left - start, right - start)
        ahead[own, : first.shape[1]], value[own, : first.shape[1]] = first, known
        first = np.where(near > -np.inf, pick, -1)[:, :ASKED]
        nearest[own, : first.shape[1]] = first
    return ahead, value, nearest


def _linked(ahead: np.ndarray, value: np.ndarray, nearest: np.ndarray) -> np.ndarray:
    """Neighbour rows (n, links + TREE) of the nodes of one layer, -1 where there are fewer.

    Nodes are inserted in the order of rows: a node links to the nearest nodes
    before it, chosen for diversity, and these link back while they have room,
    nearest first. The links of early nodes are long, those of late ones short.
    Last come tree links: each node but the first is led to by one before it,
    so that all can be reached from the first.
    """
    n, half = ahead.shape
    links, room, free = 2 * half, [TREE] * n, 0
    tree = np.full((n, TREE), -1, np.int32)
    for i in range(1, n):
        at = next((x for x in nearest[i].tolist() if x >= 0 and room[x]), -1)
        if at < 0:
            while not room[free]:
                free += 1
            at = free
        tree[at, TREE - room[at]] = i
        room[at] -= 1
    source, column = np.nonzero(ahead >= 0)
    target = ahead[source, column]
    # newer nodes that chose a node, nearest first, as far as there is room
    order = np.lexsort((-value[source, column], target))
    newer, older = source[order], target[order]
    place = np.arange(len(older)) - np.searchsorted(older, older) + (ahead >= 0).sum(axis=1)[older]
    out = np.full((n, links), -1, np.int32)
    out[:, :half] = ahead
    out[older[place < links], place[place < links]] = newer[place < links]
    return np.hstack([out, tree])


def _layers(n: int, options: GraphOptions) -> list[tuple[int, int]]:
    """(stride, links) of each layer: every stride-th row; rows come in hash order, so this is a random choice that reruns repeat."""
    out = [(1, options.links)]
    while -(-n // out[-1][0]) > options.layer_ratio * 2:
        out.append((out[-1][0] * options.layer_ratio, options.links // 2))
    return out


class Graph:
    """Layers of one shard: `members[i]` are rows of layer i (layer 0 has all), `links[i]` their neighbours as rows."""

    def __init__(self, vectors: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]], longest: float | None = None):
        if longest is None:
            top = np.abs(vectors).max()
            longest = np.log2(top) + np.log2(np.square(vectors / top).sum(axis=1).max()) / 2
        self.vectors, self.layers, self.points = vectors, layers, _points(vectors, longest)

    @classmethod
    def build(cls, vectors: np.ndarray, options: GraphOptions) -> Graph:
        graph = cls(vectors, [])
        for stride, links in _layers(len(vectors), options):
            graph.add_layer(stride, _linked(*_ahead(graph.points[::stride], 0, links // 2, options.candidates)))
        return graph

    def add_layer(self, stride: int, local: np.ndarray) -> None:
        """Neighbours given as places in the layer of every stride-th row."""
        members = np.arange(0, len(self.points), stride, dtype=np.int32)
        self.layers.append((members, np.where(local >= 0, local * stride, -1).astype(np.int32)))

    def search(self, queries: np.ndarray, options: GraphOptions) -> np.ndarray:
        """Rows (q, width) that the walk ends with, -1 where a query found fewer; a graph of a few beams is scanned."""
        q = len(queries)
        scaled = queries / np.abs(queries).max(axis=1, keepdims=True)
        asked = np.hstack([scaled, np.zeros((q, 1))]).astype(np.float32)
        if len(self.points) <= 4 * options.beam:
            return self._scan(asked, options.beam)
        # the highest layer of which a beam would not see most is the first that is walked
        top = next(i for i, (members, _) in enumerate(self.layers) if len(members) <= SCAN * options.upper_beam or i == len(self.layers) - 1)
        found = self._scan(asked, options.upper_beam, self.layers[top][0])
        for level in range(top - 1, 0, -1):
            found = self._beam(asked, found, level, options.upper_beam, options.expand)
        width = options.beam
        found = self._beam(asked, found, 0, width, options.expand)
        # a query whose nearest change with a beam of twice the width goes on widening, until they do not;
        # a beam that would see most of the graph is replaced by a scan, and so is one beyond the widest, as reading
        # rows in order then costs less than jumping between them; what a scan gives is exact
        out, moving = found, np.arange(q)
        while len(moving) and width < len(self.points):
            width *= 2
            scan = width > options.widest or width * SCAN >= len(self.points)
            wider = self._scan(asked[moving], width) if scan else self._beam(asked[moving], out[moving], 0, width, options.expand)
            out = np.hstack([out, np.full((q, wider.shape[1] - out.shape[1]), -1)]) if wider.shape[1] > out.shape[1] else out
            changed = (self._nearest(asked[moving], wider, options.settled) != self._nearest(asked[moving], out[moving], options.settled)).any(axis=1)
            out[moving, : wider.shape[1]] = wider
            out[moving, wider.shape[1] :] = -1
            moving = moving[:0] if scan else moving[changed]
        return out

    def _scan(self, asked, width, members=None):
        points = self.points if members is None else self.points[members]
        width = min(width, len(points))
        near = np.argpartition(-(asked @ points.T), width - 1, axis=1)[:, :width]
        return near if members is None else members[near].astype(np.int64)

    def _nearest(self, asked, rows, k):
        """The k nearest of rows (q, any number, -1 for none), in the order of their numbers."""
        value = np.where(rows >= 0, np.einsum("qd,qkd->qk", asked, self.points[rows]), -np.inf)
        pick = np.argsort(-value, axis=1, kind="stable")[:, :k]
        return np.sort(np.take_along_axis(rows, pick, 1), axis=1)

    def _beam(self, asked, entries, level, width, expand):
        """Rows (q, width) that a walk of one layer from all entries (q, any number, -1 for none) ends with."""
        q, n, (members, links) = len(asked), len(self.points), self.layers[level]
        width = min(width, len(members))
        where = None
        if level:
            where = np.full(n, -1)
            where[members] = np.arange(len(members))
        entries = entries[:, :width] if entries.shape[1] > width else entries
        found = np.full((q, width), -1, np.int64)
        value = np.full((q, width), -np.inf, np.float32)
        done = np.zeros((q, width), dtype=bool)
        seen = np.zeros((q, n), dtype=np.uint16)
        row, column = np.nonzero(entries >= 0)
        at = entries[row, column]
        found[row, column], value[row, column] = at, np.einsum("qd,qd->q", asked[row], self.points[at])
        seen[row, at] = 1
        active = np.arange(q)
        while len(active):
            waiting = np.where(done[active] | (found[active] < 0), -np.inf, value[active])
            pick = np.argsort(-waiting, axis=1, kind="stable")[:, :expand]
            open_ = np.take_along_axis(waiting, pick, 1) > -np.inf
            going = open_[:, 0]
            active, pick, open_ = active[going], pick[going], open_[going]
            if not len(active):
                break
            done[active[:, None], pick] = True
            node = np.where(open_, found[active[:, None], pick], -1)
            around = np.where(node[:, :, None] >= 0, links[node if where is None else where[node]], -1).reshape(len(active), -1)
            row, column = np.nonzero(around >= 0)
            at = around[row, column]
            fresh = seen[active[row], at] == 0
            row, column, at = row[fresh], column[fresh], at[fresh]
            # two expanded nodes may name the same neighbour: the last one written stays
            seen[active[row], at] = column + 1
            once = seen[active[row], at] == column + 1
            row, column, at = row[once], column[once], at[once]
            # moved to the left, so that few columns remain
            place = np.arange(len(row)) - np.searchsorted(row, row)
            most = int(place.max()) + 1 if len(row) else 0
            near, around = np.full((len(active), most), -np.inf, np.float32), np.full((len(active), most), -1, np.int64)
            near[row, place], around[row, place] = np.einsum("nd,nd->n", asked[active[row]], self.points[at]), at
            pool = np.hstack([value[active], near])
            keep = np.argpartition(-pool, width - 1, axis=1)[:, :width] if pool.shape[1] > width else np.arange(pool.shape[1])[None].repeat(len(active), 0)
            value[active] = np.take_along_axis(pool, keep, 1)
            found[active] = np.take_along_axis(np.hstack([found[active], around]), keep, 1)
            done[active] = np.take_along_axis(np.hstack([done[active], np.zeros(near.shape, dtype=bool)]), keep, 1)
        return found


# ---- index and search, in Spark ---------------------------------------------


def distinct_nodes(rows: DataFrame, k: int) -> DataFrame:
    """(node, members, v): each distinct vector once, with the k + 1 least ids that have it; ids are salted first."""
    salted = Window.partitionBy("v", F.pmod("id", F.lit(64))).orderBy("id")
    whole = Window.partitionBy("v").orderBy("id")
    least = (
        rows.dropDuplicates(["id", "v"])
        .withColumn("r", F.row_number().over(salted)).where(F.col("r") <= k + 1)
        .withColumn("r", F.row_number().over(whole)).where(F.col("r") <= k + 1)
    )
    return least.groupBy("v").agg(F.min("id").alias("node"), F.sort_array(F.collect_list("id")).alias("members"))


def _packed(vectors: np.ndarray) -> bytes:
    """Bytes of single precision where that loses nothing, else of double."""
    with np.errstate(over="ignore"):
        short = vectors.astype("<f4")
    return (short if np.array_equal(short.astype("<f8"), vectors) else vectors.astype("<f8")).tobytes()


def _unpacked(blob, rows: int, dim: int) -> np.ndarray:
    """The vectors of a piece; doubles only where its bytes are."""
    flat = np.frombuffer(blob, "<f4" if len(blob) == 4 * rows * dim else "<f8")
    return flat.reshape(rows, dim)


def build_index(nodes: DataFrame, bands: DataFrame, options: GraphOptions) -> DataFrame:
    """One row per (dim, band, shard): node ids, vectors and layers as bytes of flat arrays, ids and vectors by piece.

    A shard's rows are packed in pieces; each piece goes to a task that links
    it to the pieces before it, and all pieces to one that links the layers
    above, which hold a third of the rows. Then the links meet by shard.
    """

    def pack(table):
        order = np.argsort(table.column("h").to_numpy(), kind="stable")
        ids = table.column("node").to_numpy()[order]
        vectors = table.column("v").combine_chunks().values.to_numpy().reshape(len(order), -1)[order]
        keys = table.select(["dim", "band", "shard", "piece", "pieces", "longest"]).slice(0, 1)
        points = _points(vectors, table.column("longest")[0].as_py())
        for name, blob in (("ids", ids.astype("<i8").tobytes()), ("vectors", _packed(vectors)), ("points", points.tobytes())):
            keys = keys.append_column(name, pa.array([blob], pa.binary()))
        return keys

    def link(table):
        table = table.sort_by("piece")
        dim, part, pieces = (table.column(name)[0].as_py() for name in ("dim", "part", "pieces"))
        parts = [np.frombuffer(x.as_buffer(), "<f4").reshape(-1, dim + 1) for x in table.column("points")]
        points, out = np.vstack(parts), []
        if part < pieces:  # a piece may have no rows; then none is the last of this group
            start = len(points) - len(parts[-1]) if table.column("piece")[-1].as_py() == part else len(points)
            out.append((0, *_ahead(points, start, options.links // 2, options.candidates)))
        else:
            for level, (stride, links) in enumerate(_layers(len(points), options)[1:], 1):
                out.append((level, *_ahead(points[::stride], 0, links // 2, options.candidates)))
        keys = {name: pa.array([table.column(name)[0].as_py()] * len(out), pa.int32()) for name in ("dim", "band", "shard")}
        arrays = zip(("ahead", "near", "asked"), zip(*[x[1:] for x in out], strict=True), strict=True) if out else ()
        blobs = {name: pa.array([x.tobytes() for x in column], pa.binary()) for name, column in arrays} or {name: pa.array([], pa.binary()) for name in ("ahead", "near", "asked")}
        return pa.table(keys | {"level": pa.array([x[0] for x in out], pa.int32()), "piece": pa.array([part] * len(out), pa.int32())} | blobs)

    def meet(table):
        table = table.sort_by([("level", "ascending"), ("piece", "ascending")])
        level = table.column("level").to_numpy()
        own = table.filter(pa.array(level < 0))  # the pieces themselves
        n = sum(len(x.as_buffer()) // 8 for x in own.column("ids"))
        links = []
        for i, (stride, width) in enumerate(_layers(n, options)):
            layer = table.filter(pa.array(level == i))
            read = lambda name, kind, columns: np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in layer.column(name)]).reshape(-1, columns)  # noqa: B023, E731
            local = _linked(read("ahead", "<i4", width // 2), read("near", "<f4", width // 2), read("asked", "<i4", ASKED))
            links.append(np.where(local >= 0, local * stride, -1).astype("<i4").tobytes())
        keys = {name: pa.array([table.column(name)[0].as_py()], pa.int32()) for name in ("dim", "band", "shard")}
        keys["longest"] = own.column("longest").slice(0, 1)
        return pa.table(keys | {"ids": pa.array([own.column("ids").to_pylist()]), "vectors": pa.array([own.column("vectors").to_pylist()]), "links": pa.array([links])})

    shard = ["dim", "band", "shard"]
    dealt = nodes.select("node", "v", "dim", "band", F.xxhash64("node").alias("h")).join(F.broadcast(bands), ["dim", "band"])
    dealt = dealt.withColumns({"shard": F.pmod("h", F.col("shards")).cast("int"), "piece": F.pmod(F.xxhash64("node", F.lit(2)), F.col("pieces")).cast("int")})
    keys = "dim int, band int, shard int"
    pieces = cut(dealt.drop("shards").groupBy(*shard, "piece").applyInArrow(pack, f"{keys}, piece int, pieces int, longest double, ids binary, vectors binary, points binary"))
    parts = bands.agg(F.sum(F.col("shards") * (F.col("pieces") + 1))).first()[0] or 1
    spread = max(partitions(nodes.sparkSession), min(parts, 10_000))
    parts = pieces.select(*shard, "piece", "pieces", "points", F.explode(F.expr("sequence(piece, pieces)")).alias("part"))
    links = parts.repartition(spread, *shard, "part").groupBy(*shard, "part").applyInArrow(link, f"{keys}, level int, piece int, ahead binary, near binary, asked binary")
    own = pieces.select(*shard, F.lit(-1).alias("level"), "piece", "longest", "ids", "vectors")
    both = links.unionByName(own, allowMissingColumns=True)
    return both.groupBy(*shard).applyInArrow(meet, f"{keys}, longest double, ids array<binary>, vectors array<binary>, links array<binary>")


def search_index(index: DataFrame, queries: DataFrame, bands: DataFrame, blocks: int, keep: int, options: GraphOptions) -> DataFrame:
    """(query node, node, score): the `keep` best that each shard gives each query vector, with exact scores.

    Each graph is sent to as many tasks as keep the cores busy; a task reads
    it once, then the packed queries dealt to it, one row after the other.
    """
    spark = index.sparkSession
    shards = bands.agg(F.sum("shards")).first()[0] or 1
    copies = max(1, min(blocks, -(-2 * spark.sparkContext.defaultParallelism // shards)))
    tasks = max(1, min(shards * copies, 10_000))
    packed = (
        queries.withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), F.lit(blocks)).cast("int"))
        .groupBy("dim", "block").agg(F.collect_list(F.struct("node", "v")).alias("asked"))
        .join(F.broadcast(bands.select("dim", "band", "shards")), "dim").withColumn("shard", F.explode(F.expr("sequence(0, shards - 1)")))
        .select("dim", "band", "shard", F.pmod("block", F.lit(copies)).alias("copy"), F.lit(1).alias("turn"), "asked")
    )
    graphs = index.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"), F.lit(0).alias("turn"))
    # consecutive numbers, so that tasks have equally many groups
    group = F.pmod(F.xxhash64("dim", "band") + F.col("shard") * copies + F.col("copy"), F.lit(tasks)).cast("int")
    stream = graphs.unionByName(packed, allowMissingColumns=True).repartitionById(tasks, group)
    stream = stream.sortWithinPartitions("dim", "band", "shard", "copy", "turn")

    def search(batches):
        graph = ids = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                dim = row["dim"].as_py()
                if not row["turn"].as_py():
                    ids = [np.frombuffer(x.as_buffer(), "<i8") for x in row["ids"].values]
                    vectors = np.concatenate([_unpacked(x.as_buffer(), len(y), dim) for x, y in zip(row["vectors"].values, ids, strict=True)])
                    ids = np.concatenate(ids)
                    graph = Graph(vectors, [], row["longest"].as_py())
                    for (stride, _), x in zip(_layers(len(ids), options), row["links"].values, strict=True):
                        members = np.arange(0, len(ids), stride, dtype=np.int32)
                        graph.layers.append((members, np.frombuffer(x.as_buffer(), "<i4").reshape(len(members), -1)))
                    continue
                asked = row["asked"].values
                query_ids = asked.field("node").to_numpy()
                query = asked.field("v").flatten().to_numpy().reshape(len(query_ids), dim)
                step = max(16, min(512, SEEN // len(ids)))
                for start in range(0, len(query_ids), step):
                    part = query[start : start + step]
                    found = graph.search(part, options)
                    who, column = np.nonzero(found >= 0)
                    got = found[who, column]
                    exact = np.einsum("nd,nd->n", part[who], graph.vectors[got].astype("<f8"))
                    order = np.lexsort((ids[got], -exact, who))  # a shard's best are enough
                    place = np.arange(len(who)) - np.searchsorted(who[order], who[order])
                    best = order[place < keep]
                    yield pa.RecordBatch.from_arrays([pa.array(query_ids[start + who[best]]), pa.array(ids[got[best]]), pa.array(exact[best])], ["query", "node", "score"])

    columns = stream.select("dim", "longest", "turn", "ids", "vectors", "links", "asked")
    return arrow_map(columns, search, "query long, node long, score double")


def nearest(
    table: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", query: Column | None = None, k: int = 20, options: GraphOptions = GraphOptions()
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for every row that `query` selects, its own id left out.

    `query` defaults to ids divisible by 20. Vectors that are null, zero, or
    hold null or non-finite components take no part, nor do rows without an
    id; vectors of another length are never compared. Lengths may differ by
    any factor; a product beyond the range of doubles is infinite. Equal
    scores go to the smaller id. Repeated rows count once. An empty table
    gives no rows, and other columns are not read.
    """
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), (query if query is not None else F.col(id_col) % 20 == 0).alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    nodes = cut(distinct_nodes(rows.select("id", "v"), k).withColumns({"key": F.xxhash64("v"), "dim": F.size("v"), "power": log_length(F.col("v"))}).withColumn("band", band(F.col("power"))))
    asking = rows.where("asks").select("id", "v").distinct().withColumn("key", F.xxhash64("v"))
    asking = cut(asking.join(nodes.select("key", F.col("v").alias("w"), "node"), "key").where(F.col("v") == F.col("w")).select("id", "node"))
    # one row for each length of vectors and power of two, of which doubles have 2,098: small enough to broadcast
    bands = nodes.groupBy("dim", "band").agg(F.count("*").alias("n"), F.max("power").alias("longest"))
    bands = bands.withColumn("shards", F.ceil(F.col("n") / options.shard_rows).cast("int"))
    bands = cut(bands.withColumn("pieces", F.ceil(F.col("n") / F.col("shards") / options.piece_rows).cast("int")).drop("n"))
    queries = nodes.select("node", "v", "dim").join(asking.select("node").distinct(), "node")
    blocks = max(1, -(-asking.select("node").distinct().count() // options.block_queries))
    index = cut(build_index(nodes, bands, options))
    found = search_index(index, queries, bands, blocks, k + 1, options)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    found = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).join(nodes.select("node", "members"), "node")
    lists = found.groupBy("query").agg(F.collect_list(F.struct("score", "members")).alias("hits"))
    flat = F.flatten(F.transform("hits", lambda h: F.transform(h["members"], lambda m: F.struct((-h["score"]).alias("far"), m.alias("vec_id")))))
    lists = lists.select("query", F.slice(F.array_sort(flat), 1, 2 * k + 2).alias("hits"))
    ranked = asking.join(lists, asking.node == lists.query)
    others = ranked.select("id", F.slice(F.filter("hits", lambda h: h["vec_id"] != F.col("id")), 1, k).alias("hits"))
    return others.select(F.col("id").alias("query_id"), F.posexplode("hits").alias("pos", "hit")).select(
        "query_id", (F.col("pos") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.far")).alias("score")
    )
