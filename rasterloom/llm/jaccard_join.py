"""N-gram Jaccard join: texts whose shingle sets have a similarity of at least `percent` / 100, as groups.

Equal sets collapse first. Two sets of sizes s <= t can only link if they
differ in at most (s + t) (100 - percent) / (100 + percent) shingles. For every
band of sizes, shingles are dealt by hash into more parts than that, so linked
sets agree in a whole part; parts that agree tell which sets can meet at all,
and sets that meet, directly or through others, form a cluster. Clusters are
independent of each other. A small one is compared in one tile; a large one is
dealt into tiles of two blocks each, of the same band of sizes or of two
neighbouring bands, so no task holds a cluster whole.

In a tile, each set has a bitmap of hashed shingles. Bits that differ are
shingles that differ, so the count of differing bits bounds the overlap from
above; pairs that pass, and are not yet in one group, are decided by exact
intersection of the sorted arrays. A tile reports a spanning forest of its
links, never all pairs, and the forests are joined by connected components.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _bitmap
from ._common import arrow_map, cut, partitions, slices
from ._graph import connected_components
from .simhash import shingle_hashes

WIDTH, PERCENT = 3, 90
#: Shingles of a cluster that is compared whole, and of such clusters in one tile.
SMALL, BIN = 60_000, 500_000
#: A larger cluster's band is dealt into blocks of SMALL shingles, up to so many, beyond which the blocks grow up to LARGE.
BLOCKS, LARGE = 16, 1_000_000
#: Bits of a signature, at least and at most.
MIN_BITS, MAX_BITS = 256, 8192
#: Upper ends of the bands of sizes grow by half.
LARGEST = 1 << 40


def _bands() -> np.ndarray:
    """First size of each band."""
    starts = [1]
    while starts[-1] < LARGEST:
        starts.append(max(starts[-1] + 1, starts[-1] * 3 // 2))
    return np.array(starts, dtype=np.int64)


BANDS = _bands()


def band_of(size: np.ndarray | int) -> np.ndarray:
    return np.searchsorted(BANDS, size, side="right") - 1


def differing(band: int, percent: int) -> int:
    """Most shingles that are in one only of two linked sets, the smaller being of this band."""
    small = int(BANDS[band + 1]) - 1
    return (small + 100 * small // percent) * (100 - percent) // (100 + percent)


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Distinct hashes of a text's shingles, in order; a text of fewer words is one shingle, one without words has none."""
    pieces = [np.unique(np.array(own, dtype=np.uint64)) for own in shingle_hashes(text, width)]
    return np.unique(np.concatenate(pieces)) if len(pieces) > 1 else pieces[0] if pieces else np.zeros(0, np.uint64)


def part_keys(shingles: np.ndarray, percent: int) -> np.ndarray:
    """One key per part of the set, for each band of sizes in which it can be one of a linked pair.

    There are more parts than shingles can differ in, so two linked sets agree
    in `spare` parts at least. A part without shingles says nothing: its key is
    left out, unless the set has `spare` such parts.
    """
    size, found = len(shingles), []
    band = int(band_of(size)) if size else -1
    while band >= 0 and 100 * (int(BANDS[band + 1]) - 1) >= percent * size:
        most = differing(band, percent)
        if most:
            spare = 3 + most // 8
            n = most + spare
            part = (_mixed(shingles, 0xA5A5A5A5 + band) >> np.uint64(20)) % np.uint64(n)
            totals = np.zeros(n, dtype=np.uint64)
            np.add.at(totals, part, _mixed(shingles, 0x5EED))
            used = np.bincount(part.astype(np.int64), minlength=n) > 0
            keys = _mixed(totals, 1) ^ _mixed((np.uint64(band) << np.uint64(44)) + np.arange(n, dtype=np.uint64), 2)
            found.append(keys if n - used.sum() >= spare else keys[used])
        band -= 1
    return np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)


def describe(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(id, said, node, n, keys): hash of the text, 128-bit hash of its set (null if empty), size, part keys."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("said"))

    def run(batches):
        for batch in slices(batches):
            nodes, sizes, keys = [], [], []
            for text in batch.column("text").to_pylist():
                own = shingle_set(text, width)
                nodes.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                sizes.append(len(own))
                keys.append(part_keys(own, percent))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("said"), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], ["id", "said", "node", "n", "keys"])

    return arrow_map(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, said long, node binary, n long, keys array<long>")


def _sets(texts: DataFrame, width: int) -> DataFrame:
    """(node, n, shingles) of every text (text, said); of copies in one task most are left out."""

    def run(batches):
        seen: set = set()
        for batch in slices(batches):
            fresh = []
            for text, said in zip(batch.column("text").to_pylist(), batch.column("said").to_pylist(), strict=True):
                known = (said, len(text), text[:64])
                if known not in seen:
                    fresh.append(text)
                    seen.add(known)
            if len(seen) > 100_000:
                seen.clear()
            found = [shingle_set(x, width) for x in fresh]
            nodes = [hashlib.blake2b(own.tobytes(), digest_size=16).digest() for own in found]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array([len(x) for x in found], pa.int64()), pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64()))], ["node", "n", "shingles"])

    return arrow_map(texts, run, "node binary, n long, shingles array<long>")


def clusters(described: DataFrame) -> DataFrame:
    """(node, cluster): 64-bit hashes of sets that share a part with another, directly or through others."""
    n = partitions(described.sparkSession)
    held = described.where("node is not null").select(F.xxhash64("node").alias("node"), "keys")
    entries = held.select("node", F.explode("keys").alias("key"))
    shared = cut(entries.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most").select("key", "least"))
    known = _bitmap.of(shared.select("key"))

    def run(batches):
        for batch in batches:
            lists = batch.column("keys")
            keys, nodes = lists.flatten().to_numpy(), np.repeat(batch.column("node").to_numpy(), lists.value_lengths().to_numpy())
            may = _bitmap.holds(known, keys)
            yield pa.RecordBatch.from_arrays([pa.array(nodes[may]), pa.array(keys[may])], ["node", "key"])

    entries = arrow_map(held, run, "node long, key long")
    # dealt anew, so that Spark can split a key of very many sets in the join
    edges = entries.join(shared.repartition(n), "key").select(F.col("node").alias("u"), F.col("least").alias("v")).distinct()
    return connected_components(edges).withColumnRenamed("component", "cluster")


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Bitmaps of hashed shingles, as rows of 64-bit words."""
    sizes = np.array([len(x) for x in sets])
    bits = min(MAX_BITS, max(MIN_BITS, 1 << int(2 * sizes.max()).bit_length()))
    out = np.zeros((len(sets), bits // 8), dtype=np.uint8)
    for i, own in enumerate(sets):
        row = np.zeros(bits, dtype=np.uint8)
        row[(_mixed(own, 7) >> np.uint64(30)).astype(np.int64) & (bits - 1)] = 1
        out[i] = np.packbits(row)
    return out.view(np.uint64)


def forest(sets: list[np.ndarray], percent: int, sides: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (i, j) that join all linked sets; with `sides`, only sets of different sides are compared."""
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    order = np.argsort(sizes, kind="stable")
    sizes, sets = sizes[order], [sets[i] for i in order]
    signs, label, links = _signatures(sets), np.arange(len(sets)), []
    side = None if sides is None else sides[order]
    starts = np.searchsorted(sizes, -(-percent * sizes // 100))  # no smaller set can link
    for i in range(1, len(sets)):
        lo = starts[i]
        if lo == i:
            continue
        both = sizes[lo:i] + sizes[i]
        apart = np.bitwise_count(signs[lo:i] ^ signs[i]).sum(axis=1, dtype=np.int64)
        open_ = ((both - apart) * (100 + percent) >= 2 * percent * both) & (label[lo:i] != label[i])
        if side is not None:
            open_ &= side[lo:i] != side[i]
        near = np.flatnonzero(open_)
        near = near[np.argsort(apart[near], kind="stable")] + lo
        while len(near):
            j = near[0]
            same = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if same * (100 + percent) >= percent * (sizes[i] + sizes[j]):
                links.append((int(order[i]), int(order[j])))
                label[label == label[j]] = label[i]
            near = near[1:]
            near = near[label[near] != label[i]]
    return links


def _tile_links(percent: int):
    """Links of a tile: of each of its clusters, or between its two sides."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("cluster").combine_chunks()
        nodes = table.column("node").to_pylist()
        sides = table.column("side").to_numpy()
        lists = table.column("shingles").combine_chunks()
        flat, ends = lists.flatten().to_numpy().view(np.uint64), np.cumsum(np.diff(lists.offsets.to_numpy()))
        sets = np.split(flat, ends[:-1])
        cluster = table.column("cluster").to_numpy()
        cuts = np.flatnonzero(np.diff(cluster)) + 1
        found = []
        for rows in np.split(np.arange(len(nodes)), cuts):
            own = sides[rows]
            found += [(nodes[rows[i]], nodes[rows[j]]) for i, j in forest([sets[r] for r in rows], percent, own if own.max() else None)]
        return pa.table([pa.array([u for u, _ in found], pa.binary()), pa.array([v for _, v in found], pa.binary())], ["u", "v"])

    return run


def tiles(sets: DataFrame, percent: int) -> DataFrame:
    """Deal (node, n, shingles, cluster) into tiles (tile struct, side)."""
    spark = sets.sparkSession
    bands = F.array(*[F.lit(int(x)) for x in BANDS])
    start = lambda b: F.element_at(bands, (b + 1).cast("int"))
    sized = sets.withColumn("band", (F.size(F.filter(bands, lambda x: x <= F.col("n"))) - 1).cast("int"))
    per_band = sized.groupBy("cluster", "band").agg(F.sum("n").alias("held"))
    n_blocks = F.greatest(F.least(F.ceil(F.col("held") / SMALL), F.lit(BLOCKS)), F.ceil(F.col("held") / LARGE))
    blocks = per_band.select("cluster", "band", n_blocks.cast("int").alias("blocks"), "held")
    whole = cut(blocks.groupBy("cluster").agg(F.sum("held").alias("held"), F.map_from_entries(F.collect_list(F.struct("band", "blocks"))).alias("blocks")))
    total = whole.agg(F.sum(F.when(F.col("held") <= SMALL, F.col("held")))).first()[0] or 0
    bins = max(partitions(spark), -(-total // BIN))
    n = partitions(spark)

    small = whole.where(F.col("held") <= SMALL).select("cluster", F.pmod(F.xxhash64("cluster"), F.lit(bins)).cast("int").alias("bin"))
    none = F.lit(-1)
    few = sized.join(small.repartition(n), "cluster").select("cluster", "node", "shingles", F.lit(0).alias("side"), F.col("bin").alias("a"), none.alias("b"), none.alias("i"), none.alias("j"))

    large = whole.where(F.col("held") > SMALL).select("cluster", "blocks").repartition(n)
    of = lambda band: F.coalesce(F.element_at("blocks", band), F.lit(0))
    many = sized.join(large, "cluster").withColumn("own", F.pmod(F.xxhash64("node"), of(F.col("band")).cast("long")).cast("int"))
    upto = lambda k: F.when(k > 0, F.sequence(F.lit(0), k - 1)).otherwise(F.array().cast("array<int>"))
    place = lambda side, a, b, i, j: F.struct(side.cast("int").alias("side"), a.cast("int").alias("a"), b.cast("int").alias("b"), i.cast("int").alias("i"), j.cast("int").alias("j"))
    band, own = F.col("band"), F.col("own")
    inside = F.transform(upto(of(band)), lambda k: place(F.when(k == own, 0).when(k < own, 2).otherwise(1), band, band, F.least(k, own), F.greatest(k, own)))
    above = F.when(F.lit(100) * F.col("n") >= F.lit(percent) * start(band + 1), upto(of(band + 1))).otherwise(F.array().cast("array<int>"))
    as_smaller = F.transform(above, lambda k: place(F.lit(1), band, band + 1, own, k))
    below = F.when((band > 0) & (F.lit(100) * (start(band) - 1) >= F.lit(percent) * F.col("n")), upto(of(band - 1))).otherwise(F.array().cast("array<int>"))
    as_larger = F.transform(below, lambda k: place(F.lit(2), band - 1, band, k, own))
    dealt = many.select("cluster", "node", "shingles", F.explode(F.concat(inside, as_smaller, as_larger)).alias("t")).select("cluster", "node", "shingles", "t.*")
    return few.unionByName(dealt)


def links(docs: DataFrame, described: DataFrame, *, text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(u, v): links between sets, named by their 128-bit hash, that join all linked ones."""
    n = partitions(docs.sparkSession)
    met = clusters(described)
    # one text of each set that meets another; texts alike in their 64-bit hash but not in their set come along
    one = described.where("node is not null").groupBy("node").agg(F.min("said").alias("said")).select(F.xxhash64("node").alias("short"), "said")
    wanted = one.join(met.withColumnRenamed("node", "short"), "short").select("said").distinct()
    wanted = cut(wanted)
    known = _bitmap.of(wanted)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(_bitmap.holds(known, batch.column("said").to_numpy())))

    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"), F.xxhash64(text_col).alias("said"))
    texts = arrow_map(texts, run, "text string, said long").join(wanted.repartition(n, "said"), "said", "left_semi").select("text", "said")
    sets = _sets(texts, width).where("n > 0").withColumn("short", F.xxhash64("node"))
    once = cut(sets.dropDuplicates(["node"]).join(met.withColumnRenamed("node", "short"), "short").select("node", "n", "shingles", "cluster"))
    dealt = tiles(once, percent)
    key = [F.when(F.col("b") >= 0, F.col("cluster")).alias("of"), "a", "b", "i", "j"]
    return dealt.groupBy(*key).applyInArrow(_tile_links(percent), "u binary, v binary")


def join(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Per row: id, `n_shingles`, `component_id` (the smallest id reachable by links, its own included).

    ASCII letters are lower-cased. Rows with equal sets are linked, rows without
    words are linked with nothing. Rows that repeat an id are rows of their
    own; a null id is never the smallest. Long texts are hashed piece by piece,
    an empty table gives no rows, other columns are not read.
    """
    n = partitions(docs.sparkSession)
    described = cut(describe(docs, id_col=id_col, text_col=text_col, width=width, percent=percent))
    linked = connected_components(cut(links(docs, described, text_col=text_col, width=width, percent=percent)))
    named = described.where("node is not null").groupBy("node").agg(F.min("id").alias("least"), F.count("*").alias("rows"))
    placed = named.join(linked, "node", "left").where("rows > 1 or component is not null").withColumn("component", F.coalesce("component", "node"))
    placed = cut(placed.select("node", "least", "component"))
    least = placed.groupBy("component").agg(F.min("least").alias("found"))
    found = placed.join(least.repartition(n), "component").select(F.col("node").alias("key"), "found").repartition(n)
    key = F.coalesce("node", F.unhex(F.hex(F.xxhash64("id", "said"))))  # rows without words are spread
    rows = described.select("id", "n", key.alias("key")).join(found, "key", "left")
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("found", "id").alias("component_id"))
