"""What the two repeat removers share: finding the stretches of text that can repeat at all, and cutting repeats out.

A window is `width` symbols in a row (bytes or words). Its anchor is the
`gram` symbols in it with the least hash, the leftmost on ties, so equal
windows have equal anchors at equal places. Neighbouring windows with the same
anchor form a run, the stretch of text that they cover. A window whose anchor
occurs once in the corpus repeats nowhere, so only runs of repeated anchors
leave the document; the check is exact but for hash collisions, which merely
let a needless run through.

Documents with equal texts are found first by a 128-bit hash of the text; one
of them stands for all. The documents are shuffled once, by row, and every
later step reuses that exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import arrow_map, cut, partitions, slices

#: Stands for a null id; smaller than every other.
NO_ID = -(1 << 63)
BASE = 0x9E3779B97F4A7C15
#: Anchors in more places than these are hot, or very hot; their runs are cut into shorter parts.
HOT, VERY_HOT = 20_000, 200_000
#: Windows of one document that are looked at together.
PIECE = 1 << 20
#: The low bits of a hash give way to its place, so that the leftmost wins ties; what is left is the same for every text.
PLACE_BITS = np.uint64(40)
#: Runs that one group of the later shuffle holds, about.
GROUP_RUNS = 100_000


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64."""
    ones = np.ones(1, dtype=np.uint64)
    up = np.cumprod(np.concatenate([ones, np.full(size - 1, BASE, dtype=np.uint64)]))
    down = np.cumprod(np.concatenate([ones, np.full(size - 1, pow(BASE, -1, 1 << 64), dtype=np.uint64)]))
    return up, down


@dataclass
class Runs:
    """Runs of all documents of a chunk: document, ordinal in it, first and last window, place of the anchor (all in the document), anchor hash."""

    doc: np.ndarray
    ordinal: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    hash: np.ndarray


def find_runs(symbols: np.ndarray, lengths: np.ndarray, width: int, gram: int) -> Runs:
    """Runs of documents that lie end to end in `symbols`. Runs of a long document also end at multiples of PIECE windows."""
    if len(symbols) <= PIECE + width:
        return _runs(symbols, lengths, width, gram)
    found = []
    for doc, (start, size) in enumerate(zip((np.cumsum(lengths) - lengths).tolist(), lengths.tolist(), strict=True)):
        ordinals = 0
        for at in range(0, max(1, size - width + 1), PIECE):
            piece = symbols[start + at : start + min(size, at + PIECE + width - 1)]
            runs = _runs(piece, np.array([len(piece)]), width, gram)
            found.append(Runs(runs.doc + doc, runs.ordinal + ordinals, runs.first + at, runs.last + at, runs.anchor + at, runs.hash))
            ordinals += len(runs.doc)
    return Runs(*(np.concatenate([getattr(x, name) for x in found]) for name in Runs.__dataclass_fields__))


def _runs(symbols: np.ndarray, lengths: np.ndarray, width: int, gram: int) -> Runs:
    total = len(symbols)
    offsets = np.cumsum(lengths) - lengths
    windows = np.maximum(lengths - width + 1, 0)
    doc = np.repeat(np.arange(len(lengths)), windows)
    if not len(doc):
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none, none, none)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(windows) - windows, windows) + offsets[doc]
    up, down = _powers(1 << max(16, int(total).bit_length()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * up[:total])])
    grams = (sums[gram:] - sums[:-gram]) * down[: total - gram + 1]
    grams *= np.uint64(0xD6E8FEB86659FD93)
    grams ^= grams >> np.uint64(32)
    grams *= np.uint64(0xD6E8FEB86659FD93)
    low = (np.uint64(1) << PLACE_BITS) - np.uint64(1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    span, reach = width - gram + 1, 1
    while reach * 2 <= span:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < span:
        least = np.minimum(least[: len(least) - (span - reach)], least[span - reach :])
    anchor = (least[start] & low).astype(np.int64)
    head = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0))
    tail = np.append(head[1:], len(doc)) - 1
    owner = doc[head]
    ordinal = np.arange(len(head)) - np.searchsorted(owner, owner)
    base = offsets[owner]
    return Runs(owner, ordinal, start[head] - base, start[tail] - base, anchor[head] - base, grams[anchor[head]].view(np.int64))


Symbols = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, list]]


def chunks(batches, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Pieces of about `limit` bytes of text, one row at least."""
    return slices(batches, "text", limit)


@dataclass
class Corpus:
    """`rows`: (k, h, text) of every row, k the id and h a hash of the text; `firsts`: (k, h, copies) of one row per distinct text."""

    rows: DataFrame
    firsts: DataFrame

    @classmethod
    def of(cls, docs: DataFrame, id_col: str, text_col: str) -> Corpus:
        text = F.coalesce(F.col(text_col), F.lit(""))
        rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("k"), F.xxhash64(text).alias("h"), text.cast("binary").alias("text"))
        same = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("k"), F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("h2"))
        firsts = same.groupBy("h", "h2").agg(F.min("k").alias("k"), F.count("*").alias("copies")).select("k", "h", "copies")
        return cls(rows, firsts)

    def repeated_runs(self, symbols: Symbols, width: int, gram: int) -> DataFrame:
        """(k, h, runs): for each distinct text the runs with a repeated anchor, as 4 * ordinal, plus 1 if the anchor is hot or 2 if very hot."""

        def anchors(batches):
            for part in chunks(batches):
                values, lengths, _ = symbols(part.column("text").to_pylist())
                runs = find_runs(values, lengths, width, gram)
                k, h = part.column("k").to_numpy(), part.column("h").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(runs.hash, pa.int64()), pa.array(k[runs.doc]), pa.array(h[runs.doc]), pa.array(runs.ordinal.astype(np.int32))], ["anchor", "k", "h", "r"])

        firsts = self.rows.join(self.firsts.select("k", "h").hint("shuffle_hash"), ["k", "h"]).select("k", "h", "text")
        found = arrow_map(firsts, anchors, "anchor long, k long, h long, r int")
        # counts are combined before their shuffle and dealt anew, so that the join does not inherit the
        # grouping's partitions and Spark can split the side of a frequent anchor
        places = found.groupBy("anchor").agg(F.count("*").alias("places")).where("places > 1")
        places = places.repartition(partitions(found.sparkSession))
        repeated = found.join(places, "anchor")
        code = F.col("r") * 4 + (F.col("places") > HOT).cast("int") + (F.col("places") > VERY_HOT).cast("int")
        return cut(repeated.groupBy("k", "h").agg(F.collect_list(code).alias("runs")))

    def groups(self, runs: DataFrame) -> int:
        """Groups to deal the runs to, so that a group's size does not grow with the corpus."""
        total = runs.agg(F.sum(F.size("runs"))).first()[0] or 0
        return max(4 * partitions(runs.sparkSession), -(-total // GROUP_RUNS))

    def with_runs(self, runs: DataFrame) -> DataFrame:
        return self.rows.join(runs.hint("shuffle_hash"), ["k", "h"]).select("k", "h", "text", "runs")

    def without(self, spans: DataFrame) -> DataFrame:
        """(k, h, text, copies, spans): every row; copies is null where another row stands for the text."""
        facts = self.firsts.join(spans.groupBy("k", "h").agg(F.collect_list(F.struct("start", "stop")).alias("spans")), ["k", "h"], "left")
        return self.rows.join(facts.hint("shuffle_hash"), ["k", "h"], "left").select("k", "h", "text", "copies", "spans")


def chosen(part: pa.RecordBatch, runs: Runs) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the runs that a chunk's `runs` column names, and how hot each is: 0, 1 or 2."""
    lists = part.column("runs")
    codes = lists.flatten().to_numpy()
    owner = np.repeat(np.arange(part.num_rows), pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
    first = np.searchsorted(runs.doc, np.arange(part.num_rows))
    return first[owner] + (codes >> 2), codes & 3


def merge_spans(spans: list[dict] | None, size: int) -> list[tuple[int, int]]:
    """Disjoint maximal spans, in order."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted((s["start"], s["stop"]) for s in spans or ()):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, min(stop, size)))
    return out
