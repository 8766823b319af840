"""Substring removal by a common-prefix-aware distributed merge sort of suffixes.

A byte is removed if a `width`-byte string that covers it also starts anywhere
else. Suffixes are taken at content-defined anchors (see `_repeats`); with
each goes the text to its left that its windows need. Every map task sorts its
suffixes and writes them, front-coded (length of the prefix shared with the
suffix before, and the rest), as one run per merge partition; suffixes with
the same anchor meet in the same partition. There a loser tree that knows each
head's common prefix with the last output merges the runs, so bytes known to
be equal are never compared again, and hands on the common prefix of each two
neighbours. Inside one anchor's stretch of the sorted order, common prefixes
and common left contexts tell which windows are equal.

Equal suffixes of one map task travel once, whatever their number. Runs of hot
anchors are cut into blocks of a few windows, whose anchor is all that these
windows share, so that a hot group splits by content. Very hot ones, whose
blocks could still meet in one group by the hundred thousand, go window by
window, each named by a 128-bit hash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import arrow_map
from ._repeats import NO_ID, Corpus, chosen, chunks, find_runs, merge_spans

GRAM = 50
#: Windows in a block of a hot run.
BLOCK = 8
#: Groups up to this size are compared pair by pair, larger ones window by window.
PAIRWISE = 40


def byte_symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list]:
    joined = np.frombuffer(b"".join(texts), dtype=np.uint8)
    return joined, np.fromiter(map(len, texts), np.int64, len(texts)), texts


# ---- front-coded runs ---------------------------------------------------------


def common_prefix(a: bytes, b: bytes, at: int = 0) -> int:
    """Length of the common prefix, known to be `at` at least."""
    top = min(len(a), len(b))
    step = 64
    while at < top:
        if a[at : at + step] == b[at : at + step]:
            at += step
        elif step == 1:
            return at
        else:
            step >>= 3
            step = max(step, 1)
    return min(at, top)


#: A suffix: right text from the anchor on, left text before it, places (k, h, first window) of its occurrence, whether it occurs twice.
RUN_COLUMNS = ("shared", "rest_size", "rest", "left_size", "left", "twice", "k", "h", "at")


def pack_run(records: list[tuple[bytes, bytes, int, int, int, bool]]) -> dict[str, bytes]:
    """Front-code records sorted by (right, left)."""
    shared, rest, before = [], [], b""
    for right, *_ in records:
        known = common_prefix(before, right)
        shared.append(known)
        rest.append(right[known:])
        before = right
    lefts = [r[1] for r in records]
    pick = lambda i, kind: np.array([r[i] for r in records], dtype=kind).tobytes()
    return {
        "shared": np.array(shared, "<u2").tobytes(), "rest_size": np.array([len(x) for x in rest], "<u2").tobytes(), "rest": b"".join(rest),
        "left_size": np.array([len(x) for x in lefts], "<u2").tobytes(), "left": b"".join(lefts),
        "twice": pick(5, "<u1"), "k": pick(2, "<i8"), "h": pick(3, "<i8"), "at": pick(4, "<i4"),
    }


def unpack_run(run: dict[str, bytes]) -> Iterator[tuple[int, bytes, tuple]]:
    """(common prefix with the one before, right, record without right) in order."""
    arrays = [np.frombuffer(run[c], kind).tolist() for c, kind in (("shared", "<u2"), ("rest_size", "<u2"), ("left_size", "<u2"), ("twice", "<u1"), ("k", "<i8"), ("h", "<i8"), ("at", "<i4"))]
    rest, left, right, i, j = run["rest"], run["left"], b"", 0, 0
    for shared, size, left_size, twice, k, h, at in zip(*arrays, strict=True):
        right = right[:shared] + rest[i : i + size]
        yield shared, right, (left[j : j + left_size], k, h, at, bool(twice))
        i += size
        j += left_size


class LoserTree:
    """Merge of sorted runs; each head knows its common prefix with the last output, and only bytes after it are compared."""

    def __init__(self, runs: list[Iterator[tuple[int, bytes, tuple]]]):
        self.size = 1
        while self.size < len(runs):
            self.size *= 2
        self.runs = runs + [iter(())] * (self.size - len(runs))
        self.heads = [next(r, None) for r in self.runs]
        self.shared = [0] * self.size  # with the last output
        self.losers = [0] * self.size
        self.winner = self._play_all(1)

    def _play_all(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        return self._play(node, self._play_all(2 * node), self._play_all(2 * node + 1))

    def _play(self, node: int, a: int, b: int) -> int:
        """The smaller head goes on; the other stays at `node` with its common prefix with the winner."""
        first, second = self.heads[a], self.heads[b]
        if first is None or second is None:
            wins = a if second is None else b
        elif self.shared[a] != self.shared[b]:
            wins = a if self.shared[a] > self.shared[b] else b  # it still agrees where the other has left the last output
        else:
            known = common_prefix(first[1], second[1], self.shared[a])
            wins = a if first[1][known:] <= second[1][known:] else b
            self.shared[a + b - wins] = known
        self.losers[node] = a + b - wins
        return wins

    def __iter__(self) -> Iterator[tuple[int, bytes, tuple]]:
        """(common prefix with the output before, right, rest of the record)."""
        while (head := self.heads[self.winner]) is not None:
            run = self.winner
            yield self.shared[run], head[1], head[2]
            following = next(self.runs[run], None)
            self.heads[run] = following
            self.shared[run] = following[0] if following else 0
            node, winner = (run + self.size) // 2, run
            while node:
                winner = self._play(node, self.losers[node], winner)
                node //= 2
            self.winner = winner


# ---- deciding windows -----------------------------------------------------------


def _mask(low: int, high: int) -> int:
    return ((1 << (high - low + 1)) - 1) << low if high >= low else 0


def decide(rights: list[bytes], lefts: list[bytes], shared: list[int], twice: list[bool], width: int) -> list[int]:
    """For each distinct suffix of a group, the bit set of those j for which the window from j bytes left of the anchor repeats.

    `rights` are sorted; `shared[i]` is the common prefix of i - 1 and i.
    Windows of suffixes a and b are equal for the j with width - j <= common
    prefix and j <= common left context.
    """
    n = len(rights)
    full = [_mask(width - len(r), len(x)) for r, x in zip(rights, lefts, strict=True)]
    masks = [m if t else 0 for m, t in zip(full, twice, strict=True)]
    if n <= PAIRWISE:
        backward = [x[::-1] for x in lefts]
        for a in range(n):
            prefix = len(rights[a])
            for b in range(a + 1, n):
                prefix = min(prefix, shared[b])
                if masks[a] == full[a] and masks[b] == full[b]:
                    continue
                equal = _mask(width - prefix, common_prefix(backward[a], backward[b]))
                masks[a] |= equal
                masks[b] |= equal
        return masks
    deepest = max(map(len, lefts), default=0)
    backward = np.array([x[::-1].ljust(deepest, b"\0") for x in lefts], dtype=f"S{max(1, deepest)}")
    order = np.argsort(backward, kind="stable")
    grid = np.frombuffer(backward[order].tobytes(), np.uint8).reshape(n, -1)
    differ = grid[1:] != grid[:-1]
    left_shared = np.concatenate([[0], np.where(differ.any(axis=1), differ.argmax(axis=1), grid.shape[1])])
    low = np.array([width - len(r) for r in rights])
    high = np.array([len(x) for x in lefts])
    right_shared = np.array(shared)
    right_shared[0] = 0
    for j in range(int(low.min()), int(high.max()) + 1):
        right_class = np.cumsum(right_shared < width - j)
        left_class = np.empty(n, dtype=np.int64)
        left_class[order] = np.cumsum(left_shared < j)
        has = np.flatnonzero((low <= j) & (j <= high))
        _, back, count = np.unique(right_class[has] * (n + 1) + left_class[has], return_inverse=True, return_counts=True)
        for i in has[count[back] > 1].tolist():
            masks[i] |= 1 << j
    return masks


def _spans(mask: int, left: int, at: int, width: int) -> Iterator[tuple[int, int]]:
    """Byte spans of a record's repeated windows; window j starts at `at + left - j`."""
    while mask:
        low = (mask & -mask).bit_length() - 1
        length = (~(mask >> low) & ((mask >> low) + 1)).bit_length() - 1
        yield at + left - (low + length - 1), at + left - low + width
        mask &= ~_mask(low, low + length - 1)


# ---- map and merge tasks ----------------------------------------------------------


def _suffixes(part: pa.RecordBatch, width: int) -> Iterator[tuple[int, bytes, bytes, int, int, int]]:
    """(kind, right, left, k, h, first window) of the chosen runs; kind 1 is a block of a hot run, kind 2 the hash of a window of a very hot one."""
    texts = part.column("text").to_pylist()
    values, lengths, _ = byte_symbols(texts)
    runs = find_runs(values, lengths, width, GRAM)
    index, hot = chosen(part, runs)
    ks, hs = part.column("k").to_pylist(), part.column("h").to_pylist()
    for doc, first, last, anchor, heat in zip(runs.doc[index].tolist(), runs.first[index].tolist(), runs.last[index].tolist(), runs.anchor[index].tolist(), hot.tolist(), strict=True):
        text = texts[doc]
        if heat == 2:
            for at in range(first, last + 1):
                yield 2, xxhash.xxh3_128_digest(text[at : at + width]), b"", ks[doc], hs[doc], at
            continue
        if not heat:
            yield 0, text[anchor : last + width], text[first:anchor], ks[doc], hs[doc], first
            continue
        for j in range((anchor - last) // BLOCK, (anchor - first) // BLOCK + 1):  # blocks are counted from the anchor
            low, high = max(first, anchor - j * BLOCK - BLOCK + 1), min(last, anchor - j * BLOCK)
            pivot = anchor - j * BLOCK
            yield 1, text[pivot : high + width], text[low:pivot], ks[doc], hs[doc], low


def _core(kind: int, right: bytes, width: int) -> bytes:
    return right[: _core_size(kind, width)]


def _core_size(kind: int, width: int) -> int:
    """What records of a kind must share to be compared: the anchor's gram, the bytes common to a block's windows, the whole hash."""
    return (GRAM, width - BLOCK + 1, 16)[kind]


SPAN_KIND = 9


def union(spans: np.ndarray) -> np.ndarray:
    """Of (k, h, start, stop) the maximal stretches of each text; neighbouring windows of a repeat overlap, so they become one."""
    spans = spans[np.lexsort((spans[:, 2], spans[:, 1], spans[:, 0]))]
    if len(spans) < 2:
        return spans
    other = np.concatenate([[True], (spans[1:, :2] != spans[:-1, :2]).any(axis=1)])
    shift = np.cumsum(other) << 32  # a text's places lie behind those of the texts before it
    reach = np.maximum.accumulate(spans[:, 3] + shift)
    head = np.flatnonzero(np.concatenate([[True], spans[1:, 2] + shift[1:] > reach[:-1]]))
    last = np.append(head[1:], len(spans)) - 1
    return np.column_stack([spans[head, :3], reach[last] - shift[last]])


def removal_spans(corpus: Corpus, width: int, hold: int = 48 << 20) -> DataFrame:
    """(k, h, start, stop) of removed bytes of the distinct texts."""
    runs = corpus.repeated_runs(byte_symbols, width, GRAM)
    partitions = corpus.groups(runs)

    def sort_runs(batches):
        held: dict[tuple[int, bytes, bytes], list] = {}
        sure: list[list[int]] = []
        size = 0

        def flush():
            nonlocal size
            by_part: dict[tuple[int, int], list] = {}
            for (kind, right, left), (k, h, at, twice) in held.items():
                by_part.setdefault((kind, zlib.crc32(_core(kind, right, width)) % partitions), []).append((right, left, k, h, at, twice))
            for (kind, part), records in by_part.items():
                records.sort(key=lambda r: (r[0], r[1]))
                yield {"kind": kind, "part": part} | pack_run(records)
            whole = union(np.array(sure, dtype=np.int64).reshape(-1, 4))
            for i in range(0, len(whole), 5000):
                some = whole[i : i + 5000]
                empty = dict.fromkeys(RUN_COLUMNS, b"")
                yield empty | {"kind": SPAN_KIND, "part": zlib.crc32(some[:1].tobytes()) % partitions, "k": some[:, 0].tobytes(), "h": some[:, 1].tobytes(), "at": some[:, 2:].astype("<i4").tobytes()}
            held.clear(), sure.clear()
            size = 0

        def table(rows):
            kinds = {"kind": pa.int32(), "part": pa.int32()} | dict.fromkeys(RUN_COLUMNS, pa.binary())
            for row in rows:
                yield pa.RecordBatch.from_arrays([pa.array([row[c]], t) for c, t in kinds.items()], list(kinds))

        for part in chunks(batches):
            for kind, right, left, k, h, at in _suffixes(part, width):
                known = held.get((kind, right, left))
                if known is None:
                    held[kind, right, left] = [k, h, at, False]
                    size += len(right) + len(left) + 300
                elif known[:3] != [k, h, at]:  # seen twice by this task: this place is decided, the first one stands for both
                    known[3] = True
                    stop = at + (width if kind == 2 else len(left) + len(right))
                    if sure and sure[-1][:2] == [k, h] and sure[-1][2] <= at <= sure[-1][3]:  # goes on where the last one ends
                        sure[-1][3] = max(stop, sure[-1][3])
                    else:
                        sure.append([k, h, at, stop])
            if size > hold:
                yield from table(flush())
        yield from table(flush())

    def merge(key, found):
        kind = key[0].as_py()
        rows = found.to_pylist()
        out: list[tuple[int, int, int, int]] = []
        if kind == SPAN_KIND:
            parts = [np.column_stack([np.frombuffer(r["k"], "<i8"), np.frombuffer(r["h"], "<i8"), np.frombuffer(r["at"], "<i4").reshape(-1, 2)]) for r in rows]
            every = np.concatenate(parts)
        else:
            core = _core_size(kind, width)
            group: list = []
            lefts: dict[bytes, list] = {}  # of the records with the right text at hand

            def settle():
                if len(group) == 1 and not group[0][3]:
                    return
                if kind == 2:  # equal hashes are one record, as their left texts are empty
                    for *_, places in group:
                        out.extend((k, h, at, at + width) for k, h, at in places)
                    return
                masks = decide([g[1] for g in group], [g[2] for g in group], [g[0] for g in group], [g[3] for g in group], width)
                for mask, (_, _, left, _, places) in zip(masks, group, strict=True):
                    if mask:
                        for k, h, at in places:
                            out.extend((k, h, a, b) for a, b in _spans(mask, len(left), at, width))

            for shared, right, (left, k, h, at, twice) in LoserTree([unpack_run(r) for r in rows]):
                if shared < core:
                    settle()
                    group = []
                if not group or group[-1][1] != right:
                    lefts.clear()
                # the merge orders by the right text; equal right texts may come in any order of their left texts
                if (same := lefts.get(left)) is not None:
                    same[3] = True
                    same[4].append((k, h, at))
                else:
                    lefts[left] = [shared, right, left, twice, [(k, h, at)]]
                    group.append(lefts[left])
            settle()
            every = np.array(out, dtype=np.int64).reshape(-1, 4)
        every = union(every)
        return pa.table({"k": every[:, 0], "h": every[:, 1], "start": every[:, 2].astype(np.int32), "stop": every[:, 3].astype(np.int32)})

    schema = "kind int, part int, " + ", ".join(f"{c} binary" for c in RUN_COLUMNS)
    sorted_runs = arrow_map(corpus.with_runs(runs), sort_runs, schema)
    return sorted_runs.groupBy("kind", "part").applyInArrow(merge, "k long, h long, start int, stop int")


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 200) -> DataFrame:
    """One row per input row: id, `n_bytes`, `n_removed`, `n_spans`, `kept` (binary).

    Texts are UTF-8 bytes, a null text is empty, and matches never cross rows.
    Rows are told apart by id and text; rows equal in both, like all rows that
    share a text of at least `width` bytes, are removed whole. `width` must be
    at least 64. Long texts are searched piece by piece. The table may be
    empty; other columns are not read.
    """
    if width < GRAM + BLOCK + 6:
        raise ValueError(f"width must be at least {GRAM + BLOCK + 6}")
    corpus = Corpus.of(docs, id_col, text_col)

    def cut_out(batches):
        for part in chunks(batches):
            rows = []
            for text, copies, spans in zip(part.column("text").to_pylist(), part.column("copies").to_pylist(), part.column("spans").to_pylist(), strict=True):
                if copies != 1 and len(text) >= width:  # another row has the same text
                    cuts = [(0, len(text))]
                else:
                    cuts = merge_spans(spans, len(text))
                kept, at = [], 0
                for start, stop in cuts:
                    kept.append(text[at:start])
                    at = stop
                kept.append(text[at:])
                rows.append((len(text), sum(b - a for a, b in cuts), len(cuts), b"".join(kept)))
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([part.column("k"), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary())], ["k", "n_bytes", "n_removed", "n_spans", "kept"])

    spans = removal_spans(corpus, width)
    found = arrow_map(corpus.without(spans), cut_out, "k long, n_bytes long, n_removed long, n_spans long, kept binary")
    return found.select(F.nullif("k", F.lit(NO_ID)).alias(id_col), "n_bytes", "n_removed", "n_spans", "kept")
