"""Repeated word passages, found with prefix-partitioned suffix trees.

A window is `width` words in a row of one document; the words of a window
whose sequence also starts earlier are removed. Suffixes reach a task by the
words of their anchor (see `_repeats`), a prefix that is lengthened to the
whole window for hot anchors, and there are as many groups as the number of
suffixes asks for. In the task, suffixes are split by first word, and groups
too large for one subtree by further words, until each fits in memory.

A subtree is kept as its sorted suffixes and the lengths of the prefixes that
neighbours share: an internal node is a stretch of neighbours that share a
prefix of some length, its depth. Nodes at least `width` words deep are the
repeats, as far as the text that travels with an anchor reaches; all suffixes
below such a node but the earliest repeat that one for as many words as the
node is deep.

Equal stretches of one map task travel once, whatever their number.
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

GRAM = 8
#: Suffixes that one subtree holds at most, unless they share all words of a window.
GROUP = 150_000
SPAN_KIND = 9


def word_symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list]:
    """Hashes of all words, numbers of words, words of each text."""
    words = [t.split() for t in texts]  # on bytes: space and tab to carriage return
    known: dict[bytes, int] = {}
    digest = xxhash.xxh64_intdigest
    values = []
    for own in words:
        for word in own:
            value = known.get(word)
            if value is None:
                value = known[word] = digest(word)
            values.append(value)
    return np.array(values, dtype=np.uint64), np.fromiter(map(len, words), np.int64, len(words)), words


def prefix_groups(first_words: np.ndarray, rows: np.ndarray, width: int, limit: int, depth: int = 0) -> Iterator[np.ndarray]:
    """Split suffixes (rows of word ids) by prefixes as long as they need to be for groups of `limit` rows."""
    if len(rows) <= limit or depth == width:
        yield rows
        return
    column = first_words[rows, depth]
    order = np.argsort(column, kind="stable")
    pending: list[np.ndarray] = []
    held = 0
    for part in np.split(rows[order], np.flatnonzero(np.diff(column[order])) + 1):
        if len(part) > limit:
            yield from prefix_groups(first_words, part, width, limit, depth + 1)
            continue
        if held + len(part) > limit:
            yield np.concatenate(pending)
            pending, held = [], 0
        pending.append(part)
        held += len(part)
    if pending:
        yield np.concatenate(pending)


def subtree(suffixes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of the suffixes (rows of word ids, filled up with 0) and the length of the prefix each shares with the one before it.

    The order is stable, so equal suffixes keep the order they came in.
    """
    n, width = suffixes.shape
    keys = np.ascontiguousarray(suffixes.astype(">u4")).view(f"S{4 * width}").ravel()
    order = np.argsort(keys, kind="stable")
    differ = suffixes[order[1:]] != suffixes[order[:-1]]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    shared = np.minimum(shared, np.minimum(sizes[order[1:]], sizes[order[:-1]]))
    return order, np.concatenate([np.zeros(min(n, 1), np.int64), shared])


def internal_nodes(shared: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """All internal nodes at least `least` deep, level by level: first leaves, last leaves, depth."""
    for depth in range(least, int(shared.max(initial=0)) + 1):
        inside = np.concatenate([shared >= depth, [False]])
        first = np.flatnonzero(~inside[:-1] & inside[1:])
        last = np.flatnonzero(inside[:-1] & ~inside[1:])
        if len(first):
            branches = np.logical_or.reduceat(shared == depth, first + 1)
            yield first[branches], last[branches], depth


def later_windows(records: list[tuple[list[bytes], int, int, int]], width: int, limit: int = GROUP) -> tuple[np.ndarray, ...]:
    """(k, h, start, stop) spans of the windows of these records that start earlier in another of them, or in themselves."""
    number: dict[bytes, int] = {}
    flat = np.array([number.setdefault(w, len(number) + 1) for words, *_ in records for w in words], dtype=np.uint32)
    sizes = np.array([len(words) for words, *_ in records])
    k, h, at = (np.array([r[i] for r in records], dtype=np.int64) for i in (1, 2, 3))
    counts = sizes - width + 1
    owner = np.repeat(np.arange(len(records)), counts)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    place = np.repeat(np.cumsum(sizes) - sizes, counts) + offset
    length = sizes[owner] - offset
    order = np.lexsort((at[owner] + offset, h[owner], k[owner]))  # earliest first
    owner, offset, place, length = owner[order], offset[order], place[order], length[order]
    deepest = int(length.max(initial=width))
    view = np.lib.stride_tricks.sliding_window_view(np.concatenate([flat, np.zeros(deepest, np.uint32)]), deepest)
    repeated = np.zeros(len(owner), dtype=np.int64)  # words from the suffix's start that also start earlier
    for rows in prefix_groups(_Lazy(view, place), np.arange(len(owner)), width, limit):
        rows.sort()  # groups come in word order; rows of one node must be compared by their place in the corpus
        suffixes = np.where(np.arange(deepest) < length[rows, None], view[place[rows]], 0)
        leaves, shared = subtree(suffixes, length[rows])
        for first, last, depth in internal_nodes(shared, width):
            below = np.repeat(np.arange(len(first)), last - first + 1)
            leaf = rows[leaves[np.arange(len(below)) - np.repeat(np.cumsum(last - first + 1) - (last - first + 1), last - first + 1) + first[below]]]
            head = np.full(len(first), len(owner))
            np.minimum.at(head, below, leaf)
            head = head[below]
            # two rows of the input that are equal in id and text give the same place twice; neither is the earlier
            same = (k[owner[leaf]] == k[owner[head]]) & (h[owner[leaf]] == h[owner[head]]) & (at[owner[leaf]] + offset[leaf] == at[owner[head]] + offset[head])
            repeated[leaf[~same]] = depth
    hit = np.flatnonzero(repeated)
    start = (at[owner[hit]] + offset[hit]).astype(np.int32)
    hit, start = hit[turn := np.lexsort((start, owner[hit]))], start[turn]
    stop = (start + repeated[hit]).astype(np.int32)
    # stops of one record's suffixes only grow where spans touch, so a span is new where it starts behind all stops before it
    reach = np.maximum.accumulate(stop + owner[hit].astype(np.int64) * (1 << 32)) if len(hit) else stop
    new = np.ones(len(hit), dtype=bool)
    new[1:] = start[1:] + owner[hit][1:].astype(np.int64) * (1 << 32) > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(hit))[: len(first)] - 1
    who = owner[hit][first]
    return k[who], h[who], start[first], (reach[last] - who.astype(np.int64) * (1 << 32)).astype(np.int32) if len(hit) else stop


class _Lazy:
    """Columns of the suffixes' words, read as they are asked for."""

    def __init__(self, view: np.ndarray, place: np.ndarray):
        self.view, self.place = view, place

    def __getitem__(self, key):
        rows, depth = key
        return self.view[self.place[rows], depth]


def _stretches(part: pa.RecordBatch, width: int) -> Iterator[tuple[int, bytes, bytes, int, int, int]]:
    """(kind, prefix, words joined by a blank, k, h, first window) of the chosen runs; kind 1 is a single window of a hot run."""
    values, lengths, words = word_symbols(part.column("text").to_pylist())
    runs = find_runs(values, lengths, width, GRAM)
    index, heat = chosen(part, runs)
    ks, hs = part.column("k").to_pylist(), part.column("h").to_pylist()
    for doc, first, last, anchor, is_hot in zip(runs.doc[index].tolist(), runs.first[index].tolist(), runs.last[index].tolist(), runs.anchor[index].tolist(), heat.tolist(), strict=True):
        own = words[doc]
        if is_hot:
            for at in range(first, last + 1):
                window = b" ".join(own[at : at + width])
                yield 1, window, window, ks[doc], hs[doc], at
        else:
            yield 0, b" ".join(own[anchor : anchor + GRAM]), b" ".join(own[first : last + width]), ks[doc], hs[doc], first


def removal_spans(corpus: Corpus, width: int, hold: int = 48 << 20) -> DataFrame:
    """(k, h, start, stop), in words, of what is removed from the distinct texts."""
    runs = corpus.repeated_runs(word_symbols, width, GRAM)
    partitions = corpus.groups(runs)

    def gather(batches):
        held: dict[tuple[int, bytes], list] = {}
        sure: list[tuple[int, int, int, int]] = []
        size = 0

        def table():
            nonlocal size
            by_part: dict[tuple[int, int], list] = {}
            for (kind, words), (prefix, k, h, at) in held.items():
                by_part.setdefault((kind, zlib.crc32(prefix) % partitions), []).append((words, k, h, at))
            rows = []
            for (kind, part), found in by_part.items():
                found.sort()
                rows.append((kind, part, b"\n".join(f[0] for f in found), *(np.array([f[i] for f in found], "<i8").tobytes() for i in (1, 2, 3))))
            for i in range(0, len(sure), 5000):
                some = np.array(sure[i : i + 5000], dtype="<i8")
                rows.append((SPAN_KIND, zlib.crc32(some[:1].tobytes()) % partitions, b"", some[:, 0].tobytes(), some[:, 1].tobytes(), some[:, 2:].tobytes()))
            held.clear(), sure.clear()
            size = 0
            kinds = {"kind": pa.int32(), "part": pa.int32(), "words": pa.binary(), "k": pa.binary(), "h": pa.binary(), "at": pa.binary()}
            for row in rows:
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds.values(), strict=True)], list(kinds))

        for part in chunks(batches):
            for kind, prefix, words, k, h, at in _stretches(part, width):
                known = held.get((kind, words))
                if known is None:
                    held[kind, words] = [prefix, k, h, at]
                    size += len(words) + 400
                    continue
                early, late = sorted([tuple(known[1:]), (k, h, at)])
                if early != late:  # the later place is decided, the earlier one stands for both
                    known[1:] = early
                    sure.append((*late, late[2] + words.count(b" ") + 1))
            if size > hold:
                yield from table()
        yield from table()

    def subtrees(key, found):
        rows = found.to_pylist()
        if key[0].as_py() == SPAN_KIND:
            both = [np.frombuffer(r["at"], "<i8").reshape(-1, 2) for r in rows]
            k, h = (np.concatenate([np.frombuffer(r[c], "<i8") for r in rows]) for c in ("k", "h"))
            spans = np.concatenate(both).astype(np.int32)
            return pa.table({"k": k, "h": h, "start": spans[:, 0], "stop": spans[:, 1]})
        records = [
            (words.split(b" "), k, h, at)
            for r in rows
            for words, k, h, at in zip(r["words"].split(b"\n"), *(np.frombuffer(r[c], "<i8").tolist() for c in ("k", "h", "at")), strict=True)
        ]
        return pa.table(dict(zip(("k", "h", "start", "stop"), later_windows(records, width), strict=True)))

    schema = "kind int, part int, words binary, k binary, h binary, at binary"
    stretches = arrow_map(corpus.with_runs(runs), gather, schema)
    return stretches.groupBy("kind", "part").applyInArrow(subtrees, "k long, h long, start int, stop int")


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 20) -> DataFrame:
    """One row per input row: id, `n_words`, `n_removed`, `kept` (binary, words joined by one space).

    Earlier means a smaller id, or the same document and an earlier start; a
    null id comes before all others. Rows that share an id are ordered by a
    hash of their texts; rows equal in id and text count as one document seen
    twice and get equal results. A null text has no words. `width` must
    exceed 8. Long texts are searched piece by piece, but split into words
    whole. The table may be empty; other columns are not read.
    """
    if width <= GRAM:
        raise ValueError(f"width must exceed {GRAM}")
    corpus = Corpus.of(docs, id_col, text_col)

    def cut_out(batches):
        for part in chunks(batches):
            rows = []
            for text, copies, spans in zip(part.column("text").to_pylist(), part.column("copies").to_pylist(), part.column("spans").to_pylist(), strict=True):
                words = text.split()
                if copies is None and len(words) >= width:  # an earlier row has the same text
                    cuts = [(0, len(words))]
                else:
                    cuts = merge_spans(spans, len(words))
                kept, at = [], 0
                for start, stop in cuts:
                    kept += words[at:start]
                    at = stop
                kept += words[at:]
                rows.append((len(words), len(words) - len(kept), b" ".join(kept)))
            n, removed, kept = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([part.column("k"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())], ["k", "n_words", "n_removed", "kept"])

    found = arrow_map(corpus.without(removal_spans(corpus, width)), cut_out, "k long, n_words long, n_removed long, kept binary")
    return found.select(F.nullif("k", F.lit(NO_ID)).alias(id_col), "n_words", "n_removed", "kept")
