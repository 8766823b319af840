"""Suffix-sort and suffix-tree removal against brute force."""

import random

import numpy as np
import pytest
from awkward import AWKWARD
from hypothesis import given, settings
from hypothesis import strategies as st

from rasterloom.llm import _repeats, suffix_sort, suffix_tree


def brute_bytes(rows, width):
    texts = [(r[1] or "").encode() for r in rows]
    count = {}
    for t in texts:
        for i in range(len(t) - width + 1):
            count[t[i : i + width]] = count.get(t[i : i + width], 0) + 1
    out = []
    for r, t in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - width + 1):
            if count[t[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((str(r[0]), len(t), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), kept))
    return sorted(out)


def brute_words(rows, width):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    first = {}
    words = [(r[1] or "").encode().split() for r in rows]
    for r, own in zip(rows, words, strict=True):
        for i in range(len(own) - width + 1):
            first.setdefault(tuple(own[i : i + width]), (r[0], i))
    out = []
    for r, own in zip(rows, words, strict=True):
        gone = [False] * len(own)
        for i in range(len(own) - width + 1):
            if first[tuple(own[i : i + width])] != (r[0], i):
                gone[i : i + width] = [True] * width
        out.append((str(r[0]), len(own), sum(gone), b" ".join(w for w, g in zip(own, gone, strict=True) if not g)))
    return sorted(out)


def by_bytes(frame, width):
    return sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix_sort.remove_repeats(frame, width=width).collect())


def by_words(frame, width):
    return sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], bytes(r["kept"])) for r in suffix_tree.remove_repeats(frame, width=width).collect())


def test_smallest_table(small):
    rows = [(r["doc_id"], r["text"]) for r in small.collect()]
    assert by_bytes(small, 200) == brute_bytes(rows, 200)
    assert by_words(small, 20) == brute_words(rows, 20)


def test_awkward_rows(docs_of):
    frame = docs_of(AWKWARD)
    assert by_bytes(frame, 200) == brute_bytes(AWKWARD, 200)
    assert by_words(frame, 20) == brute_words(AWKWARD, 20)
    assert suffix_sort.remove_repeats(docs_of([])).count() == suffix_tree.remove_repeats(docs_of([])).count() == 0


def spliced(seed, n=40, alphabet="abcdefgh "):
    """Documents that share passages at odd offsets, with copies and runs of one letter."""
    rng = random.Random(seed)
    passages = ["".join(rng.choice(alphabet) for _ in range(rng.randint(60, 260))) for _ in range(6)] + ["z" * 150]
    rows = []
    for i in range(n):
        parts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 90)))]
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            parts += [p[a : a + rng.randint(40, 260)], "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30)))]
        rows.append((i, "".join(parts)))
    rows += [(n + i, rows[i][1]) for i in range(3)]
    return [(*r, "en", "s") for r in rows]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("hot", [None, "hot", "very hot"])
def test_spliced_passages(docs_of, monkeypatch, seed, hot):
    if hot:  # every repeated anchor counts as such
        monkeypatch.setattr(_repeats, "HOT", 1)
        monkeypatch.setattr(_repeats, "VERY_HOT", 1 if hot == "very hot" else 10**9)
    rows = spliced(seed)
    assert by_bytes(docs_of(rows), 70) == brute_bytes(rows, 70)
    words = [(i, " ".join(t), *x) for i, t, *x in spliced(seed, 25, "abcd")]
    assert by_words(docs_of(words), 20) == brute_words(words, 20)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=6).map(lambda b: bytes(x % 3 for x in b)), max_size=8).map(sorted), max_size=6))
def test_loser_tree_merges_and_knows_common_prefixes(runs):
    packed = [suffix_sort.unpack_run(suffix_sort.pack_run([(r, b"", 0, 0, 0, False) for r in run])) for run in runs]
    found = list(suffix_sort.LoserTree(packed))
    want = sorted(r for run in runs for r in run)
    assert [f[1] for f in found] == want
    assert [f[0] for f in found[1:]] == [suffix_sort.common_prefix(a, b) for a, b in zip(want, want[1:])]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6))
def test_large_groups_decide_like_small_ones(seed):
    rng = random.Random(seed)
    width, records = 20, set()
    for _ in range(rng.randint(2, 30)):
        left, right = (bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 6))) for _ in range(2))
        core = b"ANCHORANCHOR"
        if len(left) + len(core) + len(right) >= width and len(core + right) <= width:
            records.add((core + right, left))
    records = sorted(records)
    if not records:
        return
    rights, lefts = [r for r, _ in records], [x for _, x in records]
    shared = [0] + [suffix_sort.common_prefix(a, b) for a, b in zip(rights, rights[1:])]
    twice = [rng.random() < 0.2 for _ in records]
    small = suffix_sort.decide(rights, lefts, shared, twice, width)
    kept, suffix_sort.PAIRWISE = suffix_sort.PAIRWISE, 0
    try:
        assert suffix_sort.decide(rights, lefts, shared, twice, width) == small
    finally:
        suffix_sort.PAIRWISE = kept


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=200), st.integers(5, 12), st.integers(2, 4))
def test_runs_cover_every_window_once_and_depend_on_content(symbols, width, gram):
    values = np.array(symbols + symbols, dtype=np.uint64)
    runs = _repeats.find_runs(values, np.array([len(symbols), len(symbols)]), width, gram)
    windows = [[(a, b, c) for d, a, b, c in zip(runs.doc, runs.first, runs.last, runs.anchor, strict=True) if d == doc] for doc in (0, 1)]
    assert windows[0] == windows[1]
    covered = [w for a, b, _ in windows[0] for w in range(a, b + 1)]
    assert covered == list(range(max(0, len(symbols) - width + 1)))
    assert all(b <= c and c + gram <= a + width for a, b, c in windows[0])


def test_prefix_groups_bound_their_size():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 3, (500, 6))
    parts = list(suffix_tree.prefix_groups(words, np.arange(500), 6, 40))
    assert sorted(np.concatenate(parts).tolist()) == list(range(500))
    for p in parts:
        assert len(p) <= 40 or len(np.unique(words[p], axis=0)) == 1
    owner = {tuple(words[r]): i for i, p in enumerate(parts) for r in p}
    assert all(owner[tuple(words[r])] == i for i, p in enumerate(parts) for r in p)


def test_long_texts_have_runs_of_their_own_whatever_is_beside_them(monkeypatch):
    monkeypatch.setattr(_repeats, "PIECE", 64)
    rng = np.random.default_rng(3)
    long, short = rng.integers(0, 4, 500), rng.integers(0, 4, 30)
    runs = lambda *docs: _repeats.find_runs(np.concatenate(docs), np.array([len(d) for d in docs]), 12, 4)
    alone, beside = runs(long), runs(short, long, short)
    mine = beside.doc == 1
    for name in ("ordinal", "first", "last", "anchor", "hash"):
        assert getattr(alone, name).tolist() == getattr(beside, name)[mine].tolist()
    assert [w for a, b in zip(alone.first, alone.last, strict=True) for w in range(a, b + 1)] == list(range(489))
    again = runs(short)
    assert again.hash.tolist() == beside.hash[beside.doc == 0].tolist() == beside.hash[beside.doc == 2].tolist()


def test_internal_nodes_equal_all_pairs():
    rng = np.random.default_rng(4)
    sizes = rng.integers(4, 9, 120)
    suffixes = np.where(np.arange(8) < sizes[:, None], rng.integers(1, 3, (120, 8)), 0).astype(np.uint32)
    order, shared = suffix_tree.subtree(suffixes, sizes)
    prefix = lambda a, b: next((i for i in range(min(sizes[a], sizes[b])) if suffixes[a][i] != suffixes[b][i]), int(min(sizes[a], sizes[b])))
    want = set()
    for a in range(120):
        for b in range(a):
            depth = prefix(a, b)
            if depth >= 4:
                want.add((depth, frozenset(c for c in range(120) if prefix(a, c) >= depth or c == a)))
    found = {(depth, frozenset(order[a : b + 1].tolist())) for first, last, depth in suffix_tree.internal_nodes(shared, 4) for a, b in zip(first.tolist(), last.tolist(), strict=True)}
    assert found == want


def test_neighbouring_windows_travel_as_one_span(spark, docs_of):
    rng = random.Random(6)
    shared = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    docs = docs_of([(i, f"{i} head {shared} tail {i}") for i in range(60)])
    corpus = _repeats.Corpus.of(docs, "doc_id", "text")
    found = suffix_sort.removal_spans(corpus, 200).groupBy("k").count().collect()
    # the copies of a task are one span each; only the first one of a task has spans from every merge
    assert len(found) == 60 and sum(r["count"] for r in found) < 60 * 10


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_union_of_spans(seed):
    rng = np.random.default_rng(seed)
    start = rng.integers(0, 300, 200)
    spans = np.column_stack([rng.integers(-2, 2, 200), rng.integers(-2, 2, 200), start, start + rng.integers(1, 30, 200)])
    want = []
    for k, h in sorted({(int(k), int(h)) for k, h, *_ in spans}):
        own = [{"start": int(a), "stop": int(b)} for i, j, a, b in spans if (i, j) == (k, h)]
        want += [(k, h, a, b) for a, b in _repeats.merge_spans(own, 1000)]
    assert list(map(tuple, suffix_sort.union(spans).tolist())) == want
    assert suffix_sort.union(spans[:0]).shape == (0, 4) and suffix_sort.union(spans[:1]).tolist() == spans[:1].tolist()
