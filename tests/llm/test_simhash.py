import numpy as np
import pytest
import xxhash
from awkward import AWKWARD
from hypothesis import given, settings
from hypothesis import strategies as st

from rasterloom.llm import _graph, simhash


def fingerprint(text, width=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hashes) > len(hashes))


def groups(values, radius=4):
    """Component labels by comparing all pairs."""
    label = list(range(len(values)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


def check(frame, rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    prints = [fingerprint(r[1]) for r in rows]
    label = groups(prints)
    least = {}
    for r, g in zip(rows, label, strict=True):
        least.setdefault(g, r[0])
    want = sorted((str(r[0]), f"{p:016x}", least[g]) for r, p, g in zip(rows, prints, label, strict=True))
    got = sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(frame).collect())
    assert got == want


def test_smallest_table_equals_brute_force(small):
    check(small, [(r["doc_id"], r["text"]) for r in small.collect()])


def test_awkward_rows(docs_of):
    check(docs_of(AWKWARD), AWKWARD)
    assert simhash.near_duplicates(docs_of([])).count() == 0


def test_chains_and_hot_groups(spark):
    rng = np.random.default_rng(5)
    chain = [0]
    for i in range(12):  # each step moves 4 bits, ends are far apart
        chain.append(chain[-1] ^ (15 << (4 * i)))
    near = [int(rng.integers(1 << 62)) for _ in range(3)]
    values = {*chain, *(n ^ (1 << int(a)) ^ (1 << int(b)) for n in near for a, b in rng.integers(0, 63, (150, 2))), *(int(x) for x in rng.integers(0, 1 << 62, 300))}
    values = sorted(values)
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    found = {r["node"]: r["component"] for r in _graph.connected_components(simhash.links(frame, 4)).collect()}
    label = groups(values)
    want = {v: values[g] for v, g in zip(values, label, strict=True)}
    assert {v: found.get(v, v) for v in values} == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 255), min_size=1, max_size=30, unique=True), min_size=1, max_size=5), st.integers(0, 4), st.sampled_from([1, 1 << 20]))
def test_forest_equals_all_pairs(shards, radius, frontier):
    spread = [[v * 0x0101010101010101 % (1 << 64) for v in s] for s in shards]
    values = np.array([v for s in spread for v in s], dtype=np.uint64)
    forest = simhash.BKForest(np.repeat(np.arange(len(shards)), [len(s) for s in shards]), values)
    start, want = 0, []
    for s in spread:
        want += [start + g for g in groups(s, radius)]
        start += len(s)
    assert forest.components(radius, frontier).tolist() == want


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(1, 2), (2, 1), (2, 3), (9, 8)], [(i, i + 1) for i in range(60)]])
def test_components(spark, edges):
    frame = spark.createDataFrame(edges, "u long, v long")
    found = {r["node"]: r["component"] for r in _graph.connected_components(frame).collect()}
    nodes = sorted({x for e in edges if e[0] != e[1] for x in e})
    label = {n: n for n in nodes}
    for _ in nodes:
        for u, v in edges:
            if u != v:
                label[u] = label[v] = min(label[u], label[v])
    assert found == label


def test_a_large_shard_is_split_without_losing_links(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 16)
    rng = np.random.default_rng(9)
    values = sorted({int(5 ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c))) for a, b, c in rng.integers(0, 62, (250, 3))})
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    found = {r["node"]: r["component"] for r in _graph.connected_components(simhash.links(frame, 4)).collect()}
    want = {v: values[g] for v, g in zip(values, groups(values), strict=True)}
    assert {v: found.get(v, v) for v in values} == want


def test_long_texts_are_hashed_in_pieces():
    text = "  one two\tthree FOUR five six\nseven " * 40 + "last"
    for width in (1, 4, 5):
        whole = [x for own in simhash.shingle_hashes(text, width) for x in own]
        for piece in (1, 7, 64):
            assert [x for own in simhash.shingle_hashes(text, width, piece) for x in own] == whole
    assert list(simhash.shingle_hashes("a b", 4, 1)) == list(simhash.shingle_hashes("a b", 4))
    long = "word%d " * 9 % tuple(range(9)) * 300_000
    assert int(simhash._fingerprint_chunk([long], 4).view(np.uint64)[0]) == fingerprint(long)
