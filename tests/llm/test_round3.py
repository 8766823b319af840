"""Jaccard join, Merkle manifest and filter audit against plain re-statements."""

import hashlib
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from awkward import AWKWARD
from pyspark.sql import functions as F

from rasterloom.llm import _bitmap, filter_audit, jaccard_join, merkle

# ---- Jaccard join -------------------------------------------------------------------


def shingles(text, width=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return frozenset(b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset()


def all_pairs(rows, percent=90):
    """(id, size, least id reachable) of all rows, by comparing all pairs."""
    sets = [shingles(r[1]) for r in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            same = len(a & b)
            if a and b and 100 * same >= percent * (len(a) + len(b) - same):
                label[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return Counter((r[0], len(sets[i]), least.get(root(i))) for i, r in enumerate(rows))


def joined(frame, **more):
    return Counter(tuple(r) for r in jaccard_join.join(frame, **more).select("doc_id", "n_shingles", "component_id").collect())


def test_join_of_the_smallest_table(small):
    assert joined(small) == all_pairs([(r["doc_id"], r["text"]) for r in small.collect()])


def test_join_of_awkward_rows(docs_of):
    assert joined(docs_of(AWKWARD)) == all_pairs(AWKWARD)
    assert jaccard_join.join(docs_of([])).count() == 0


def near_copies(rng, n, words, most):
    base = [f"w{x}" for x in rng.integers(0, 5000, words)]
    for i in range(n):
        own = list(base)
        for _ in range(int(rng.integers(0, most + 1))):
            own[int(rng.integers(len(own)))] = f"x{rng.integers(10**6)}"
        yield " ".join(own[: words - int(rng.integers(0, max(1, words // 15)))])


@pytest.mark.parametrize("sizes", [(60_000, 16, 1_000_000), (300, 3, 10**6), (120, 2, 150)])
def test_join_of_clusters_in_tiles_of_any_size(spark, monkeypatch, sizes):
    """Copies of copies of many lengths, over the edges of bands, in whole clusters and in blocks."""
    for name, value in zip(("SMALL", "BLOCKS", "LARGE"), sizes, strict=True):
        monkeypatch.setattr(jaccard_join, name, value)
    rng = np.random.default_rng(4)
    texts = [t for words, most in ((11, 1), (30, 1), (64, 2), (99, 3), (240, 9), (700, 25)) for t in near_copies(rng, 14, words, most)]
    rows = [(i, t) for i, t in enumerate(texts)]
    assert joined(spark.createDataFrame(rows, "doc_id long, text string")) == all_pairs(rows)


def test_linked_sets_agree_in_a_part():
    rng = np.random.default_rng(6)
    for size in [9, 10, 12, 13, 18, 19, 27, 28, 41, 100, 149, 150, 151, 1000]:
        for _ in range(30):
            own = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
            gone = int(rng.integers(0, len(own) // 10 + 1))
            other = np.unique(np.concatenate([own[gone:], rng.integers(0, 2**63, int(rng.integers(0, len(own) // 9 + 1)), dtype=np.uint64)]))
            same = len(np.intersect1d(own, other))
            if 100 * same >= 90 * (len(own) + len(other) - same) and same < max(len(own), len(other)):
                assert len(np.intersect1d(jaccard_join.part_keys(own, 90), jaccard_join.part_keys(other, 90)))


def test_bitmap_misses_nothing(spark):
    values = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)
    held = _bitmap.of(spark.createDataFrame([(int(v),) for v in values[:2500]], "v long"))
    assert _bitmap.holds(held, values[:2500]).all()
    assert _bitmap.holds(held, values[2500:]).sum() < 10


# ---- Merkle manifest ----------------------------------------------------------------


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        now = found[-1]
        found.append([sha("".join(now[i : i + 2])) for i in range(0, len(now), 2)])
    return found


def proof(tree, i):
    steps = []
    for level in tree[:-1]:
        steps.append(level[i ^ 1] if i ^ 1 < len(level) else None)
        i >>= 1
    return steps


def manifest(rows):
    """(id, leaf, subroot, root, proof) by the definition; rows (doc_id, text, lang, source, n_chars)."""
    item = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    groups = {}
    for d, text, lang, source, n in rows:
        groups.setdefault(lang, []).append((d is not None, d or 0, sha("".join(map(item, (d, source, lang, n, text)))), d))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [levels([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names]
    top = levels([t[-1][0] for t in trees])
    out = []
    for k, g in enumerate(names):
        for i, x in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            out.append((x[3], x[2], trees[k][-1][0], top[-1][0], tuple(proof(trees[k], i) + proof(top, k))))
    return Counter(out)


def check_manifest(frame, rows):
    values = (F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.col("text"))
    made = merkle.manifest(frame, merkle.leaf(*values)).withColumn("folded", merkle.fold(F.col("leaf"), F.col("siblings"), F.col("sides"))).collect()
    assert Counter((r["doc_id"], r["leaf"], r["subroot"], r["root"], tuple(r["siblings"])) for r in made) == manifest(rows)
    assert all(r["folded"] == r["root"] for r in made)


def test_manifest_of_awkward_rows(docs_of):
    rows = [(*r[:4], len(r[1]) if r[1] is not None else None) for r in AWKWARD]
    check_manifest(docs_of(AWKWARD), rows)
    assert merkle.manifest(docs_of([]), F.lit("x")).count() == 0


@pytest.mark.parametrize(("leaves", "near"), [(3, 0), (7, 1), (40, 4)])
def test_manifest_over_many_runs(spark, monkeypatch, leaves, near):
    """Groups of every small size and a large one, cut into runs of a few leaves that meet in both rounds."""
    monkeypatch.setattr(merkle, "LEAVES", leaves)
    monkeypatch.setattr(merkle, "NEAR", near)
    sizes = {None: 1, "a": 2, "b": 3, "c": 5, "é": 8, "z": 97, "zz": 1}
    rows = [(i * 7 % 200, f"t{i}", g, "s", i) for g, n in sizes.items() for i in range(n)]
    check_manifest(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), rows)


def test_tampering_is_found(spark):
    from rasterloom.llm import queries

    found = queries.op12_merkle_manifest(spark, "/root/testdata/sf0.001").collect()
    assert found and all(r["verified"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 != 0) for r in found)


# ---- filter audit -------------------------------------------------------------------


def audited(rows, labels):
    """All counts by applying the filters one after the other to lists of documents."""
    first = {}
    for r in rows:
        if r[0] is not None:
            first[r[1] or ""] = min(first.get(r[1] or "", r[0]), r[0])
    good, toxic = ({x[0] for x in labels if x[k] == 1 and x[0] is not None} for k in (1, 2))

    def fails(r):
        text, words = r[1] or "", (r[1] or "").encode().split()
        return {
            f
            for f, bad in (
                ("A", len(words) < 200), ("B", 100 * len(set(words)) < 50 * len(words)), ("C", 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text)),
                ("D", any(c in "#$%&*|" for c in text)), ("E", r[0] is not None and text in first and r[0] > first[text]),
            )
            if bad
        }

    out = {}
    for part in {r[2] or "" for r in rows}:
        docs = [(r[0], fails(r)) for r in rows if (r[2] or "") == part]
        total = Counter()
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone, stay = [d for d in left if f in d[1]], [d for d in left if f not in d[1]]
                early = [d for d in docs if f in d[1] and set(order[: step - 1]) & d[1]]
                out[part, "".join(order), step] = [len(stay), len(gone), len(early), sum(d[1] == {f} for d in docs), sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone)]
                total[f] += len(gone)
                left = stay
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


LABELS = [(1, 1, 0), (4, 1, 1), (4, None, 0), (None, 1, 1), (6, 0, 1), (99, 1, 1)]


def test_audit_of_awkward_rows(spark, docs_of):
    rows = [*AWKWARD, (7, "x", "de", "a"), (8, "", "en", "b"), (9, "A B# " * 150, "en", "b"), (10, " ".join(f"w{i}" for i in range(250)), "", "b")]
    labels = spark.createDataFrame([(*x, "z") for x in LABELS], "doc_id long, quality int, toxic int, part string")
    found = filter_audit.audit(docs_of(rows), labels).collect()
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in (*filter_audit.COUNTS, "shapley")) for r in found} == audited(rows, LABELS)
    assert len(found) == 600 * 3
    assert filter_audit.audit(docs_of([]), labels).count() == 0


def test_audit_splits_long_texts_like_short_ones(monkeypatch):
    text = "Abc d " * 500 + "tail"
    whole = filter_audit._own_bits(text)
    monkeypatch.setattr(filter_audit, "PIECE", 11)
    assert filter_audit._own_bits(text) == whole
