"""The pipeline's near copies against Jaccard similarities of all pairs."""

import random

import pytest

import corpus_pipeline
from rasterloom.llm import near_copies

SF = "/root/testdata/sf0.01"


def shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def wanted(rows):
    """The ids that stay: the least of each component."""
    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    by_size = sorted((i for i in sets if sets[i]), key=lambda i: len(sets[i]))
    for k, i in enumerate(by_size):
        for j in by_size[k + 1 :]:
            if len(sets[i]) < 0.8 * len(sets[j]):
                break
            same = len(sets[i] & sets[j])
            if same >= 0.8 * (len(sets[i]) + len(sets[j]) - same):
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return {root(i) for i in sets}


def test_no_near_copy_of_the_table_stays(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()}
    assert kept == wanted(rows) and len(kept) < len({t for _, t in rows})
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "secret_scan", "source_mixing", "sentencepiece"]


@pytest.mark.parametrize("small", [0, near_copies.SMALL])
def test_chains_large_groups_and_near_misses(spark, docs_of, monkeypatch, small):
    monkeypatch.setattr(near_copies, "SMALL", small)
    monkeypatch.setattr(near_copies, "ASKING", 16)
    monkeypatch.setattr(near_copies, "ANSWERING", 32)
    rng = random.Random(3)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    rows = []
    for i in range(150):  # copies with 1 to 9 words changed: some pairs are linked, some are linked over others only
        words = list(base)
        for at in rng.sample(range(200), rng.randint(1, 9)):
            words[at] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    chain = [f"c{k}" for k in range(300)]
    rows += [(1000 + k, " ".join(chain[k * 15 : k * 15 + 200])) for k in range(6)]
    docs = docs_of([(i, t, "en", "a") for i, t in rows]).select(corpus_pipeline.COLUMNS)
    assert {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()} == wanted(rows)


def test_rows_without_words_or_id(spark, docs_of):
    rows = [(1, None), (2, ""), (3, "  "), (None, "a b c d e f"), (None, "g h i j k l"), (4, "g h i j k l"), (4, "m n o p q r")]
    docs = docs_of([(i, t, "en", "a") for i, t in rows]).select(corpus_pipeline.COLUMNS)
    kept = {(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()}
    assert kept == {*rows} - {(None, "g h i j k l")}
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), SF).count() == 0
