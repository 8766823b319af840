"""Shards of nearest neighbours: as few as tasks can hold, linked in pieces, each graph read once by a task."""

import dataclasses

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.llm import ann


def unit(rows, width=16, seed=0):
    vectors = np.random.default_rng(seed).normal(size=(rows, width))
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


def frame_of(spark, vectors):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")


def test_many_unit_vectors_are_one_shard(spark, monkeypatch):
    """The work is queries x shards: unit vectors once fell into two bands as they were rounded, and shards ended at 8,192 rows."""
    seen = {}
    search = ann.search_index

    def spy(index, queries, bands, *rest):
        seen["shards"] = bands.agg(F.sum("shards")).first()[0]
        seen["graphs"] = index.count()
        return search(index, queries, bands, *rest)

    monkeypatch.setattr(ann, "search_index", spy)
    vectors = unit(20_000, width=8)
    found = ann.nearest(frame_of(spark, vectors), query=F.col("vec_id") % 400 == 0).collect()
    assert seen == {"shards": 1, "graphs": 1}
    got = {}
    for r in found:
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    scores = vectors[::400] @ vectors.T
    scores[np.arange(50), np.arange(0, 20_000, 400)] = -9
    best = np.argsort(-scores, axis=1)[:, :20]
    assert np.mean([len(got[400 * i] & set(b.tolist())) / 20 for i, b in enumerate(best)]) >= 0.95


@pytest.mark.parametrize("piece_rows", [37, 1000])
def test_pieces_link_like_the_whole(piece_rows):
    points = ann._points(unit(1000), 0.0)
    whole = ann._ahead(points, 0, 24, 96)
    parts = [ann._ahead(points[: start + piece_rows], start, 24, 96) for start in range(0, 1000, piece_rows)]
    for one, many in zip(whole, zip(*parts, strict=True), strict=True):
        np.testing.assert_allclose(one, np.concatenate(many), rtol=1e-5)


def test_candidates_over_several_blocks_of_columns(monkeypatch):
    points = ann._points(unit(900), 0.0)
    monkeypatch.setattr(ann, "WIDTH", 128)
    pick, value = ann._candidates(points, 700, 900, 50)
    near = points[700:] @ points.T
    near[np.arange(900)[None] >= np.arange(700, 900)[:, None]] = -np.inf
    np.testing.assert_allclose(value, -np.sort(-near, axis=1)[:, :50], rtol=1e-5)
    assert (np.sort(pick, axis=1) == np.sort(np.argsort(-near, axis=1)[:, :50], axis=1)).mean() > 0.99


def test_pieces_and_shards_through_spark(spark):
    vectors = unit(3000)
    options = ann.GraphOptions(shard_rows=1000, piece_rows=90, block_queries=16)
    got = {}
    for r in ann.nearest(frame_of(spark, vectors), options=options).collect():
        got.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    scores = vectors[::20].astype(float) @ vectors.T.astype(float)
    assert all(abs(scores[q // 20, j] - x) < 1e-12 for q, own in got.items() for j, x in own.items())
    scores[np.arange(150), np.arange(0, 3000, 20)] = -9
    best = np.argsort(-scores, axis=1)[:, :20]
    assert np.mean([len(set(got[20 * i]) & set(b.tolist())) / 20 for i, b in enumerate(best)]) >= 0.95


def test_unsettled_queries_end_in_a_scan():
    """Vectors without any structure: beams of 48 and 96 miss many, what does not settle is scanned."""
    vectors = np.random.default_rng(5).normal(size=(12_000, 128))
    options = dataclasses.replace(ann.GraphOptions(), widest=96)
    graph = ann.Graph.build(vectors, options)
    asked = np.random.default_rng(6).normal(size=(40, 128))
    best = np.argsort(-(asked @ vectors.T), axis=1)[:, :20]
    lengths = np.linalg.norm(vectors, axis=1)
    assert lengths.max() / lengths.min() < 4
    found = graph.search(asked, options)
    assert np.mean([len(set(f.tolist()) & set(b.tolist())) / 20 for f, b in zip(found, best, strict=True)]) >= 0.95
