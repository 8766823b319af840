"""Nearest neighbours in clustered vectors: every graph is connected, and no query ends in the wrong cluster."""

import numpy as np
import pytest

from rasterloom.llm import ann


def clustered(size, rows=4000, spread=0.1, free=True, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(rows // size, 64))
    if free:
        centres *= rng.lognormal(0, 0.2, size=(len(centres), 1))
    points = np.repeat(centres, size, axis=0) + spread * rng.normal(size=(len(centres) * size, 64))
    return rng.permutation(points if free else points / np.linalg.norm(points, axis=1, keepdims=True))


def recall(vectors, found, queries, k=20):
    scores = vectors[queries] @ vectors.T
    scores[np.arange(len(queries)), queries] = -np.inf
    best = np.argsort(-scores, axis=1)[:, :k]
    hits = []
    for i, own in enumerate(found):
        own = [j for j in own if j >= 0 and j != queries[i]]
        hits.append(len(set(sorted(own, key=lambda j: -scores[i, j])[:k]) & set(best[i].tolist())))
    return np.array(hits) / k


@pytest.mark.parametrize("size", [10, 25, 50, 100, 200, 500, 1000])
@pytest.mark.parametrize("free", [True, False])
def test_recall_in_clusters_of_every_size(size, free):
    vectors, options = clustered(size, free=free), ann.GraphOptions()
    queries = np.arange(0, len(vectors), 20)
    found = recall(vectors, ann.Graph.build(vectors, options).search(vectors[queries], options), queries)
    assert found.mean() >= 0.9 and (found == 0).sum() == 0


@pytest.mark.parametrize("size", [1, 40, 1300])
def test_every_layer_is_connected(size):
    graph = ann.Graph.build(clustered(size, rows=2600, spread=0.001), ann.GraphOptions())
    for members, links in graph.layers:
        where = {m: i for i, m in enumerate(members.tolist())}
        seen, queue = {int(members[0])}, [int(members[0])]
        while queue:
            for other in links[where[queue.pop()]].tolist():
                if other >= 0 and other not in seen:
                    seen.add(other)
                    queue.append(other)
        assert seen == set(where)


def test_clusters_through_spark(spark):
    vectors = clustered(100, seed=3)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    got = {}
    for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    queries = np.arange(0, len(vectors), 20)
    found = recall(vectors, [got[q] for q in queries.tolist()], queries)
    assert found.mean() >= 0.9 and (found == 0).sum() == 0
