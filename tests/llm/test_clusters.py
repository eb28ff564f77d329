"""Clustering against plain Lloyd rounds in Python's whole numbers."""

import hashlib
import math

import numpy as np
import pytest

from refinery.llm import clusters, queries


def plain(rows, k, rounds, dims, scale=256, seed="2"):
    points = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    centroids = [v for _, v in sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in points if i is not None)[:k]]
    if not centroids:
        return []

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v in points]

    for _ in range(rounds):
        by = {}
        for (_, j), (_, v) in zip(assign(), points):
            by.setdefault(j, []).append(v)
        centroids = [[sum(col) // len(by[j]) for col in zip(*by[j])] if j in by else c for j, c in enumerate(centroids)]
    done, per = assign(), {}
    for d, j in done:
        per[j] = per.get(j, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, j, d, per[j], sum(per.values()), sha[j]) for (i, _), (d, j) in zip(points, done)]


def frame(spark, rows):
    """With columns whose names clash with the operator's own."""
    return spark.createDataFrame([(i, v, 1, "x", 2.0) for i, v in rows], "vec_id long, embedding array<float>, cluster int, v string, distance double")


def some_rows(n, dims, seed=1):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(12, dims))
    rows = [(i, (centre[i % 12] + 0.3 * rng.normal(size=dims)).astype(np.float32).tolist()) for i in range(n)]
    odd = [(n, None), (n + 1, []), (n + 2, [0.5] * (dims - 1)), (n + 3, [0.5] * (dims + 1)), (n + 4, [None] + [0.5] * (dims - 1)), (n + 5, [float("nan")] * dims), (n + 6, [float("inf")] + [0.0] * (dims - 1)), (n + 7, [0.0] * dims), (None, rows[0][1]), (None, rows[1][1]), rows[4], rows[4], (n + 8, [1000.0] * dims)]
    return rows + odd


@pytest.mark.parametrize("n, k, rounds, dims", [(300, 20, 5, 8), (60, 40, 3, 64), (5, 40, 2, 4), (200, 1, 2, 3), (250, 9, 0, 5)])
def test_equals_plain(spark, n, k, rounds, dims):
    rows = some_rows(n, dims)
    got = clusters.cluster(frame(spark, rows).repartition(3), k, rounds, dims)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, plain(rows, k, rounds, dims)))


def test_ties_and_empty_clusters(spark):
    """Equal vectors start several centroids, of which the smaller number takes all and the others stay empty."""
    rows = [(i, [float(i % 2), 0.0]) for i in range(30)] + [(i, [0.5, 0.0]) for i in range(30, 36)]
    got = clusters.cluster(frame(spark, rows), 10, 4, 2)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, plain(rows, 10, 4, 2)))


@pytest.mark.parametrize("scale", [1, 100_000])
def test_bounds_never_lie(scale):
    """Many rounds of moving centroids: each vector's cluster and bounds against all distances; large numbers among them, whose products doubles do not hold."""
    rng = np.random.default_rng(3)
    x = rng.integers(-900, 900, (400, 6)) * scale
    history = [x[:21].copy()]
    state = clusters.Bounds.start(x, history[0])
    took = 0
    for step in range(12):
        # Back and forth, so that the total displacement is less than the sum of the steps.
        move = rng.integers(-60, 60, history[0].shape) * scale
        history.append(history[step // 2] + move if step % 3 else history[-1] - move)
        took += state.update(x, history)
        d = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, c)) for c in history[-1]] for p in x]
        assert state.cluster.tolist() == [row.index(min(row)) for row in d]
        moved = np.sqrt(np.stack([clusters.own_distances(history[-1], old) for old in history]).astype(float))
        for g in range(state.lower.shape[1]):
            others = [min((v for j, v in enumerate(row) if j // clusters.GROUP == g and j != c), default=math.inf) for row, c in zip(d, state.cluster)]
            loosened = state.lower[:, g] - np.array([moved[t, g * clusters.GROUP : (g + 1) * clusters.GROUP].max() for t in state.seen[:, g]])
            assert (loosened <= np.sqrt(np.array(others, float)) * (1 + 1e-9)).all()
    assert took < 12 * len(x) * 21


def test_few_distances_where_centroids_stay():
    """Well parted clusters whose centroids move little: bounds from the first round decide nearly all."""
    rng = np.random.default_rng(4)
    centre = rng.integers(-10_000, 10_000, (40, 64))
    x = centre[rng.integers(0, 40, 2000)] + rng.integers(-50, 50, (2000, 64))
    history = [centre.copy()]
    state = clusters.Bounds.start(x, centre)
    took = 0
    for _ in range(5):
        history.append(centre + rng.integers(-20, 20, centre.shape))
        took += state.update(x, history)
    assert took == 0


def test_too_large_is_an_error(spark):
    with pytest.raises(Exception, match="beyond"):
        clusters.cluster(frame(spark, [(1, [1e30, 0.0])]), 1, 1, 2).collect()


def test_no_rows(spark):
    empty = clusters.cluster(frame(spark, [(1, None)]), 3, 2, 4)
    assert empty.count() == 0 and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_query_equals_plain(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = queries.op11_ns_bounds_clustering(spark, sf)
    assert sorted(map(tuple, got.collect())) == sorted(plain(rows, 40, 5, 64))
