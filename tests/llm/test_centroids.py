import hashlib
import math

import numpy as np
import pytest
from pyspark.errors import PySparkException

from sensorloom.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int, v string, cluster string, head int, rest int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y", 2, 3) for i, v in rows], SCHEMA)


def plain(rows, k, rounds, dim, seed=2):
    """Clusters, distances and centroids by comparing every pair, in Python integers."""
    kept = []
    for i, v in rows:
        if v is None or len(v) != dim or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    key = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centres = [v for _, v in sorted(kept, key=key)[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    assign = lambda: [min((far(v, c), n) for n, c in enumerate(centres)) for _, v in kept]
    for _ in range(rounds):
        of = assign()
        for n in range(len(centres)):
            mine = [v for (_, v), (_, c) in zip(kept, of) if c == n]
            if mine:
                centres[n] = [sum(x) // len(mine) for x in zip(*mine)]
    return sorted((str(i), c, d) for (i, _), (d, c) in zip(kept, assign())), centres


def check(spark, rows, k, rounds, dim, leading=3):
    found, centres = centroids.cluster(frame(spark, rows).repartition(3), k=k, rounds=rounds, dim=dim, leading=leading)
    want, want_centres = plain(rows, k, rounds, dim)
    assert sorted((str(r.vec_id), r.cluster, r.distance) for r in found.collect()) == want
    assert centres.tolist() == want_centres


@pytest.mark.parametrize("leading", [1, 3, 8, 50])
def test_equals_all_pairs(spark, leading):
    rng = np.random.default_rng(leading)
    middles = rng.normal(size=(5, 8))
    rows = [(i, (middles[i % 5] + rng.normal(size=8) / 3).tolist()) for i in range(300)]
    check(spark, rows, 9, 4, 8, leading)


def test_ties_repeats_and_a_hot_vector(spark):
    grid = [(i, [float(i % 2), float(i // 2 % 2), 0.0]) for i in range(60)]
    copies = [(100 + i, [0.5, 0.5, 0.5]) for i in range(200)]
    check(spark, grid + copies + grid[:5], 7, 3, 3)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(None, [0.1, 0.2]), (None, [0.3, 0.2]), (1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 0.0]), (7, [-inf, 0.0]), (8, [-0.001, 0.001]), (9, [1.0, 2.0, 3.0]), (10, [-1.0, 4.0])]
    check(spark, odd, 40, 5, 2)


def test_large_components(spark):
    rng = np.random.default_rng(1)
    check(spark, [(i, (rng.normal(size=4) * 1e5).tolist()) for i in range(80)], 6, 3, 4, 2)
    with pytest.raises(PySparkException, match="beyond"):
        centroids.cluster(frame(spark, [(1, [1e30, 0.0]), (2, [0.0, 0.0])]), k=2, dim=2)


def test_empty_tables(spark):
    for rows in ([], [(1, None), (2, [0.5])]):
        found = centroids.with_inertia(*centroids.cluster(frame(spark, rows), k=3, dim=2))
        assert found.collect() == []
        assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_inertia(spark):
    rows = [(i, [i / 7, -i / 3]) for i in range(40)]
    found = centroids.with_inertia(*centroids.cluster(frame(spark, rows), k=4, dim=2, rounds=2)).collect()
    want, centres = plain(rows, 4, 2, 2)
    for r in found:
        assert r.inertia == sum(d for _, _, d in want)
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centres[r.cluster])).encode()).hexdigest()


def test_filter_skips_most_pairs():
    rng = np.random.default_rng(0)
    middles = rng.normal(size=(40, 64)) * 40
    v = np.floor(middles[rng.integers(0, 40, 2000)] + rng.normal(size=(2000, 64)) * 10).astype(np.int64)
    centred = v - v.mean(0)
    _, axes = np.linalg.eigh(centred.T @ centred)
    rotation = centroids.Rotation(v.mean(0), axes[:, ::-1].copy(), 12)
    centres = np.floor(middles).astype(np.int64)
    best, distance, compared = centroids.nearest(v, *rotation.turn(v.astype(float)), centres, rotation)
    full = ((v[:, None] - centres[None]) ** 2).sum(2)
    assert (best == full.argmin(1)).all() and (distance == full.min(1)).all()
    assert compared < 0.2 * full.size
