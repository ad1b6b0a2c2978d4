"""Clustering against plain integer k-means; the bounds of the projection."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm.centroid_clustering import MOST, Simplex, cluster, open_centroids, squared

DDL = "vec_id long, embedding array<float>"


def plain(rows, k=8, rounds=10, size=64, scale=1024, seed=3):
    kept = []
    for i, x in rows:
        if x is not None and len(x) == size and all(v is not None and math.isfinite(v) for v in x):
            x = [float(np.float32(v)) for v in x]
            kept.append((i, [max(-MOST, min(MOST, math.floor(scale * v))) for v in x]))
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [r[1] for r in order[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    assign = lambda: [min((far(v, c), n) for n, c in enumerate(centroids)) for _, v in kept]
    for _ in range(rounds):
        best = assign()
        for n in range(len(centroids)):
            mine = [v for (_, v), (_, c) in zip(kept, best, strict=True) if c == n]
            if mine:
                centroids[n] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    best = assign()
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, n, d, sum(e for e, m in best if m == n), sum(e for e, _ in best), names[n]) for (i, _), (d, n) in zip(kept, best, strict=True)]


def key(row):
    return (row[0] is not None, row[0] or 0, row[1:])


def check(spark, rows, **more):
    got = [tuple(r) for r in cluster(spark.createDataFrame(rows, DDL).repartition(3), **more).collect()]
    assert sorted(got, key=key) == sorted(plain(rows, **more), key=key)
    return got


@pytest.mark.parametrize("spread", [0.05, 1.0, 300.0])
def test_matches_plain_clustering(spark, spread):
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(12, 64))
    rows = [(i, (middles[i % 12] + spread * rng.normal(size=64)).tolist()) for i in range(400)]
    check(spark, rows)


def test_odd_vectors(spark):
    rng = np.random.default_rng(6)
    good = [(i, rng.normal(size=4).tolist()) for i in range(30)]
    bad = [(50, None), (51, []), (52, [1.0, 2.0, 3.0]), (53, [1.0, None, 0.0, 0.0]), (54, [math.nan, 0.0, 0.0, 0.0]), (55, [math.inf, 0.0, 0.0, 0.0]), (56, [1.0] * 5)]
    same = [(60, [0.5] * 4)] * 40 + [(i, [0.5] * 4) for i in range(61, 90)]
    huge = [(None, [3e38, -3e38, 0.0, 1.0]), (None, [-0.0005] * 4), (None, [1e6, 0.0, 0.0, 0.0])]
    got = check(spark, good + bad + same + huge, k=5, rounds=6, size=4)
    assert not {r[0] for r in got} & {r[0] for r in bad}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.0] * 64)], [(i, [0.25] * 64) for i in range(20)], [(i, [i / 7] * 64) for i in range(6)]])
def test_few_or_equal_vectors(spark, rows):
    check(spark, rows)


def test_other_columns_are_ignored(spark):
    rows = [(i, [float(i % 3), float(i)]) for i in range(20)]
    wide = spark.createDataFrame(rows, DDL).withColumns({c: F.lit("x") for c in ("parts", "apex", "cluster", "distance", "hash", "sums", "at")})
    assert sorted(map(tuple, cluster(wide, k=3, size=2).collect())) == sorted(plain(rows, k=3, size=2))


def test_bounds_hold_and_exclude():
    """No bound contradicts an exact distance; most centroids are out before exact comparison."""
    rng = np.random.default_rng(7)
    middles = rng.integers(-3000, 3000, (8, 64))
    vectors = np.concatenate([m + rng.integers(-300, 300, (200, 64)) for m in middles])
    simplex = Simplex(vectors[::200])
    assert len(simplex.pivots) == 8
    a, c = simplex.project(vectors), simplex.project(middles)
    exact = np.sqrt(np.stack([squared(vectors, m) for m in middles], axis=1))
    flat = ((a[:, None, :-1] - c[None, :, :-1]) ** 2).sum(axis=2)
    assert (np.sqrt(flat + (a[:, None, -1] - c[None, :, -1]) ** 2) <= exact + 1e-6).all()
    assert (np.sqrt(flat + (a[:, None, -1] + c[None, :, -1]) ** 2) >= exact - 1e-6).all()
    left = open_centroids(a, c)
    assert left[np.arange(len(left)), exact.argmin(axis=1)].all() and left.sum() < 1.5 * len(left)


def test_flat_pivots_are_left_out():
    points = np.array([[0, 0, 0], [9, 0, 0], [9, 0, 0], [5, 0, 0], [0, 9, 0]])
    assert Simplex(points).pivots.tolist() == [[0, 0, 0], [9, 0, 0], [0, 9, 0]]
    assert len(Simplex(points[1:3]).pivots) == 1
