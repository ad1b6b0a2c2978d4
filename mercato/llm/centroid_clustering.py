"""Exact integer k-means whose comparisons are filtered by the n-simplex projection.

Vectors are whole numbers: floor(scale * x). Some of the first centroids are the pivots. A vector's
distances to them are taken once; with the pivots' own they fix a simplex, whose apex (coordinates in
the pivots' space and an altitude above it) stands for the vector from then on and is kept beside it.
Two apexes bound the distance of their vectors: their Euclidean distance from below, the same with one
altitude turned over from above. In every round a centroid whose lower bound exceeds another one's upper
bound is out; what is left is compared exactly, in whole numbers, ties to the smaller number. Bounds are
widened by far more than floating point can err, so they never decide wrongly.

A round is one pass over the kept vectors: tasks give counts and sums by cluster, which are added before
the driver gets k sums of whole numbers and divides them exactly. The driver never holds more than that.

Defined cases: vectors of another size, or with a null or non-finite component, are left out; components
beyond +-``MOST`` count as that; fewer vectors than ``k`` make as many centroids; equal first vectors
stay separate centroids, the larger number empty; null ids hash as empty text and ties of the hash go by
the vector; repeated rows each get their row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import written

SIZE, SCALE, K, ROUNDS = 64, 1024, 8, 10
#: Whole components lie within this, so that squared distances and sums fit 64 bits.
MOST = 1 << 27
#: A pivot's altitude above those before it, against the largest distance; flatter simplices lose digits.
FLAT = 0.05
#: Bounds are widened by this share of the lengths they come from.
SLACK = 1e-5
ROWS = 8192


class Simplex:
    """The pivots' simplex: the first at the origin, each further one with a coordinate of its own."""

    def __init__(self, candidates: np.ndarray):
        pivots, base = [], np.zeros((0, 0))
        far = max((float(np.sqrt(squared(candidates, c).max())) for c in candidates), default=0.0)
        for c in candidates:
            if not pivots:
                pivots.append(c)
                continue
            at = self._apex(np.array(pivots), base, np.sqrt(squared(np.array(pivots), c).astype(np.float64))[None])[0]
            if at[-1] > FLAT * far:
                base = np.pad(base, ((0, 1), (0, 1)))
                base[-1] = at
                pivots.append(c)
        self.pivots, self.base = np.array(pivots), base

    @staticmethod
    def _apex(pivots: np.ndarray, base: np.ndarray, far: np.ndarray) -> np.ndarray:
        """Coordinates and altitude from the distances ``far`` (rows, pivots)."""
        out = np.zeros((len(far), len(pivots)))
        for k, edge in enumerate(base):
            own = edge[k]
            out[:, k] = ((far[:, 0] ** 2 - far[:, k + 1] ** 2 + (edge**2).sum()) / 2 - out[:, :k] @ edge[:k]) / own
        out[:, -1] = np.sqrt(np.maximum(far[:, 0] ** 2 - (out[:, :-1] ** 2).sum(axis=1), 0))
        return out

    def project(self, vectors: np.ndarray) -> np.ndarray:
        far = np.stack([np.sqrt(squared(vectors, p).astype(np.float64)) for p in self.pivots], axis=1)
        return self._apex(self.pivots, self.base, far)


def squared(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole vectors to a point."""
    apart = vectors.astype(np.int64) - point.astype(np.int64)
    return np.einsum("ij,ij->i", apart, apart)


def open_centroids(apexes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Which centroids (columns) the bounds leave open for which vectors (rows)."""
    flat = ((apexes[:, None, :-1] - centroids[None, :, :-1]) ** 2).sum(axis=2)
    a, c = apexes[:, None, -1], centroids[None, :, -1]
    lower, upper = np.sqrt(flat + (a - c) ** 2), np.sqrt(flat + (a + c) ** 2)
    slack = SLACK * (1 + np.linalg.norm(apexes, axis=1)[:, None] + np.linalg.norm(centroids, axis=1)[None])
    return lower - slack <= (upper + slack).min(axis=1, keepdims=True)


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, simplex: Simplex, measured: bool) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's nearest centroid, and its squared distance where ``measured`` or several were open."""
    left = open_centroids(apexes, simplex.project(centroids))
    several = left.sum(axis=1) > 1
    best, least = left.argmax(axis=1), np.full(len(vectors), np.iinfo(np.int64).max)
    for number, centroid in enumerate(centroids):
        rows = np.flatnonzero(left[:, number] & (several | measured))
        far = squared(vectors[rows], centroid)
        closer = far < least[rows]
        best[rows[closer]], least[rows[closer]] = number, far[closer]
    return best, least


def usable(embedding: Column, size: int) -> Column:
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embedding.isNotNull() & (F.size(embedding) == size) & ~bad


def whole(embedding: Column, scale: int) -> Column:
    part = lambda x: F.greatest(F.least(F.floor(F.least(F.greatest(x * scale, F.lit(-1e12)), F.lit(1e12))), F.lit(MOST)), F.lit(-MOST))
    return F.transform(embedding, lambda x: part(x.cast("double")).cast("int"))


def _matrix(column: pa.Array, kind) -> np.ndarray:
    flat = np.asarray(column.flatten()).astype(kind, copy=False)
    return flat.reshape(len(column), -1)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _projected(simplex: Simplex):
    def run(batches):
        for b in _pieces(batches):
            apexes = simplex.project(_matrix(b.column(1), np.int64))
            lists = pa.ListArray.from_arrays(np.arange(0, apexes.size + 1, apexes.shape[1], dtype=np.int32), apexes.ravel())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists], names=["vec_id", "parts", "apex"])

    return run


def _sums(centroids: np.ndarray, simplex: Simplex):
    """Counts and sums of the components by cluster, one row a cluster and task."""

    def run(batches):
        count, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for b in _pieces(batches):
            vectors = _matrix(b.column(1), np.int64)
            best, _ = nearest(vectors, _matrix(b.column(2), np.float64), centroids, simplex, measured=False)
            for k in np.unique(best).tolist():
                count[k] += (best == k).sum()
                total[k] += vectors[best == k].sum(axis=0)
        some = np.flatnonzero(count)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([[int(count[k]), *total[k].tolist()] for k in some], pa.list_(pa.int64()))], names=["cluster", "sums"])

    return run


def _assigned(centroids: np.ndarray, simplex: Simplex):
    def run(batches):
        for b in _pieces(batches):
            best, least = nearest(_matrix(b.column(1), np.int64), _matrix(b.column(2), np.float64), centroids, simplex, measured=True)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(best, pa.int32()), pa.array(least, pa.int64())], names=["vec_id", "cluster", "distance"])

    return run


def first_vectors(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest hash of seed and id, in that order. ``vectors``: vec_id, parts."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = vectors.select(order.alias("hash"), "parts").orderBy("hash", "parts").limit(k).collect()
    return np.array([r["parts"] for r in rows], np.int64)


def cluster(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = K, rounds: int = ROUNDS,
            size: int = SIZE, scale: int = SCALE, seed: int = 3) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256 of every usable vector."""
    kept = vectors.filter(usable(F.col(embedding), size)).select(F.col(vec_id).cast("long").alias("vec_id"), whole(F.col(embedding), scale).alias("parts"))
    centroids = first_vectors(kept, k, seed)
    if not len(centroids):
        return kept.selectExpr("vec_id", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256").limit(0)
    simplex = Simplex(centroids)
    held = written(kept.mapInArrow(_projected(simplex), "vec_id long, parts array<int>, apex array<double>"), "vectors")
    for _ in range(rounds):
        sums = held.mapInArrow(_sums(centroids, simplex), "cluster int, sums array<long>")
        every = sums.select("cluster", F.posexplode("sums").alias("at", "part")).groupBy("cluster", "at").agg(F.sum("part").alias("part"))
        parts = {(r["cluster"], r["at"]): r["part"] for r in every.collect()}  # k * (size + 1) numbers
        moved = centroids.copy()
        for c in {c for c, _ in parts}:
            moved[c] = [parts[c, d + 1] // parts[c, 0] for d in range(size)]
        if (moved == centroids).all():
            break  # every further round would repeat this one
        centroids = moved
    found = written(held.mapInArrow(_assigned(centroids, simplex), "vec_id long, cluster int, distance long"), "clusters")
    inertia = {r["cluster"]: r["inertia"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    by_cluster = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("cluster") + 1)
    own = by_cluster([inertia.get(c, 0) for c in range(len(centroids))]).cast("long")
    names = by_cluster([hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()])
    return found.select("vec_id", "cluster", "distance", own.alias("cluster_inertia"), F.lit(sum(inertia.values())).cast("long").alias("inertia"), names.alias("centroid_sha256"))
