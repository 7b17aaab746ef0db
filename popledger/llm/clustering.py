"""Centroid clustering with the equal-average equal-variance search.

Vectors become integers, floor(scale * component). Centroids start as the vectors whose ids hash lowest, and move by exact rounded-down means.
The search sorts the centroids by their component sum. From a vector's own sum it scans outwards, the nearer side first. With
d components, sums S and deviations D = sqrt(d * sum(x^2) - S^2), the squared distance of two vectors is at least
((S1 - S2)^2 + (D1 - D2)^2) / d: once (S1 - S2)^2 exceeds d times the best distance the scan ends, and a centroid whose
deviation adds too much is passed over. Deviations are whole square roots, one less in the difference, so nothing near a tie is
lost; what is left is finished by the exact integer distance.

Every round is one pass: tasks add up the vectors of each centroid and give one row per centroid and component, so what is shuffled
and collected depends on the centroids (a parameter), not on the vectors.

Defined results: vectors that are null, have another number of components, or hold null, NaN or infinite components (also after
scaling) take no part; rows with a null id are assigned and averaged, but no centroid starts there; repeated ids are vectors each,
and each may start a centroid; with fewer vectors than centroids there are fewer centroids; empty centroids stay where they are and have no rows;
ties go to the smaller number. Arithmetic is exact for any size; a distance or sum beyond 64 bits is null. Other columns are not
read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from popledger.llm.common import prepare

#: Bits of one limb of a sum: sums travel as limbs and are exact at any size.
LIMB = 40
COUNT, DISTANCE = -1, -2
_ROOT = np.frompyfunc(math.isqrt, 1, 1)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def whole(x: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) as integers: 64-bit where the search cannot overflow, else unbounded."""
    y = np.floor(x * scale)
    # d * distance and d * d * component**2 stay below 2**62
    if not y.size or np.abs(y).max() < 2.0**30 / max(1, y.shape[1]):
        return y.astype(np.int64)
    return np.array([[int(v) for v in row] for row in y], dtype=object).reshape(y.shape)


def root(x: np.ndarray) -> np.ndarray:
    """Whole square roots, rounded down."""
    if x.dtype == object:
        return _ROOT(x)
    r = np.floor(np.sqrt(x.astype(np.float64))).astype(np.int64)
    r -= r * r > x
    return r + ((r + 1) * (r + 1) <= x)


class Search:
    """Centroids in the order of their sums."""

    def __init__(self, centroids: np.ndarray):
        self.d = centroids.shape[1]
        sums = centroids.sum(axis=1)
        self.number = np.argsort(sums, kind="stable")
        self.c, self.s = centroids[self.number], sums[self.number]
        self.deviation = root(self.d * (self.c * self.c).sum(axis=1) - self.s * self.s)
        self.exact = 0  # exact distances computed

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each vector's nearest centroid."""
        n, k, s = len(x), len(self.c), x.sum(axis=1)
        deviation = root(self.d * (x * x).sum(axis=1) - s * s)
        right = np.searchsorted(self.s, s)
        left = right - 1
        best, cluster = np.zeros(n, x.dtype), np.full(n, k)
        scan, first = np.arange(n), True
        while len(scan):
            a, b = left[scan], right[scan]
            below, above = s[scan] - self.s[np.maximum(a, 0)], self.s[np.minimum(b, k - 1)] - s[scan]
            rightward = (b < k) & ((a < 0) | (above <= below))
            at, gap = np.where(rightward, b, a), np.where(rightward, above, below)
            right[scan], left[scan] = b + rightward, a - ~rightward
            if not first:
                # the nearer side is too far: so is everything beyond
                near = (gap * gap <= self.d * best[scan]).astype(bool)
                scan, at, gap = scan[near], at[near], gap[near]
            apart = np.maximum(abs(deviation[scan] - self.deviation[at]) - 1, 0)
            close = np.ones(len(scan), bool) if first else (gap * gap + apart * apart <= self.d * best[scan]).astype(bool)
            rows, at = scan[close], at[close]
            away = x[rows] - self.c[at]
            distance, number = (away * away).sum(axis=1), self.number[at]
            self.exact += len(rows)
            better = np.ones(len(rows), bool) if first else ((distance < best[rows]) | ((distance == best[rows]) & (number < cluster[rows]))).astype(bool)
            best[rows[better]], cluster[rows[better]] = distance[better], number[better]
            first = False
            scan = scan[(left[scan] >= 0) | (right[scan] < k)]
        return cluster, best


def searched(batch: pa.RecordBatch, dims: int, scale: float, centroids: list[list[int]], made: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Integer vectors of a batch, their centroids' numbers and distances."""
    x = whole(matrix(batch.column(1), dims), scale)
    large = x.dtype == object or max(abs(v) for c in centroids for v in c) >= 2**30 // dims
    kind = object if large else np.int64
    if kind not in made:
        made[kind] = Search(np.array(centroids, dtype=kind).reshape(len(centroids), dims))
    return x, *made[kind].nearest(x.astype(kind))


def limbs(value: int) -> Iterator[tuple[int, int]]:
    sign, rest, at = (-1 if value < 0 else 1), abs(value), 0
    while rest:
        yield at, sign * (rest & ((1 << LIMB) - 1))
        rest, at = rest >> LIMB, at + 1


def sums(kept: DataFrame, dims: int, scale: float, centroids: list[list[int]]) -> dict[tuple[int, int], int]:
    """Component sums, count and distance sum of every centroid: (cluster, component) -> exact sum."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict = {}
        total = np.zeros((len(centroids), dims + 2), dtype=object)
        for batch in batches:
            if batch.num_rows:
                x, cluster, distance = searched(batch, dims, scale, centroids, made)
                for c in np.unique(cluster):
                    own = cluster == c
                    total[c] += np.array([*x[own].sum(axis=0).tolist(), int(own.sum()), int(distance[own].astype(object).sum())], dtype=object)
        rows = [(c, d if d < dims else dims - 1 - d, at, v) for c in range(len(centroids)) for d in range(dims + 2) for at, v in limbs(int(total[c, d]))]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
        yield pa.record_batch([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["cluster", "component", "limb", "v"])

    parts = kept.mapInArrow(add, "cluster int, component int, limb int, v bigint")
    out: dict[tuple[int, int], int] = {}
    for r in parts.groupBy("cluster", "component", "limb").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect():
        at = (r.cluster, r.component)
        out[at] = out.get(at, 0) + (int(r.v) << (LIMB * r.limb))
    return out


def fits(value: int) -> int | None:
    return value if value < 2**63 else None


def cluster(
    vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: float = 64.0, seed: int = 1, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid (components as text) and centroid_sha256 of every vector."""
    prepare(vectors.sparkSession)
    fine = F.forall(F.col(vector), lambda x: F.coalesce(F.abs(x.cast("double") * F.lit(float(scale))) < float("inf"), F.lit(False)) & ~F.isnan(x.cast("double")))
    kept = vectors.where(F.col(vector).isNotNull() & (F.size(F.col(vector)) == dims) & fine)
    kept = kept.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    first = kept.where("id is not null").select(digest.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    centroids = [[int(v) for v in row] for row in whole(np.array([r.v for r in first], np.float64).reshape(len(first), dims), scale)]
    schema = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid string, centroid_sha256 string"
    if not centroids:
        return vectors.sparkSession.createDataFrame([], schema)
    for _ in range(rounds):
        total = sums(kept, dims, scale, centroids)
        centroids = [[total.get((c, d), 0) // n for d in range(dims)] if (n := total.get((c, COUNT), 0)) else own for c, own in enumerate(centroids)]
    total = sums(kept, dims, scale, centroids)
    spread = [total.get((c, DISTANCE), 0) for c in range(len(centroids))]
    names = [",".join(map(str, c)) for c in centroids]
    facts = [(fits(s), fits(sum(spread)), name, hashlib.sha256(name.encode()).hexdigest()) for s, name in zip(spread, names)]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict = {}
        own = [pa.array([f[i] for f in facts], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string()))]
        for batch in batches:
            if batch.num_rows:
                _, number, distance = searched(batch, dims, scale, centroids, made)
                at = pa.array(number, pa.int32())
                far = pa.array([fits(int(v)) for v in distance] if distance.dtype == object else distance, pa.int64())
                yield pa.record_batch([batch.column(0), at, far, *[x.take(at) for x in own]], names=[x.split()[0] for x in schema.split(", ")])

    return kept.mapInArrow(assign, schema)
