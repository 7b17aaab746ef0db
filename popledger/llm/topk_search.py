"""Exact top-k search by inner product with vector-approximation files.

Vectors become integers, floor(scale * component). A tile holds one block of queries and one block of vectors. For its vectors a
tile builds the approximation file: every dimension is cut into cells, a vector is kept as its cell numbers (one byte each). From the cells' bounds follow,
for all pairs of the tile, an upper and a lower bound of the score; vectors whose upper bound lies below the k-th largest lower
bound cannot be among the best. Exact vectors are then read in order of falling upper bounds until the k-th best score found is above the
next bound (equal bounds are read too, since ties go to the smaller id). Tiles return k rows per query, and these are merged.

Defined results: vectors that are null, or hold null, NaN or infinite components, take no part; a query and a vector of different
length are not compared; a query never meets a vector of its own id; ties go to the smaller id; with fewer vectors than k all are
returned; repeated ids are results each; an id that is null takes no part. Other columns are not read. Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from popledger.llm.common import prepare

QUERY_BLOCK = 512
VECTOR_BLOCK = 4096
CELLS = 256
#: Exact vectors read at first for a query; doubled until the result is certain.
FIRST_READ = 32


def integers(vectors: DataFrame, scale: int, key: str, vector: str) -> DataFrame:
    """id and integer components of the vectors that take part."""
    whole = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    fine = F.forall(F.col(vector), lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    return vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & fine).select(F.col(key).cast("bigint").alias("id"), whole.alias("v"))


class ApproximationFile:
    """Cell numbers of a block of vectors, and the bounds of the cells."""

    def __init__(self, vectors: np.ndarray):
        self.low = vectors.min(axis=0)
        self.width = np.maximum(1, -(-(vectors.max(axis=0) - self.low + 1) // CELLS))
        self.cells = ((vectors - self.low) // self.width).astype(np.uint8)

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of all scores (queries x vectors)."""
        floor = (self.low + self.cells * self.width).astype(np.float64)
        ceiling = floor + (self.width - 1)
        up, down = np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64)
        return up @ floor.T + down @ ceiling.T, up @ ceiling.T + down @ floor.T


def search(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query, id, score) of the k best vectors for each query; also counts, in ``search.read``, the exact vectors it has read."""
    out: list[tuple[int, int, int]] = []
    if not len(ids) or not len(query_ids):
        return out
    # bounds are exact in doubles while every product sum stays below 2**52
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(vectors.shape[1], 1)
    if largest < 2.0**50 and vectors.shape[1]:
        lower, upper = ApproximationFile(vectors).bounds(queries)
    else:
        lower = upper = None
    for row, own in enumerate(query_ids):
        if upper is None:
            chosen = np.flatnonzero(ids != own)
            score = (vectors[chosen] * queries[row]).sum(axis=1)
        else:
            high = np.where(ids == own, -np.inf, upper[row])
            low = np.where(ids == own, -np.inf, lower[row])
            floor = np.partition(low, len(low) - k)[len(low) - k] if len(low) > k else -np.inf
            candidates = np.flatnonzero((high >= floor) & (high > -np.inf))
            candidates = candidates[np.argsort(-high[candidates], kind="stable")]
            read, chosen, score = FIRST_READ, candidates[:0], np.zeros(0, np.int64)
            while len(chosen) < len(candidates):
                more = candidates[len(chosen) : read]
                score = np.r_[score, vectors[more] @ queries[row]]
                chosen = candidates[: len(chosen) + len(more)]
                if len(chosen) < len(candidates) and len(chosen) >= k and np.partition(score, len(score) - k)[len(score) - k] > high[candidates[len(chosen)]]:
                    break
                read *= 2
            search.read += len(chosen)
        best = np.lexsort([ids[chosen], -score])[:k]
        out += [(int(own), int(i), int(s)) for i, s in zip(ids[chosen[best]], score[best])]
    return out


search.read = 0


def matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    flat = column.combine_chunks()
    flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dims)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, id and score of the k best vectors of every query."""
    prepare(vectors.sparkSession)
    base, asked = integers(vectors, scale, key, vector), integers(queries, scale, key, vector)
    n_vectors, n_queries = base.count(), asked.count()
    vector_blocks, query_blocks = max(1, -(-n_vectors // VECTOR_BLOCK)), max(1, -(-n_queries // QUERY_BLOCK))
    dims = F.size("v").alias("dims")
    block = lambda n: F.pmod(F.xxhash64("id", "v"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.select("id", "v", dims, block(query_blocks).alias("qb"), every(vector_blocks).alias("vb"))
    right = base.select("id", "v", dims, block(vector_blocks).alias("vb"), every(query_blocks).alias("qb"))

    def tile(key, mine, theirs):
        found = []
        if mine.num_rows and theirs.num_rows:
            size = key[2].as_py()
            found = search(
                mine.column("id").to_numpy(), matrix(mine.column("v"), size), theirs.column("id").to_numpy(), matrix(theirs.column("v"), size), k
            )
        return pa.table([pa.array([x[i] for x in found], pa.int64()) for i in range(3)], names=["query_id", "id", "score"])

    tiles = left.groupBy("qb", "vb", "dims").cogroup(right.groupBy("qb", "vb", "dims"))
    found = tiles.applyInArrow(tile, "query_id bigint, id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
