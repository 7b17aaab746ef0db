import hashlib
import math

import duckdb
import numpy as np

from popledger.llm import clustering
from popledger.llm.registry import ORACLES, QUERIES


def brute(rows, k=16, rounds=3, dims=64, scale=64):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    starts = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    c = [v for _, v in starts]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(c)) for _, v in kept]

    for _ in range(rounds if c else 0):
        at = assign()
        for j in range(len(c)):
            own = [v for (_, v), (_, a) in zip(kept, at) if a == j]
            c[j] = [sum(x) // len(own) for x in zip(*own)] if own else c[j]
    at = assign() if c else []
    spread = [sum(d for d, a in at if a == j) for j in range(len(c))]
    long = lambda x: x if x < 2**63 else None
    names = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    return sorted(((i, a, long(d), long(spread[a]), long(sum(spread)), names[a]) for (i, _), (d, a) in zip(kept, at)), key=repr)


def run(spark, rows, kind="float", **settings):
    df = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], f"vec_id bigint, embedding array<{kind}>, cluster int, distance double")
    found = clustering.cluster(df, **settings).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_query_equals_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{small}/embeddings.parquet'")
    df = QUERIES["op13_centroid_clustering"](spark, small)
    rel = con.sql(ORACLES["op13_centroid_clustering"])
    assert df.columns == rel.columns
    got = sorted(tuple(r) for r in df.collect())
    assert got == sorted(rel.fetchall())
    assert len({r[1] for r in got}) > 1


def test_odd_vectors(spark):
    rng = np.random.default_rng(2)
    vector = lambda: [float(np.float32(x)) for x in rng.normal(size=6)]
    rows = [(i, vector()) for i in range(200)]
    rows += [(300 + i, rows[0][1]) for i in range(90)] + [(5, rows[7][1]), (5, rows[5][1]), (None, vector()), (None, vector())]
    rows += [(400, None), (401, []), (402, [1.0] * 5), (403, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (404, [float("nan")] * 6), (405, [float("-inf")] * 6), (406, [0.0] * 6)]
    settings = {"k": 7, "dims": 6}
    assert run(spark, rows, **settings) == brute(rows, **settings)
    assert run(spark, rows, rounds=0, **settings) == brute(rows, rounds=0, **settings)
    # components that 64-bit sums cannot hold
    large = [(500, [3e38] * 6), (501, [-3e38, 1.0, 1.0, 1.0, 1.0, 1.0]), (502, [1e12] * 6), (503, [1e8, -1e8, 1.0, 2.0, 3.0, 4.0])]
    large = [(i, [float(np.float32(x)) for x in v]) for i, v in large]
    assert run(spark, rows + large, **settings) == brute(rows + large, **settings)


def test_few_vectors_and_empty_tables(spark):
    assert run(spark, []) == []
    rows = [(1, [0.5] * 64), (2, [0.25] * 64)]
    assert run(spark, rows) == brute(rows) and len(run(spark, rows)) == 2
    assert run(spark, [(None, [0.5] * 64)]) == []
    # all alike: every centroid but the first stays empty
    rows = [(i, [1.0, 1.0]) for i in range(40)]
    assert run(spark, rows, k=4, dims=2) == brute(rows, k=4, dims=2)
    wide = [(1, [1.7e308, 1.0]), (2, [1.0, 2.0]), (3, [5.0, 2.0])]  # not finite once scaled
    assert [r[0] for r in run(spark, wide, kind="double", k=1, dims=2)] == [2, 3]


def test_search_is_exact_and_skips_centroids():
    rng = np.random.default_rng(5)
    centroids = rng.integers(-200, 200, (64, 16)) + rng.integers(-300, 300, (64, 1))
    x = centroids[rng.integers(0, 64, 3000)] + rng.integers(-20, 20, (3000, 16))
    search = clustering.Search(centroids)
    cluster, distance = search.nearest(x)
    every = ((x[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (cluster == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert search.exact < 3000 * 64 / 8
    other = clustering.Search(centroids.astype(object)).nearest(x[:50].astype(object))
    assert (other[0] == cluster[:50]).all() and (other[1] == distance[:50]).all()


def test_roots():
    x = np.array([0, 1, 2, 3, 4, 2**52 - 1, 2**60 - 1, 2**60, (2**30 + 1) ** 2 - 1], np.int64)
    assert clustering.root(x).tolist() == [math.isqrt(int(v)) for v in x] == clustering.root(x.astype(object)).tolist()
