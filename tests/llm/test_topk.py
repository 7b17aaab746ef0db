import math

import duckdb
import numpy as np
from pyspark.sql import functions as F

from popledger.llm import topk_search
from popledger.llm.registry import ORACLES, QUERIES


def brute(rows, k=5, scale=256):
    ok = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % 50 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q and len(a) == len(b))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def run(spark, rows, **settings):
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in rows], "vec_id bigint, embedding array<float>, v int, dims int")
    found = topk_search.top_k(df, df.where("vec_id % 50 = 0"), **settings)
    return sorted((r.query_id, r["rank"], r.id, r.score) for r in found.collect())


def test_query_equals_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{small}/embeddings.parquet'")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in QUERIES["op2_exact_topk"](spark, small).collect())
    assert got == sorted(con.execute(ORACLES["op2_exact_topk"]).fetchall())
    assert got


def test_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "VECTOR_BLOCK", 40)
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6)]) for i in range(160)]
    rows += [(200 + i, rows[0][1]) for i in range(60)] + [(300, None), (350, []), (351, []), (400, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (450, [float("nan")] * 6), (451, [float("inf")] * 6)]
    rows += [(500, [1.0, 2.0]), (501, [3.0, 4.0]), (550, [0.0] * 6), (-50, [-1.0] * 6), (None, [1.0] * 6), (601, [1e4] * 6), (600, [2e5] * 6)]
    assert run(spark, rows) == brute(rows)


def test_few_vectors_and_empty_tables(spark):
    assert run(spark, [(0, [1.0, 1.0]), (1, [1.0, 0.5])]) == [(0, 1, 1, 256 * 256 + 256 * 128)]
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []


def test_few_exact_vectors_are_read():
    rng = np.random.default_rng(3)
    v = np.floor(256 * rng.normal(size=(4000, 16))).astype(np.int64)
    topk_search.search.read = 0
    topk_search.search(np.arange(20), v[:20], np.arange(4000), v, 5)
    assert topk_search.search.read < 20 * 4000 / 20
