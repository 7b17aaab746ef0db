import numpy as np
from pyspark.sql import functions as F

from popledger.llm import quality
from popledger.llm.registry import QUERIES


def test_trees_learn_and_the_flat_walk_agrees_with_a_plain_one():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.5)).astype(float)
    f = quality.fit_forest(x[:2000], y[:2000], trees=30)
    assert (((f.score(x[2000:]) >= 0.5) == y[2000:]).mean()) > 0.95

    def plain(row):
        odds = f.base
        for feature, threshold, leaf in zip(f.feature, f.threshold, f.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            odds += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-odds))

    assert np.allclose([plain(r) for r in x[:50]], f.score(x[:50]))


def test_held_out_accuracy(spark, small):
    path = small.replace("sf0.001", "sf0.01")
    got = QUERIES["op9_quality_classifier"](spark, path).join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert got["score"].between(0, 1).all()
    assert (got["predicted"] == got["quality"]).mean() >= 0.9
    assert got[got.quality == 1]["score"].mean() > got[got.quality == 0]["score"].mean() + 0.4


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "word " * 20_000, 1), (3, "x", 1)], "doc_id bigint, text string, y int")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r.score for r in quality.score(docs, quality.fit(docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (1, 0), (2, None), (99, 1), (3, 1)], "doc_id bigint, quality int")
    assert len({r.score for r in quality.score(docs, quality.fit(docs, one)).collect()}) == 1
    assert quality.score(docs.limit(0), quality.fit(docs.limit(0), one)).count() == 0


def test_held_out_rule(spark):
    import zlib

    got = spark.range(200).select("id", quality.is_held_out(F.col("id")).alias("h")).collect()
    assert [r.h for r in got] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in range(200)]
