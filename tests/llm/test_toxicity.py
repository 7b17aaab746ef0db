import itertools

import numpy as np

from popledger.llm import toxicity
from popledger.llm.registry import QUERIES


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(4)
    chain = toxicity.Chain(rng.normal(size=toxicity.FEATURES), rng.normal(size=(2, 2)))
    word_at = np.array([0, 5, 5, 6, 13])
    seen = rng.integers(0, toxicity.FEATURES, (13, 4))
    got = chain.marginals(seen, word_at)[0]
    for a, b in zip(word_at, word_at[1:]):
        total, toxic = 0.0, np.zeros(b - a)
        for states in itertools.product((0, 1), repeat=b - a):
            odds = sum(chain.weight[seen[a + i]].sum() for i, s in enumerate(states) if s) + sum(chain.move[x, y] for x, y in zip(states, states[1:]))
            total += np.exp(odds)
            toxic += np.exp(odds) * np.array(states)
        if b > a:
            assert np.allclose(got[a:b], toxic / total)


def test_fit_raises_the_likelihood_of_clear_labels():
    rng = np.random.default_rng(5)
    odds = np.where(rng.random(4000) < 0.02, 6.5, 0.0)
    word_at = np.arange(0, 4001, 50)
    seen = toxicity.observe(odds, rng.integers(1, 9, 4000), word_at).astype(np.int64)
    toxic = (odds > 0).astype(np.int64)
    p = toxicity.Chain.fit(seen, word_at, toxic).marginals(seen, word_at)[0]
    assert p[toxic == 1].min() > 0.9 and p[toxic == 0].max() < 0.1


def test_held_out_documents(spark, small):
    path = small.replace("sf0.001", "sf0.01")
    got = QUERIES["op4_toxicity"](spark, path).join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert got["score"].between(0, 1).all()
    assert (got["predicted"] == got["toxic"]).mean() >= 0.9


def test_spans_and_odd_rows(spark):
    docs = [(i, f"fine words {'scum ' if i % 3 == 0 else ''}here number{i} and more of them") for i in range(120)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(120)] + [(5, None), (999, 1)], "doc_id bigint, toxic int")
    rows = spark.createDataFrame([(d, t, 0) for d, t in docs], "doc_id bigint, text string, y int")
    model = toxicity.fit(rows, labels)
    extra = [(1000, None, 1), (1001, "", 1), (1002, "?! ..", 1), (1003, "Scum! " + "word " * 30_000, 1), (1004, "word " * 30_000, 1), (1004, "é SCUM", 1)]
    got = toxicity.score(spark.createDataFrame(extra, "doc_id bigint, text string, y int"), model).collect()
    by = {(r.doc_id, bool(r.span_start)): r for r in got}
    assert len(got) == 6 and [by[i, False].score for i in (1000, 1001, 1002)] == [0, 0, 0]
    assert by[1003, True].score > 0.5 and (by[1003, True].span_start, by[1003, True].span_end) == ([0], [4])
    assert by[1004, False].score < 0.1 and by[1004, True].span_start == [3]
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r.score for r in toxicity.score(rows, toxicity.fit(rows, none)).collect()} == {0.0}
    assert toxicity.score(rows.limit(0), model).count() == 0


def test_many_rare_toxic_words(spark):
    """Half the documents are toxic, each by one of 200 words: no word alone is evidence."""
    rng = np.random.default_rng(6)
    plain = [f"plain{i}" for i in range(400)]
    docs = []
    for i in range(4000):
        words = rng.choice(plain, 30).tolist()
        if i % 2:
            words.insert(int(rng.integers(30)), f"vile{(i // 2) % 200:03d}x")
        docs.append((i, " ".join(words)))
    # beginnings are shared by all toxic words here, so the words are told apart by their ends alone
    docs = [(i, t.replace("vile", "") if i % 2 else t) for i, t in docs]
    rows = spark.createDataFrame(docs, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(4000)], "doc_id bigint, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score(rows, toxicity.fit(rows, labels)).collect()}
    assert np.mean([got[i] >= 0.5 for i in range(1, 4000, 2)]) >= 0.9
    assert np.mean([got[i] < 0.5 for i in range(0, 4000, 2)]) >= 0.99


def test_nothing_tells_them_apart(spark, caplog):
    rows = spark.createDataFrame([(i, "the same words") for i in range(60)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, toxic int")
    model = toxicity.fit(rows, labels)
    assert "no word" in caplog.text and {r.score for r in toxicity.score(rows, model).collect()} == {0.0}
