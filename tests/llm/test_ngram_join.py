import random

import numpy as np
import pytest

from popledger.llm import ngram_join
from popledger.llm.components import components
from popledger.llm.registry import QUERIES
from tests.llm.brute import LOWER, SPACE_WORD


def brute(docs, n=3, percent=90):
    sets = {}
    for d, t in docs:
        w = SPACE_WORD.findall((t or "").translate(LOWER))
        sets[d] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    up = {d: d for d in sets}

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 10 * min(len(x), len(y)) >= percent / 10 * max(len(x), len(y)) and 100 * len(x & y) >= percent * len(x | y):
                p, q = root(a), root(b)
                up[max(p, q)] = min(p, q)
    return {d: (len(sets[d]), root(d)) for d in sets}


def run(spark, docs, **settings):
    rows = spark.createDataFrame([(d, t, 1, "f") for d, t in docs], "doc_id bigint, text string, node int, family string")
    return {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(rows, **settings).collect()}


def families(seed, many=6, copies=14, size=(5, 250)):
    rng = random.Random(seed)
    docs = []
    for _ in range(many):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(*size))]
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randrange(0, max(2, len(w) // 20))):
                w[rng.randrange(len(w))] = f"x{rng.randrange(50)}"
            docs.append((len(docs) * 7 % 1009, " ".join(w)))
    return docs


ODD = [(2000, None), (2001, ""), (2002, " \n "), (2003, "One two"), (2004, "one TWO"), (2005, "one"), (2006, "a b c"), (2007, "A\tB\x0bc"), (-5, "one two"), (2008, "long " * 30_000)]


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_families(spark, n, percent):
    docs = families(n) + ODD
    want = brute(docs, n, percent)
    assert run(spark, docs, n=n, percent=percent) == want
    assert 5 < len({c for _, c in want.values()}) < len(want) - 10


def test_large_family_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    docs = families(11, many=1, copies=150, size=(200, 220)) + families(12, many=2, copies=40, size=(60, 70))
    docs = [(i, t) for i, (_, t) in enumerate(docs)]
    assert run(spark, docs) == brute(docs)


def test_query(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op1_ngram_jaccard_join"](spark, small).collect()}
    assert got == brute(docs)


def test_linked_sets_share_a_needed_slice():
    rng = np.random.default_rng(2)
    for percent in (80, 90):
        for size in (10, 12, 20, 37, 150, 800):
            for _ in range(30):
                a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
                b = a.copy()
                while True:
                    c = np.unique(np.append(np.delete(b, rng.integers(len(b))), rng.integers(0, 2**64, rng.integers(0, 3), dtype=np.uint64)))
                    if not len(c) or 100 * len(np.intersect1d(a, c)) < percent * len(np.union1d(a, c)):
                        break
                    b = c
                if len(np.setxor1d(a, b)):
                    # the keys left when each set does without its spare ones, in an order by any count
                    order = lambda k: (int(k) * 0x9E3779B97F4A7C15 % 2**64) >> 60
                    keep = lambda s: {k for keys, spare in ngram_join.slices(s, percent) for k in sorted(keys.tolist(), key=lambda k: (order(k), k))[: len(keys) - spare]}
                    assert keep(a) & keep(b)


@pytest.mark.parametrize("common", [2, 64])
def test_common_passages_make_no_families(spark, monkeypatch, common):
    monkeypatch.setattr(ngram_join, "COMMON", common)
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(90)]
    docs = [(i, " ".join([*(f"u{i}_{j}" for j in range(100)), *passage])) for i in range(150)]
    texts = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert ngram_join.family_edges(texts, 5, 80).count() == 0
    # near copies among them, and texts that are little but the passage
    docs += [(1000 + i, docs[i][1].replace(f"u{i}_50", "other")) for i in range(0, 150, 7)]
    docs += [(2000 + i, " ".join([*passage, *(f"v{rng.randrange(30)}" for _ in range(i % 40))])) for i in range(80)] + [(None, docs[0][1]), (None, "alone")]
    want = brute([d for d in docs if d[0] is not None], 5, 80)
    rows = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = ngram_join.join(rows, n=5, percent=80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found if r.doc_id is not None} == want
    assert sorted((r.component_id for r in found if r.doc_id is None), key=str) == [0, None]


def test_one_id_with_two_texts(spark):
    base = [f"w{i}" for i in range(60)]
    a, b = " ".join(base), " ".join([*base[:59], "x"])
    rows = [(5, a), (5, "quite another text of some words"), (9, b)]
    for order in ([0, 1, 2], [2, 1, 0], [1, 0, 2]):
        found = ngram_join.join(spark.createDataFrame([rows[i] for i in order], "doc_id bigint, text string"), n=3, percent=90).collect()
        assert sorted((r.doc_id, r.component_id) for r in found) == [(5, 5), (5, 5), (9, 5)]


def test_empty_table_and_repeated_ids(spark):
    assert run(spark, []) == {}
    got = run(spark, [(1, "a b c d"), (1, "a b c d"), (2, "a b c d")])
    assert got == {1: (2, 1), 2: (2, 1)}


def test_components_of_a_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 300)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(300)}}
