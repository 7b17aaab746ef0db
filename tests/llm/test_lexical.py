import math
import re
from collections import Counter

import duckdb
import numpy as np

from popledger.llm import lexical_search
from popledger.llm.registry import ORACLES, QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    held = [(d, Counter(w), len(w)) for d, t in docs if (w := terms(t))]
    n, total, df = len(held), sum(x[2] for x in held), Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c, size in held:
            m = 25 + 75 * size * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if c[t])
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def run(spark, docs, items, **settings):
    d = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in docs], "doc_id bigint, text string, class string, score int, rank int")
    q = spark.createDataFrame([(i, t, "y", 3) for i, t in items], "item_id bigint, text string, terms string, doc_id int")
    found = lexical_search.search(d, q, **settings)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


def corpus(n=120, words=60, seed=4):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["Äpfel", "naïve", "日本"]
    weights = 1 / np.arange(1, len(vocabulary) + 1)
    draw = lambda size: " ".join(rng.choice(vocabulary, size, p=weights / weights.sum()))
    return [(i, draw(int(rng.integers(1, 80)))) for i in range(n)], [(i, draw(12)) for i in range(30)]


def test_query_equals_sql(spark, small):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{small}/{t}.parquet'")
    got = sorted(tuple(r) for r in QUERIES["op11_ranked_search"](spark, small).collect())
    assert got == sorted(con.execute(ORACLES["op11_ranked_search"]).fetchall())
    assert got


def test_odd_rows(spark, monkeypatch):
    docs, items = corpus()
    docs += [(500, None), (501, ""), (502, "  \n!"), (None, docs[0][1]), (None, "w1 w2"), (7, "w3, W3; w3"), (7, "w3 W3 w3")]
    docs += [(600 + i, "w1 w1 w2 copy") for i in range(40)] + [(700, "w1 " * 5000 + "rare\x00w2"), (701, "ÄPFEL äpfel Äpfel")]
    items += [(40, None), (41, ""), (42, "-- ::"), (None, "w1 rare"), (None, "w1 rare"), (3, "copy Copy COPY w1"), (3, items[0][1]), (43, "absent"), (44, "absent w2 Äpfel")]
    want = brute(docs, items)
    assert run(spark, docs, items) == want
    # many blocks, small pieces of text, few cells at once
    monkeypatch.setattr(lexical_search, "PIECE", 64)
    monkeypatch.setattr(lexical_search, "CELLS", 500)
    assert run(spark, docs, items, block_terms=60) == want
    assert run(spark, docs, items, k=1) == brute(docs, items, 1)


def test_empty_tables(spark):
    docs, items = corpus(5)
    assert run(spark, [], items) == [] and run(spark, docs, []) == [] and run(spark, [(1, None)], items) == []
    # one document holds every term: its weights are still above zero
    assert run(spark, [(1, "a b")], [(9, "b")]) == brute([(1, "a b")], [(9, "b")])


def test_shared_sets_save_additions():
    rng = np.random.default_rng(1)
    common = [set(rng.choice(200, 12, replace=False).tolist()) for _ in range(6)]
    sets = [sorted(common[i % 6] | common[(i + 1) % 6] | {200 + i}) for i in range(60)]
    made, left = lexical_search.share(sets, 260)

    def leaves(x):
        return [x] if x < 260 else [y for part in made[x - 260] for y in leaves(part)]

    for s, rest in zip(sets, left):
        assert sorted(y for x in rest for y in leaves(x)) == s
    plain, shared = sum(len(s) - 1 for s in sets), len(made) + sum(len(x) - 1 for x in left)
    assert shared < plain / 4
