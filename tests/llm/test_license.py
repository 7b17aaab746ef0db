import random
import re
from collections import Counter

from popledger.llm import license_scan
from popledger.llm.license_scan import TEMPLATES, align, longest_rising
from popledger.llm.registry import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(t):
    return WORD.findall((t or "").lower())


def plain_align(text, template):
    """Patience alignment by its definition, on words."""
    if not text or not template:
        return 0
    a, b = Counter(text), Counter(template)
    anchors = [(i, template.index(w)) for i, w in enumerate(text) if a[w] == 1 and b[w] == 1]
    best = []
    for k, (i, t) in enumerate(anchors):
        best.append(max((x for (j, s), x in zip(anchors, best) if s < t), key=len, default=[]) + [(i, t)])
    kept = max(best, key=len, default=[])
    if kept:
        edges = [(-1, -1), *kept, (len(text), len(template))]
        return len(kept) + sum(plain_align(text[x + 1 : y], template[s + 1 : t]) for (x, s), (y, t) in zip(edges, edges[1:]))
    if text[0] == template[0]:
        return 1 + plain_align(text[1:], template[1:])
    if text[-1] == template[-1]:
        return 1 + plain_align(text[:-1], template[:-1])
    return 0


def test_longest_rising():
    rng = random.Random(1)
    for _ in range(200):
        v = rng.sample(range(50), rng.randrange(12))
        got = [v[i] for i in longest_rising(v)]
        assert got == sorted(got)
        best = [1] * len(v)
        for i in range(len(v)):
            best[i] = 1 + max((best[j] for j in range(i) if v[j] < v[i]), default=0)
        assert len(got) == max(best, default=0)


def test_alignment_is_rising_and_of_equal_words():
    rng = random.Random(2)
    for _ in range(300):
        text, template = ([rng.randrange(12) for _ in range(rng.randrange(15))] for _ in range(2))
        got = align(text, template)
        assert all(text[i] == template[j] for i, j in got)
        assert all(a < c and b < d for (a, b), (c, d) in zip(got, got[1:]))


def test_tables(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op6_license_scan"](spark, small).collect()}
    assert got.keys() == docs.keys()
    some = 0
    for d, t in docs.items():
        text = split(t)
        share = {}
        for name, template in TEMPLATES.items():
            words = split(template)
            if sum((Counter(text) & Counter(words)).values()) >= 0.8 * len(words):
                share[name] = plain_align(text, words) / len(words)
        want = sorted(n for n, s in share.items() if s >= 0.8)
        assert got[d].licenses == want
        if want:
            some += 1
            assert got[d].coverage == max(share.values())
    assert some > 3


def test_odd_texts(spark):
    long = TEMPLATES["mit"]
    broken = long.replace("hereby", "now").replace("free of charge", "free")
    docs = [(1, None), (2, ""), (3, long.upper()), (4, "intro " * 50 + broken + " outro" * 50), (5, long[: len(long) // 2]), (5, "the " * 40_000), (6, "All\n\n rights;reserved"), (7, "rights all reserved")]
    rows = spark.createDataFrame([(d, t, "x", 1.0) for d, t in docs], "doc_id bigint, text string, license string, coverage double")
    got = {(r.doc_id, r.license): r for r in license_scan.scan(rows).collect()}
    assert len(got) == 7 and {k for k in got if k[1]} == {(3, "mit"), (4, "mit"), (6, "all-rights-reserved")}
    assert got[3, "mit"].coverage == 1 and 0.9 < got[4, "mit"].coverage < 1
    assert (got[3, "mit"].span_start, got[3, "mit"].span_end) == (0, len(long) - 1)
    assert got[4, "mit"].span_start == 300
    assert license_scan.scan(rows, {}).where("license is not null").count() == 0
    assert license_scan.scan(rows.limit(0)).count() == 0


def test_a_license_twice_and_its_words_elsewhere(spark):
    name, mit = "mit", TEMPLATES["mit"]
    short = {"short": "Released under the MIT License.", "rights": "All rights reserved."}
    rows = [
        (1, "foo bar. Released under the MIT License. some code here. Released under the MIT License. more text"),
        (2, "all the rights were reserved for all. " * 30 + "All rights reserved. " + "reserved rights of all " * 30),
        (3, "license, MIT, the, under, released; license of MIT and the rest"),
        (4, "x " * 5000 + mit + " y" * 5000 + " " + mit + " " + " ".join(reversed(mit.split())) * 3),
        (5, "the license " * 4000),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in license_scan.scan(df, short).collect()}
    assert got[1].licenses == ["short"] and (got[1].span_start, got[1].span_end) == (9, 39)
    assert got[2].licenses == ["rights"] and got[2].coverage == 1.0
    assert [got[i].licenses for i in (3, 5)] == [[], []]
    full = {r.doc_id: r for r in license_scan.scan(df).collect()}
    assert name in full[4].licenses and full[4].coverage == 1.0
