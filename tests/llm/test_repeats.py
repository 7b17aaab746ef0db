import random

import pytest

from popledger.llm import substring_dedup, suffix_dedup
from popledger.llm.registry import QUERIES
from tests.llm import brute


def rows(spark, docs):
    return spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id bigint, text string, gid string, anchor int")


def documents(spark, small):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]


def odd_texts():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abé ") for _ in range(4))
    base = " ".join(word() for _ in range(80))
    return [
        (1, base), (2, None), (3, ""), (4, base), (5, "x " * 300), (6, "x " * 40), (7, base[30:230] + " tail"), (8, "a\x1fb\t\n\x0bc"),
        (9, "start " + base[:150] + " other " + base[100:]), (-4, base[60:200]), (10, "y" * 200), (11, "z" + "y" * 60), (12, base.upper()),
    ]


@pytest.mark.parametrize("which", ["tables", "odd"])
def test_substring_dedup(spark, small, which):
    docs = documents(spark, small) if which == "tables" else odd_texts()
    got = QUERIES["op5_substring_dedup"](spark, small) if which == "tables" else None
    if got is None:
        from pyspark.sql import functions as F

        got = substring_dedup.find(rows(spark, docs)).withColumn("kept_sha256", F.sha2(F.col("kept").cast("binary"), 256))
    want = brute.substring_dedup(docs)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()} == want
    assert any(v[1] for v in want.values())


@pytest.mark.parametrize("which", ["tables", "odd"])
def test_suffix_dedup(spark, small, which):
    from pyspark.sql import functions as F

    docs = documents(spark, small) if which == "tables" else odd_texts()
    found = suffix_dedup.find(rows(spark, docs)).withColumn("kept_sha256", F.sha2("kept", 256))
    want = brute.suffix_dedup(docs)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.collect()} == want
    assert any(v[1] for v in want.values())


def test_spans_are_what_was_removed(spark):
    for module, size in ((substring_dedup, "n_words"), (suffix_dedup, "n_bytes")):
        for r in module.find(rows(spark, odd_texts())).collect():
            assert sum(b - a for a, b in zip(r.span_start, r.span_end)) == r.n_removed <= r[size]


def test_empty_table(spark):
    assert substring_dedup.find(rows(spark, [])).count() == 0
    assert suffix_dedup.find(rows(spark, [])).count() == 0


def test_rows_without_an_id_come_last(spark):
    text = "".join(chr(97 + i * 7 % 26) for i in range(80)) + " tail of the text"
    docs = [(9, text), (5, text), (None, text), (None, "x" + text), (2**53 + 1, text), (2**53, text)]
    found = suffix_dedup.find(rows(spark, docs)).collect()
    n = len(text)
    assert sorted((r.doc_id or -1, r.n_removed) for r in found) == [(-1, n), (-1, n), (5, 0), (9, n), (2**53, n), (2**53 + 1, n)]
    alone = suffix_dedup.find(rows(spark, [(None, text), (None, text)])).collect()
    assert [(r.doc_id, r.n_removed) for r in alone] == [(None, 0), (None, 0)]


def thue_morse(n, a="a", b="b"):
    return "".join(b if i.bit_count() % 2 else a for i in range(n))


@pytest.mark.parametrize("n", [1024, 2048])
def test_long_words_that_a_polynomial_takes_for_equal(spark, n):
    from popledger.llm import decontaminate, ngram_join

    one, other = thue_morse(n), thue_morse(n, "b", "a")
    common = " ".join(f"w{i}" for i in range(34))
    docs = [(1, f"{common} {one}"), (2, f"{common} {other}")]
    assert {r.doc_id: r.n_removed for r in substring_dedup.find(rows(spark, docs)).collect()} == {1: 0, 2: 0}
    short = rows(spark, [(1, f"a b {one}"), (2, f"a b {other}"), (3, f"A B {one.upper()}")])
    assert {r.doc_id: r.component_id for r in ngram_join.join(short).collect()} == {1: 1, 2: 2, 3: 1}
    items = spark.createDataFrame([(5, one)], "item_id bigint, text string")
    assert {r.doc_id: r.n_hit for r in decontaminate.scan(short, items).collect()} == {1: 1, 2: 0, 3: 1}
