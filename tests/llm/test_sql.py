"""The SQL of the contracts against their plain definitions; the queries are held against the plain definitions elsewhere."""

import duckdb
import pytest

from popledger.llm.registry import ORACLES, QUERIES
from tests.llm import brute
from tests.llm.test_ngram_join import brute as brute_groups

PLAIN = {
    "op1_ngram_jaccard_join": lambda docs, items: brute_groups(docs),
    "op3_benchmark_decontamination": brute.decontaminate,
    "op5_substring_dedup": lambda docs, items: brute.substring_dedup(docs),
    "op8_suffix_array_dedup": lambda docs, items: brute.suffix_dedup(docs),
}


@pytest.mark.parametrize("name", PLAIN)
def test_sql_equals_the_plain_definition(spark, small, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{small}/{t}.parquet'")
    docs, items = (con.execute(f"select {k}, text from {t}").fetchall() for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    rel = con.sql(ORACLES[name])
    assert rel.columns == QUERIES[name](spark, small).columns
    assert {r[0]: r[1:] for r in rel.fetchall()} == PLAIN[name](docs, items)


def test_sql_of_odd_texts():
    docs = [(1, "One two"), (2, "one TWO"), (3, None), (4, ""), (5, "x " * 60), (6, "y" * 60 + "é" * 30), (7, "z" + "y" * 60 + "é" * 30), (8, "say ITEM one, here")]
    items = [(1, "item ONE"), (2, None), (3, "two")]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.execute("create table benchmark (item_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", docs)
    con.executemany("insert into benchmark values (?, ?)", items)
    for name, plain in PLAIN.items():
        assert {r[0]: r[1:] for r in con.execute(ORACLES[name]).fetchall()} == plain(docs, items), name
