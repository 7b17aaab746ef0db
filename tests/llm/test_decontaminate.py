import pytest
from pyspark.sql import functions as F

from popledger.llm import decontaminate
from popledger.llm.registry import QUERIES
from tests.llm import brute

ITEMS = [(1, "One two three four five six seven eight nine ten eleven"), (2, "tiny ITEM"), (3, None), (4, " ,. "), (5, "tiny item"), (10, "one two three four five six seven eight nine ten zwölf")]
DOCS = [
    (1, "say ONE two, three four five six-seven eight nine ten eleven! and more"), (2, None), (3, ""), (4, "a tiny item; tiny\nitem tiny"),
    (5, "one two three four five six seven eight nine"), (6, "x " * 500 + "Tiny Item"), (7, "Item tiny"), (7, "tiny item"),
    (8, "one two three four five six seven eight nine ten ZWöLF"),
]


def tables(spark):
    docs = spark.createDataFrame([(d, t, "i", 0) for d, t in DOCS], "doc_id bigint, text string, item string, hash int")
    return docs, spark.createDataFrame(ITEMS, "item_id bigint, text string")


def test_tables(spark, small):
    read = lambda name, key: [tuple(r) for r in spark.read.parquet(f"{small}/{name}.parquet").select(key, "text").collect()]
    want = brute.decontaminate(read("documents", "doc_id"), read("benchmark", "item_id"))
    got = QUERIES["op3_benchmark_decontamination"](spark, small).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got} == want
    assert any(v[4] for v in want.values()) and not all(v[4] for v in want.values())


@pytest.mark.parametrize("broadcast", [1000, 0])
def test_odd_texts_by_broadcast_and_by_join(spark, broadcast):
    docs, items = tables(spark)
    one_each = docs.where("not (doc_id = 7 and text = 'Item tiny')")
    got = decontaminate.scan(one_each, items, broadcast_windows=broadcast).withColumn("sha", F.sha2(F.array_join("items", ",").cast("binary"), 256)).collect()
    want = brute.decontaminate([tuple(r) for r in one_each.select("doc_id", "text").collect()], ITEMS)
    assert {r.doc_id: (r.n_words, r.n_hit, len(r.items), r.sha, r.n_hit > 0) for r in got} == want
    clean = {r.doc_id: r.clean for r in got}
    assert clean[4] == "a ; " + "\n"[:0] + " tiny" or clean[4].startswith("a ") and "item" not in clean[4]
    assert clean[1] == "say ! and more" and clean[5] is None


def test_rows_with_one_id_are_scanned_apart(spark):
    docs, items = tables(spark)
    assert sorted(r.n_hit for r in decontaminate.scan(docs, items).where("doc_id = 7").collect()) == [0, 2]


@pytest.mark.parametrize("broadcast", [1000, 0])
def test_rows_and_items_without_ids(spark, broadcast):
    text = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(None, text), (None, "clean words"), (7, "other"), (7, "x " + text), (8, "secret item here")], "doc_id bigint, text string")
    items = spark.createDataFrame([(3, text), (None, "secret item")], "item_id bigint, text string")
    got = sorted(((r.doc_id, r.n_hit, r["items"]) for r in decontaminate.scan(docs, items, broadcast_windows=broadcast).collect()), key=repr)
    assert got == sorted([(None, 11, ["3"]), (None, 0, []), (7, 0, []), (7, 11, ["3"]), (8, 2, [])], key=repr)


def test_empty_tables(spark):
    docs, items = tables(spark)
    assert decontaminate.scan(docs.limit(0), items).count() == 0
    assert decontaminate.scan(docs, items.limit(0)).where("n_hit > 0").count() == 0
