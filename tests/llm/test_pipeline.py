import pytest

import corpus_pipeline
from popledger.llm import toxicity
from tests.llm import brute
from tests.llm.test_ngram_join import brute as brute_groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, small):
    """Input and output of every stage on the smallest tables."""
    docs, out = spark.read.parquet(f"{small}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, small).cache()
        out[name] = ({r.doc_id: r.text for r in docs.collect()}, {r.doc_id: r for r in result.collect()}, result.columns)
        docs = result
    return out


def test_names_and_columns(stages):
    assert list(stages) == ["toxicity", "ngram_jaccard_join", "suffix_array_dedup", "benchmark_decontamination", "bpe_encoding"]
    assert [x[2] for x in stages.values()] == [COLUMNS] * 4 + [[*COLUMNS, "n_tokens", "ids"]]


def test_toxicity(spark, small, stages):
    before, after, _ = stages["toxicity"]
    docs = spark.read.parquet(f"{small}/documents.parquet")
    scores = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{small}/labels.parquet"))).collect()}
    assert after.keys() == {d for d in before if scores[d] < 0.5}
    assert all(after[d].text == before[d] for d in after)


def test_near_duplicates(stages):
    before, after, _ = stages["ngram_jaccard_join"]
    assert after.keys() == {d for d, (_, c) in brute_groups(list(before.items()), 5, 80).items() if c == d}
    assert len(after) < len(before)


def test_substrings(stages):
    before, after, _ = stages["suffix_array_dedup"]
    want = brute.suffix_dedup(list(before.items()))
    assert after.keys() == {d for d, (n, gone, *_) in want.items() if not n or gone < n}
    for d, r in after.items():
        n, gone, _, _ = want[d]
        assert (r.text == before[d]) == (gone == 0) and r.n_chars == len(r.text) and n - gone - len(r.text.encode()) in range(0, 400)
        assert "�" not in r.text


def test_benchmark(small, spark, stages):
    before, after, _ = stages["benchmark_decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    assert after.keys() == {d for d, x in brute.decontaminate(list(before.items()), items).items() if not x[4]}


def test_encoding(stages):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    before, after, _ = stages["bpe_encoding"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert after.keys() == before.keys()
    for d, text in before.items():
        assert np.frombuffer(after[d].ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids and after[d].text == text


def test_run_equals_the_stages(spark, small, stages):
    got = {r.doc_id: bytes(r.ids) for r in corpus_pipeline.run(spark, small).collect()}
    assert got == {d: bytes(r.ids) for d, r in stages["bpe_encoding"][1].items()}


def test_odd_rows_pass_all_stages(spark, small):
    rows = [(None, "no id " * 30, "en", "s", 1), (1, None, None, None, None), (2, "", "en", "s", 0), (3, "same words here " * 20, "en", "s", 5), (4, "same words here " * 20, "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small).cache()
    got = {r.doc_id: r for r in docs.collect()}
    assert got.keys() == {None, 1, 2, 3} and docs.count() == 4
    assert stage_count_on_empty(spark, small) == 0


def stage_count_on_empty(spark, small):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
    return docs.count()


def test_every_row_is_judged_by_its_own_text(spark, small, tmp_path):
    """Rows without an id, repeated ids and repeated rows: none is lost or doubled by stages that keep it."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    benchmark = spark.read.parquet(f"{small}/benchmark.parquet").where("length(text) > 100").first().text
    plain = [f"row {i} " + " ".join(f"{chr(97 + i)}{j}word" for j in range(30)) for i in range(6)]
    odd = [(None, plain[0]), (None, plain[1]), (None, benchmark), (7, plain[2]), (7, plain[3]), (7, plain[3]), (None, None), (9, plain[4]), (10, plain[4] + " end")]
    rows = spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in odd], docs.schema)
    run = lambda stage: sorted(((r.doc_id, r.text) for r in stage(spark, rows, small).collect()), key=repr)
    every = sorted(odd, key=repr)
    assert run(corpus_pipeline.benchmark_decontamination) == [x for x in every if x[1] != benchmark]
    coded = run(corpus_pipeline.bpe_encoding)
    assert coded == sorted(((i, t or "") for i, t in odd), key=repr)
    near = run(corpus_pipeline.ngram_jaccard_join)
    assert len(near) == len(odd) - 2 and (10, plain[4] + " end") not in near and near.count((7, plain[3])) == 1
    kept = run(corpus_pipeline.suffix_array_dedup)
    assert kept.count((7, plain[3])) == 1 and (9, plain[4]) in kept and (7, plain[2]) in kept
    numbered = corpus_pipeline.with_rows(rows).collect()
    assert len({r[corpus_pipeline.ROW] for r in numbered}) == len(odd) and {r[corpus_pipeline.ROW] for r in numbered if r.doc_id in (9, 10)} == {9, 10}


def test_a_stage_without_documents(spark, small):
    none = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, none, small).count() == 0
