"""Corpus pipeline: the stages in order, each over all documents its predecessor kept.

``run`` writes the result of every stage to the cluster's checkpoint folder and reads it again, so a lost executor costs at most one
stage. Every stage returns the columns of ``documents`` (the last one adds token ids), with ``n_chars`` brought up to date where a text changes.

Stages decide by row. A row's number is its ``doc_id`` where that is its own; rows without an id, and rows whose id others have too, are
numbered after all ids, and the numbers are written before use. So no row is lost or doubled, each is judged by its own text, and where
an order matters such rows come last.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from popledger.llm import bpe, decontaminate, ngram_join, suffix_dedup, toxicity as toxic
from popledger.llm.common import shared_folder, stored, table
from popledger.llm.registry import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Name of the row number while a stage works; no column of documents is called so.
ROW = "__row"


def with_rows(docs: DataFrame) -> DataFrame:
    """The documents with a number of their own."""
    doc_id = F.col("doc_id").cast("bigint")
    times = docs.groupBy(doc_id.alias("__id")).agg(F.count(F.lit(1)).alias("__n"))
    repeated = times.where("__n > 1 or __id is null")
    if repeated.isEmpty():
        return docs.withColumn(ROW, doc_id)
    first = docs.agg(F.greatest(F.coalesce(F.max(doc_id), F.lit(0)), F.lit(0))).first()[0] + 1
    numbered = stored(docs.withColumn("__place", F.monotonically_increasing_id()), "rows")
    marked = numbered.join(repeated.where("__id is not null"), numbered["doc_id"].cast("bigint") == F.col("__id"), "left")
    own = F.when(doc_id.isNotNull() & F.col("__n").isNull(), doc_id).otherwise(F.lit(first) + F.col("__place"))
    return marked.select(*[numbered[c] for c in docs.columns], own.alias(ROW))


def by_row(docs: DataFrame) -> DataFrame:
    """What an operator reads: the row's number as its id, and the text."""
    return docs.select(F.col(ROW).alias("doc_id"), "text")


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """Documents whose row is not among the rejected ones (column ``id``), without their number."""
    return docs.join(rejected, docs[ROW] == rejected["id"], "left_anti").drop(ROW)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain, fitted on the labelled ones, scores 0.5 or more go."""
    model = toxic.fit(docs, table(spark, sf_dir, "labels"))
    rows = with_rows(docs)
    return without(rows, toxic.score(by_row(rows), model).where("score >= 0.5").select(F.col("doc_id").alias("id")))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a similarity of 0.8 or more on five-word shingles, the one with the smallest number stays."""
    rows = with_rows(docs)
    groups = ngram_join.join(by_row(rows), n=5, percent=80)
    return without(rows, groups.where("doc_id != component_id").select(F.col("doc_id").alias("id")))


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes or more that a document with a smaller number has are cut out; characters cut in part go whole, and
    documents of which nothing is left go."""
    rows = with_rows(docs)
    # the operator returns every text, so texts are joined once: the other side is without them
    found = suffix_dedup.find(by_row(rows), characters=True).select(
        F.col("doc_id").alias("id"), F.col("kept").cast("string").alias("rest"), (F.col("n_removed") > 0).alias("changed"),
        ((F.col("n_removed") > 0) & (F.col("n_removed") == F.col("n_bytes"))).alias("gone"),
    )
    others = rows.withColumn("__none", F.col("text").isNull()).drop("text")
    joined = others.join(found, others[ROW] == found["id"]).where(~found["gone"])
    text = F.when(~others["__none"], found["rest"])
    new: dict[str, Column] = {"text": text, "n_chars": F.when(found["changed"], F.length(found["rest"]).cast("bigint")).otherwise(others["n_chars"])}
    return joined.select(*[new[c].alias(c) if c in new else others[c] for c in docs.columns])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a ten-word window of a benchmark item, or a whole shorter item, go."""
    rows = with_rows(docs)
    hits = decontaminate.scan(by_row(rows), table(spark, sf_dir, "benchmark"))
    return without(rows, hits.where("n_hit > 0").select(F.col("doc_id").alias("id")))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids; the text is what the ids decode to."""
    path = tokenizer_path()
    rows = with_rows(docs)
    coded = bpe.decode(bpe.encode(by_row(rows), path), path).select(F.col("doc_id").alias("id"), "n_tokens", "ids", "decoded")
    joined = rows.join(coded, rows[ROW] == coded["id"])
    return joined.select(*[coded["decoded"].alias(c) if c == "text" else rows[c] for c in docs.columns], coded["n_tokens"], coded["ids"])


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding", bpe_encoding),
]
#: The fitted chain and the token ids have no counterpart in SQL; tests compare the stages with plain definitions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/pipeline-{uuid.uuid4().hex[:12]}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
