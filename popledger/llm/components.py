"""Connected components of an edge table, by alternating stars; each round is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from popledger.llm.common import stored


def attach(left: DataFrame, values: DataFrame, key: str, salts: int = 64) -> DataFrame:
    """Inner join of rows with one value row per key, for keys that very many rows share: rows are dealt by
    (key, salt), and a value is copied only to the salts that its key has."""
    salted = left.withColumn("salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int"))
    dealt = salted.select(key, "salt").distinct().join(values, key)
    return salted.join(dealt, [key, "salt"]).drop("salt")


def few_files(edges: DataFrame) -> DataFrame:
    """Edges in partitions of the advised size: the later rounds have few, and each round is written."""
    return edges.hint("rebalance")


def state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node of ``edges`` (a, b: bigint). Isolated nodes do not appear.

    Every round hangs the neighbours of a node on the smallest among them, first the larger ones, then the smaller ones, until
    nothing changes: then each component is one star. The number of rounds grows with the logarithm of the paths' length.
    """
    now = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = stored(few_files(now), "edges")
    before = state(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = attach(both.where("v > u"), least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = stored(few_files(large), "large-star")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(lowest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(few_files(rest.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()), "small-star")
        after = state(now)
        if after == before:
            break
        before = after
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(roots)
