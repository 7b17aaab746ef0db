"""First, last and running number within a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row of each group that comes first by ``order``, then by the remaining columns.

    A minimum over structs: it is combined on the map side, so a large group costs no
    more than a small one, unlike a row number.
    """
    return _edge(df, keys, order, F.min)


def last_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row of each group that comes last by ``order``, then by the remaining columns."""
    return _edge(df, keys, order, F.max)


def _edge(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*[F.col(c) for c in [*order, *rest]])
    picked = df.groupBy(*keys).agg(pick(row).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in [*order, *rest]]).select(*df.columns)


def number_in_group(df: DataFrame, group: str, item: str, into: str, digits: int = 3) -> DataFrame:
    """Running number 1, 2, … of the items within each group.

    Items are spread over ``16**digits`` buckets by a digest of the item; the number is
    the count of the buckets before plus the position within the bucket. A group of any
    size is thus numbered by many tasks; only the bucket counts are put in order.
    """
    bucketed = df.withColumn("_bucket", F.substring(F.md5(F.col(item).cast("string")), 1, digits))
    counts = bucketed.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        group, "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy(group, "_bucket").orderBy(item)
    return (
        bucketed.join(offsets, [group, "_bucket"])
        .withColumn(into, F.col("_before") + F.row_number().over(within))
        .drop("_bucket", "_before")
    )


def latest(df: DataFrame, column: str) -> DataFrame:
    """Rows of the latest value of a column; the maximum is a scalar subquery of one row."""
    newest = df.agg(F.max(column).alias("_newest"))
    return df.join(newest, F.col(column) == F.col("_newest"), "inner").drop("_newest")


def sorted_output(df: DataFrame, *order: Column) -> DataFrame:
    """Total order for a delivered table; a range-partitioned sort."""
    return df.orderBy(*order)
