"""Wide to long and back."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def _labels(labels: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])


def metrics_long(df: DataFrame, ids: Sequence[str], labels: dict[str, str]) -> DataFrame:
    """One row per metric column: id from its name, display name from ``labels``."""
    wide = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in labels])
    long = wide.unpivot(list(ids), list(labels), "metric_id", "metric_value")
    return long.select(*ids, "metric_id", F.element_at(_labels(labels), F.col("metric_id")).alias("metric_name"), "metric_value")


def unpivot_prefix(df: DataFrame, ids: Sequence[str], prefix: str, kind: str, value: str) -> DataFrame:
    """Columns named ``prefix_kind`` to rows; the kind is read off the column name in proper case."""
    columns = [c for c in df.columns if c.lower().startswith(prefix.lower() + "_")]
    long = df.unpivot(list(ids), columns, "_source", value)
    return long.select(*ids, F.initcap(F.split_part("_source", F.lit("_"), F.lit(2))).alias(kind), value)


def pivot_ids(df: DataFrame, keys: Sequence[str], id_column: str, value: str, ids: Sequence[str]) -> DataFrame:
    """One column per listed id."""
    return df.groupBy(*keys).pivot(id_column, list(ids)).agg(F.first(value))


def flags_set(df: DataFrame, ids: Sequence[str], flags: Sequence[str], name: str) -> DataFrame:
    """Sparse long form: one row for every flag equal to 1."""
    wide = df.select(*ids, *[F.col(c).cast("int").alias(c) for c in flags])
    return wide.unpivot(list(ids), list(flags), name, "_set").where("_set = 1").drop("_set")


def row_to_pairs(df: DataFrame, name: str, value: str) -> DataFrame:
    """One-row table as name/value pairs."""
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in df.columns])
    return wide.unpivot([], wide.columns, name, value)


def first_slot(types: Sequence[str], ids: Sequence[str], code: str) -> Column:
    """Id in the first numbered slot whose type equals ``code``; missing when there is none."""
    slots = F.arrays_zip(F.array(*types).alias("t"), F.array(*ids).alias("i"))
    return F.get(F.filter(slots, lambda s: s["t"] == code), F.lit(0))["i"]


def strip_to_last(df: DataFrame, delimiter: str = "_") -> DataFrame:
    """Column names cut to the part after the last delimiter."""
    return df.toDF(*[c.rsplit(delimiter, 1)[-1] for c in df.columns])


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Union all by name; columns absent from a frame are missing."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows found on one side only; one pass over both sides instead of two differences."""
    sides = (
        a.withColumn("_a", F.lit(1)).withColumn("_b", F.lit(0))
        .unionByName(b.withColumn("_a", F.lit(0)).withColumn("_b", F.lit(1)))
    )
    return sides.groupBy(*a.columns).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b")).where("_a + _b = 1").drop("_a", "_b")


def one_field_rows(df: DataFrame, ids: Sequence[str], fields: Sequence[str], tag: str) -> DataFrame:
    """A row per field and input row in which that field alone is set and all others are missing, as outputs that are reset in between."""
    rows = F.array(*[
        F.struct(F.lit(own).alias(tag), *[(F.col(f) if f == own else F.lit(None).cast(df.schema[f].dataType)).alias(f) for f in fields])
        for own in fields
    ])
    return df.select(*ids, F.explode(rows).alias("_row")).select(*ids, "_row.*")
