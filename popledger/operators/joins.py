"""Join shapes with a meaning of their own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def crosswalk(df: DataFrame, member: str, xref: DataFrame, previous: str, current: str) -> DataFrame:
    """Replace a previous id by the current one; ids without an entry stay."""
    pairs = xref.select(F.col(previous).alias("_prev"), F.col(current).alias("_curr")).distinct()
    return (
        df.join(pairs, F.col(member) == F.col("_prev"), "left")
        .withColumn(member, F.coalesce("_curr", member))
        .drop("_prev", "_curr")
    )


def id_closure(ids: DataFrame, member: str, xref: DataFrame, previous: str, current: str, keep: Sequence[str] = ()) -> DataFrame:
    """Given ids with their current and their previous ids, each once."""
    own = ids.select(*keep, member)
    pairs = xref.select(F.col(previous).alias("_prev"), F.col(current).alias("_curr")).distinct()
    newer = own.join(pairs, F.col(member) == F.col("_prev")).select(*keep, F.col("_curr").alias(member))
    older = own.join(pairs, F.col(member) == F.col("_curr")).select(*keep, F.col("_prev").alias(member))
    return newer.unionByName(older).unionByName(own).distinct()


def with_flag(df: DataFrame, other: DataFrame, on: Sequence[str], flag: str) -> DataFrame:
    """'Y' where the keys occur in the other table. The other side is made distinct, so rows never multiply."""
    marked = other.select(*on).distinct().withColumn("_hit", F.lit(1))
    return df.join(marked, list(on), "left").withColumn(
        flag, F.when(F.col("_hit").isNotNull(), "Y").otherwise("N")
    ).drop("_hit")


def strict_lookup(df: DataFrame, ref: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Lookup join that fails while running when the reference holds a key twice."""
    values = [c for c in ref.columns if c not in on]
    unique = ref.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*values)).alias("_v"))
    checked = unique.select(
        *on,
        F.when(F.col("_n") > 1, F.raise_error(F.lit(f"duplicate lookup key in {list(on)}")).cast(unique.schema["_v"].dataType))
        .otherwise(F.col("_v"))
        .alias("_v"),
    )
    out = df.join(checked, list(on), how)
    return out.select(*df.columns, *[F.col(f"_v.{c}").alias(c) for c in values])


def full_mismatch(
    left: DataFrame, right: DataFrame, on: Sequence[str], compare: Sequence[tuple[str, str]]
) -> DataFrame:
    """Full outer join on the keys, keeping rows where any compared pair differs.
    A missing side differs from a present one and equals a missing one."""
    same = None
    for a, b in compare:
        term = F.col(a).eqNullSafe(F.col(b))
        same = term if same is None else same & term
    return left.join(right, list(on), "full").where(~same)


def merge_flags(left: DataFrame, right: DataFrame, on: Sequence[str], names: tuple[str, str]) -> DataFrame:
    """Keys of both sides with a Y/N flag for each side."""
    a = left.select(*on).distinct().withColumn("_a", F.lit(1))
    b = right.select(*on).distinct().withColumn("_b", F.lit(1))
    return a.join(b, list(on), "full").select(
        *on,
        F.when(F.col("_a").isNotNull(), "Y").otherwise("N").alias(names[0]),
        F.when(F.col("_b").isNotNull(), "Y").otherwise("N").alias(names[1]),
    )


def reference(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """A reference table to be broadcast, for joins without a key to shuffle by. Fails beyond ``rows`` rows instead of going on."""
    n = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))
    small = F.assert_true(F.col("_rows") <= rows, F.lit(f"a reference table has more than {rows} rows")).isNull()
    return F.broadcast(df.withColumn("_rows", n).where(small).drop("_rows"))


def fanout_guard(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts before and after a join, on one row."""
    n = F.count(F.lit(1))
    return before.agg(n.alias("rows_before")).join(F.broadcast(after.agg(n.alias("rows_after"))), F.lit(True)).withColumn(
        "fanned_out", F.when(F.col("rows_before") == F.col("rows_after"), "N").otherwise("Y")
    )
