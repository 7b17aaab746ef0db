"""Aggregate expressions and shapes shared by the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from popledger.functions.nulls import safe_ratio


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def freq() -> Column:
    """Number of input rows of the group."""
    return F.count(F.lit(1))


def sum_where(condition: Column, c) -> Column:
    return F.sum(F.when(condition, _col(c)).otherwise(F.lit(0)))


def share_of_rows(condition: Column) -> Column:
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def any_row(condition: Column) -> Column:
    """'Y' when the condition holds for at least one row of the group."""
    return F.when(F.max(F.when(condition, 1).otherwise(0)) == 1, "Y").otherwise("N")


def weighted_mean_present(x, w) -> Column:
    """Weighted mean over the rows where ``x`` is present."""
    x, w = _col(x), _col(w)
    return safe_ratio(F.sum(x * w), F.sum(F.when(x.isNotNull(), w)))


def weighted_mean_all(x, w) -> Column:
    """Weighted sum over the weight of all rows, present or not."""
    return safe_ratio(F.sum(_col(x) * _col(w)), F.sum(_col(w)))


def sum_of_ratio(x, by) -> Column:
    """Sum of row-wise ratios; rows without an answer are left out."""
    return F.sum(safe_ratio(x, by))


def remerge_distinct(df: DataFrame, keys: Sequence[str], carried: Sequence[str], sums: dict[str, str]) -> DataFrame:
    """Group sums put back on the distinct combinations of keys and carried columns.

    The rows are first summed per combination, so what is put in order per key is the
    number of distinct combinations, not the number of input rows.
    """
    partial = df.groupBy(*keys, *carried).agg(*[F.sum(src).alias(name) for name, src in sums.items()])
    over_keys = Window.partitionBy(*keys)
    return partial.withColumns({name: F.sum(name).over(over_keys) for name in sums})


def with_group_total(df: DataFrame, keys: Sequence[str], measure: str, into: str) -> DataFrame:
    """Group total next to every row. The total is aggregated and joined back, so a
    large group is never gathered in one task."""
    totals = df.groupBy(*keys).agg(F.sum(measure).alias(into))
    return df.join(totals, list(keys), "inner")


def numeric_columns(df: DataFrame, skip_prefix: str = "date_") -> list[str]:
    """Columns that can be summed: numeric type, not named like a date."""
    from pyspark.sql.types import NumericType

    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, NumericType) and not f.name.lower().startswith(skip_prefix)
    ]
