"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,4)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Exact amount: sums of it do not depend on the order of the rows."""
    return _col(c).cast(MONEY)


def round_to(c, unit: float) -> Column:
    """Nearest multiple of ``unit``, halves away from zero."""
    c = _col(c).cast("double")
    return F.sign(c) * F.floor(F.abs(c) / unit + 0.5) * unit


def logistic(c) -> Column:
    return 1 / (1 + F.exp(-_col(c)))


def smape(a, b) -> Column:
    """Symmetric relative difference of two totals, 0 when both are 0."""
    a, b = _col(a).cast("double"), _col(b).cast("double")
    return F.coalesce(F.try_divide(F.abs(a - b), F.abs(a) + F.abs(b)), F.lit(0.0))
