"""Comparisons and arithmetic in which a missing value behaves as reports expect.

A missing number sorts below every number, a division that has no answer is
missing, and blank text is missing.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def le_missing(c, bound) -> Column:
    """``c <= bound`` where a missing ``c`` counts as smaller than anything."""
    c = _col(c)
    return c.isNull() | (c <= bound)


def gt_missing(c, bound) -> Column:
    """``c > bound``, false for a missing ``c``."""
    return F.coalesce(_col(c) > bound, F.lit(False))


def safe_ratio(num, den) -> Column:
    """Ratio as double; missing when the denominator is zero or missing."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def blank_to_null(c) -> Column:
    """Trimmed text, missing when nothing is left."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def coalesce_text(c, default: str) -> Column:
    return F.coalesce(blank_to_null(c), F.lit(default))


def sum_present(*cols) -> Column:
    """Sum of the arguments that are present; missing when none is."""
    cs = [_col(c) for c in cols]
    total = F.lit(0.0)
    any_present = F.lit(False)
    for c in cs:
        total = total + F.coalesce(c.cast("double"), F.lit(0.0))
        any_present = any_present | c.isNotNull()
    return F.when(any_present, total)


def default_columns(df, defaults: dict):
    """Replace missing values of several columns in one projection."""
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in defaults.items()}
    )


def null_safe_join(left, right, on: list[str], how: str = "left"):
    """Equi-join in which missing keys match each other; keeps the left keys."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in on})
    cond = None
    for k in on:
        term = left[k].eqNullSafe(renamed[f"__{k}"])
        cond = term if cond is None else cond & term
    return left.join(renamed, cond, how).drop(*[f"__{k}" for k in on])
