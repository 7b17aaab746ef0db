"""Calendar helpers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

OPEN_END = date(9999, 12, 31)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_begin(d, months: int | Column = 0) -> Column:
    """First day of the month ``months`` away."""
    return F.trunc(F.add_months(_col(d), months), "month").cast("date")


def month_end(d, months: int | Column = 0) -> Column:
    """Last day of the month ``months`` away."""
    return F.last_day(F.add_months(_col(d), months))


def quarter_label(d) -> Column:
    d = _col(d)
    return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))


def period_label(start, end) -> Column:
    return F.concat(quarter_label(start), F.lit("_"), quarter_label(end))


def age_at(dob, day) -> Column:
    """Completed years on ``day``; 0 for those born later, missing without a birth date."""
    dob, day = _col(dob), _col(day)
    return F.when(dob > day, F.lit(0)).otherwise(F.floor(F.months_between(day, dob) / 12).cast("int"))


def days_apart(later, earlier) -> Column:
    return F.datediff(_col(later), _col(earlier))


def whole_months(start, end) -> Column:
    """Calendar months touched by a span that starts and ends in month units; 0 when empty."""
    start, end = _col(start), _col(end)
    months = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start) + 1
    return F.when(end < start, F.lit(0)).otherwise(months)
