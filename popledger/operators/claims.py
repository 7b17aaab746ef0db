"""Windowed claim aggregate and member months: the two templates most results start from."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from popledger.functions.dates import OPEN_END, whole_months
from popledger.functions.nulls import safe_ratio
from popledger.functions.text import starts_ci
from popledger.operators.intervals import in_windows

# output measure -> claim column
MEASURES = {
    "discharges": "prm_admits",
    "prm_util": "prm_util",
    "prm_costs": "prm_costs",
    "allowed": "allowed",
    "paid": "paid",
}


def incurred_day(basis: str = "discharge") -> Column:
    """Day a line counts on: a stay counts on its last day under the discharge basis."""
    if basis == "discharge":
        return F.when(starts_ci("prm_line", "I"), F.col("prm_todate")).otherwise(F.col("prm_fromdate"))
    if basis == "incurred":
        return F.col("prm_fromdate")
    raise ValueError(f"unknown basis {basis!r}")


@dataclass(frozen=True)
class DayBounds:
    """First and last incurred day and last paid day that any window admits."""

    first: date
    last: date
    paid: date


#: Metadata of a day column: least and most days it can lie after another column. A source states it where it holds for every row.
DAYS_AFTER = "days_after"


def day_bounds(windows: DataFrame) -> DayBounds | None:
    """Bounds of a window table, which is a page at most; None if there are no windows. Read once per table."""
    if "_day_bounds" not in windows.__dict__:
        r = windows.agg(F.min("inc_start"), F.max("inc_end"), F.max("paid_thru")).first()
        windows.__dict__["_day_bounds"] = DayBounds(*r) if all(r) else None
    return windows.__dict__["_day_bounds"]


def _shift(day: date, days: int) -> date:
    return day if day == OPEN_END else day + timedelta(days)


def within_bounds(claims: DataFrame, windows: DataFrame, basis: str) -> DataFrame:
    """Lines that some window may hold, cut before they are joined to anything.

    The cut is exact: a line outside the bounds is in no window. Where the source states how far the last day and the paid day
    can lie after the first, the bounds are turned into bounds of the first day as well, which reach the scan as a range of the stored day.
    """
    bounds = day_bounds(windows)
    if bounds is None:
        return claims.where(F.lit(False))

    def below(c: Column, day: date) -> Column:
        return F.lit(True) if day == OPEN_END else c <= F.lit(day)

    kept = (incurred_day(basis) >= F.lit(bounds.first)) & below(incurred_day(basis), bounds.last) & below(F.col("paiddate"), bounds.paid)
    stated = {f.name: f.metadata[DAYS_AFTER] for f in claims.schema.fields if DAYS_AFTER in (f.metadata or {})}
    first = F.col("prm_fromdate")
    if "prm_todate" in stated:
        least, most = stated["prm_todate"]["prm_fromdate"]
        # the incurred day is the first day or the last one
        kept = kept & (first >= F.lit(_shift(bounds.first, -max(0, most)))) & below(first, _shift(bounds.last, -min(0, least)))
    if "paiddate" in stated:
        least, _ = stated["paiddate"]["prm_fromdate"]
        kept = kept & below(first, _shift(bounds.paid, -least))
    return claims.where(kept)


def claims_in_windows(claims: DataFrame, windows: DataFrame, basis: str = "discharge") -> DataFrame:
    """Claim lines with the label of every window they fall in and were paid for."""
    spans = windows.select("time_period", "inc_start", "inc_end", F.col("paid_thru").alias("_thru"))
    return in_windows(within_bounds(claims, windows, basis).withColumn("_incurred", incurred_day(basis)), spans, _placed()).drop(
        "_incurred", "inc_start", "inc_end", "_thru"
    )


def claims_of_roster(claims: DataFrame, windows: DataFrame, roster: DataFrame, basis: str = "discharge") -> DataFrame:
    """Claim lines in the windows their member is rostered in, with the roster's columns.

    Lines meet the roster on the member alone, before they multiply by window: each line
    is moved once, and only matches come out. What lies above is summed on the map side.
    A member with very many lines is split by the adaptive skew join, since the other
    side has at most one row per window for it.
    """
    spans = roster.join(
        windows.select("time_period", "inc_start", "inc_end", F.col("paid_thru").alias("_thru")), "time_period"
    ).withColumnRenamed("member_id", "_member")
    return (
        within_bounds(claims, windows, basis).withColumn("_incurred", incurred_day(basis))
        .join(spans, (F.col("member_id") == F.col("_member")) & _placed(), "inner")
        .drop("_incurred", "_member", "inc_start", "inc_end", "_thru")
    )


def _placed() -> Column:
    return F.col("_incurred").between(F.col("inc_start"), F.col("inc_end")) & (F.col("paiddate") <= F.col("_thru"))


def agg_claims(
    claims: DataFrame,
    windows: DataFrame,
    dims: Sequence[str],
    where: Column | None = None,
    basis: str = "discharge",
    measures: dict[str, str] | None = None,
    cases: DataFrame | None = None,
    roster: DataFrame | None = None,
) -> DataFrame:
    """Sums of the measures and the number of lines, by window and dimension.

    Lines are cut to the needed columns and the windows' days, filtered and matched with the broadcast window
    table before a single group-by, whose partial sums run on the map side.
    With ``roster`` only lines of members rostered in the window count, and dimensions may
    name roster columns. With ``cases`` the attributes of the case come along
    (``caseadmitid`` must be a dimension).
    """
    measures = MEASURES if measures is None else measures
    lines = claims if where is None else claims.where(where)
    carried = [] if roster is None else [d for d in dims if d in roster.columns and d != "member_id"]
    needed = dict.fromkeys(
        [*[d for d in dims if d not in carried], "prm_line", "prm_fromdate", "prm_todate", "paiddate", *measures.values()]
    )
    if roster is None:
        placed = claims_in_windows(lines.select(*needed), windows, basis)
    else:
        needed["member_id"] = None
        placed = claims_of_roster(lines.select(*needed), windows, roster.select("member_id", "time_period", *carried), basis)
    out = placed.groupBy("time_period", *dims).agg(
        *[F.sum(src).alias(name) for name, src in measures.items()],
        F.count(F.lit(1)).alias("claim_lines"),
    )
    return out if cases is None else with_cases(out, cases)


def with_cases(rows: DataFrame, cases: DataFrame) -> DataFrame:
    """The attributes of the case next to rows that name one."""
    return rows.join(cases.select("caseadmitid", *[c for c in cases.columns if c not in rows.columns]), "caseadmitid", "left")


def agg_memmos(spans: DataFrame, windows: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Member months by window and dimension, per coverage type.

    Spans run in whole months and do not overlap within a member.
    """
    placed = in_windows(
        spans.select(*dict.fromkeys([*dims, "date_start", "date_end", "cover_medical", "cover_rx"])),
        windows.select("time_period", "inc_start", "inc_end"),
        (F.col("date_start") <= F.col("inc_end")) & (F.col("date_end") >= F.col("inc_start")),
    )
    months = whole_months(F.greatest("date_start", "inc_start"), F.least("date_end", "inc_end")).cast("double")

    def covered(flag: str) -> Column:
        return F.sum(F.when(F.upper(flag) == "Y", months).otherwise(F.lit(0.0)))

    return placed.groupBy("time_period", *dims).agg(
        covered("cover_medical").alias("memmos_medical"), covered("cover_rx").alias("memmos_rx")
    )


def annualised(cost, months) -> Column:
    """Yearly rate of a cost observed over a number of member months."""
    return safe_ratio(cost, months) * 12


def bucket_label(c, bounds: Sequence[tuple[float, str]], beyond: str) -> Column:
    """First bucket whose inclusive upper bound holds the value. A missing value is below every bound."""
    c = F.col(c) if isinstance(c, str) else c
    chain = None
    for upper, label in bounds:
        test = c.isNull() | (c <= upper)
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain.otherwise(beyond)
