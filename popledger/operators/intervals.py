"""Joins on dates and the order-dependent operators over spans.

None of these gathers an unbounded group: spans are reduced to one row per key and
start day before they are ordered, so a key never holds more rows than the calendar
has days, however many input rows it has.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F


def in_windows(df: DataFrame, windows: DataFrame, condition: Column) -> DataFrame:
    """Every row in each window it belongs to. Windows have four rows a year and are made from literals, so Spark knows
    how small they are and broadcasts them; a larger table would be joined otherwise."""
    return df.join(windows, condition, "inner")


def merge_spans(df: DataFrame, keys: Sequence[str], start: str, end: str, touching_days: int = 0) -> DataFrame:
    """Union of overlapping spans per key.

    Spans that share a start collapse to the longest before the ordered pass.
    ``touching_days=1`` also merges spans that follow each other without a free day.
    """
    longest = df.where(F.col(start) <= F.col(end)).groupBy(*keys, start).agg(F.max(end).alias(end))
    by_start = Window.partitionBy(*keys).orderBy(start)
    reach = F.max(end).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col(start) > F.date_add(reach, touching_days)), 1).otherwise(0)
    numbered = longest.withColumn("_opens", opens).withColumn("_island", F.sum("_opens").over(by_start))
    return (
        numbered.groupBy(*keys, "_island")
        .agg(F.min(start).alias(start), F.max(end).alias(end))
        .drop("_island")
    )


#: A block of level k is 4**k months; the top level's blocks are longer than the calendar.
LEVELS = 10


def month_number(day: Column) -> Column:
    """Months since year 0."""
    return F.year(day) * 12 + F.month(day) - 1


def blocks_of(first: Column, last: Column) -> Column:
    """The fewest aligned blocks that make up the months ``first`` to ``last``, as an array of (level, block).

    On every level these are the blocks that fit into the range but lie in no block of the next level that fits as well: three at
    most on either side. A range has under 60 blocks, one without an end (to the last month of year 9999) under 40."""
    end = last + 1
    low = lambda k: F.floor((first + (4**k - 1)) / F.lit(4**k)).cast("bigint")
    high = lambda k: F.floor(end / F.lit(4**k)).cast("bigint")

    def level(k: int) -> Column:
        run = lambda a, b: F.when(a < b, F.transform(F.sequence(a, b - 1), lambda x: F.struct(F.lit(k).alias("level"), x.alias("block"))))
        if k == LEVELS - 1:
            return F.coalesce(run(low(k), high(k)), none)
        fits = low(k + 1) < high(k + 1)
        left = run(low(k), F.when(fits, low(k + 1) * 4).otherwise(high(k)))
        right = F.when(fits, run(high(k + 1) * 4, high(k)))
        return F.concat(F.coalesce(left, none), F.coalesce(right, none))

    none = F.array().cast("array<struct<level:int,block:bigint>>")
    return F.concat(*[level(k) for k in range(LEVELS)])


def point_in_span(
    points: DataFrame,
    point: str,
    spans: DataFrame,
    start: str,
    end: str,
    on: Sequence[str],
    horizon: tuple[date, date] | None = None,
    how: str = "inner",
) -> DataFrame:
    """Points joined to the spans of the same key that contain them.

    A span is cut into the few aligned blocks of months that make it up, however long it is, and a point asks for the one block of
    every level that holds it. This makes an equi-join on key, level and block: a key with very many points or spans is split by time
    instead of being compared all against all, a span and a point meet once, and a span open to the end of the calendar costs some
    thirty rows. ``horizon`` leaves out spans beyond the points' range.
    """
    if how not in ("inner", "left_semi", "left_anti"):
        raise ValueError(f"unknown join {how!r}")
    spans = spans.where(F.col(start) <= F.col(end))
    if horizon:
        spans = spans.where((F.col(start) <= F.lit(horizon[1])) & (F.col(end) >= F.lit(horizon[0])))
    blocks = blocks_of(month_number(F.col(start)).cast("bigint"), month_number(F.col(end)).cast("bigint"))
    spread = spans.withColumn("_block", F.explode(blocks)).withColumnsRenamed({k: f"_s_{k}" for k in on})
    month = month_number(F.col(point)).cast("bigint")
    asked = F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright(month, 2 * k).alias("block")) for k in range(LEVELS)])
    cond = (F.col("_pblock") == F.col("_block")) & F.col(point).between(F.col(start), F.col(end))
    for k in on:
        cond = cond & (F.col(k) == F.col(f"_s_{k}"))
    # a point that is kept or left out by whether it has a span must stay one row: it is found by a row of its own
    left = points.where(F.col(point).isNotNull()).withColumn("_pblock", F.explode(asked))
    drop = ["_pblock", "_block", *[f"_s_{k}" for k in on]]
    if how in ("left_semi", "left_anti"):
        keys = [*on, point]
        found = left.select(*keys, "_pblock").join(spread, cond, "left_semi").select(*keys).distinct()
        return points.join(found, keys, how)
    return left.join(spread, cond, how).drop(*drop)


def band_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], later: str, earlier: str, low: int, high: int
) -> DataFrame:
    """Inner equi-join on ``on`` where ``later - earlier`` lies in ``[low, high]`` days.

    Days are bucketed by the width of the band, so each left row meets only the right
    rows of at most two buckets and not all rows of its key.
    """
    width = high - low + 1
    origin = F.lit(date(1900, 1, 1))
    right_b = right.withColumn("_rb", F.floor(F.datediff(F.col(earlier), origin) / width)).withColumnsRenamed(
        {k: f"_r_{k}" for k in on}
    )
    first = F.floor((F.datediff(F.col(later), origin) - high) / width)
    last = F.floor((F.datediff(F.col(later), origin) - low) / width)
    left_b = left.where(F.col(later).isNotNull()).withColumn("_lb", F.explode(F.sequence(first, last)))
    cond = (F.col("_lb") == F.col("_rb")) & F.datediff(F.col(later), F.col(earlier)).between(low, high)
    for k in on:
        cond = cond & (F.col(k) == F.col(f"_r_{k}"))
    return left_b.join(right_b, cond, "inner").drop("_lb", "_rb", *[f"_r_{k}" for k in on])


def nearest_day(targets: DataFrame, target: str, days: DataFrame, day: str) -> DataFrame:
    """For every target the closest day; of two equally close days the later one.

    Both sides are put on one time line of distinct days, and each target looks one step
    back and one step ahead on it. The line has at most one row per calendar day plus
    one per target window, whatever the size of the table the days come from.
    """
    line = (
        days.select(F.col(day).alias("_at"))
        .distinct()
        .select("_at", F.col("_at").alias(day), F.lit(None).cast("date").alias(target))
        .unionByName(
            targets.select(target).distinct().select(
                F.col(target).alias("_at"), F.lit(None).cast("date").alias(day), target
            )
        )
    )
    # a day on the target itself must count as "back": days sort before targets
    order = Window.orderBy("_at", F.col(target).isNotNull())
    back = F.last(day, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first(day, ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing))
    gap_back, gap_ahead = F.datediff(F.col(target), F.col("_back")), F.datediff(F.col("_ahead"), F.col(target))
    closest = F.when(
        F.col("_back").isNull() | (gap_ahead <= gap_back), F.col("_ahead")
    ).otherwise(F.col("_back"))
    found = (
        line.withColumn("_back", back)
        .withColumn("_ahead", ahead)
        .where(F.col(target).isNotNull())
        .select(target, closest.alias(day))
    )
    return targets.join(found, target)


def carry_forward(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, seed: str, into: str
) -> DataFrame:
    """Last known ``value`` in the given order, seeded with the first row's ``seed``.

    Callers pass one row per key and month, so a key's partition is bounded by the calendar.
    """
    so_far = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(
        into, F.coalesce(F.last(value, ignorenulls=True).over(so_far), F.first(seed).over(so_far))
    )
