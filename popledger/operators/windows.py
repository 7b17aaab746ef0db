"""Rolling one-year reporting windows, one per quarter."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from popledger.functions.dates import OPEN_END, month_begin, month_end, period_label
from popledger.settings import ReportSettings


def run_parameters(spark: SparkSession, settings: ReportSettings) -> DataFrame:
    """The run's dates as a one-row frame."""
    return spark.range(1).select(
        F.lit(settings.paid_thru).alias("paid_thru"),
        F.lit(settings.credible_start).alias("credible_start"),
        F.lit(settings.history_cutoff).alias("history_cutoff"),
    )


def time_windows(params: DataFrame, runout_months: int = 2) -> DataFrame:
    """One row per window: label, incurred range, paid-through day and score period.

    The newest window ends at the quarter end on or before the paid-through month less
    the run-out; older ones step back a quarter while they start on or after the floor.
    """
    floor_day = F.greatest("credible_start", "history_cutoff")
    run_end = month_end("paid_thru", -runout_months)
    newest = (
        params.withColumn("_end", run_end)
        .withColumn("_end", F.expr("last_day(add_months(_end, -(month(_end) % 3)))"))
        .withColumn("_start", month_begin("_end", -11))
        .withColumn("_last", F.floor(F.months_between("_start", floor_day) / 3).cast("int"))
        .where("_last >= 0")
        .withColumn("_k", F.explode(F.expr("sequence(0, _last)")))
    )
    back = -3 * F.col("_k")
    stepped = newest.select(
        "credible_start",
        month_begin("_start", back).alias("inc_start"),
        month_end("_end", back).alias("inc_end"),
        F.when(F.col("_k") == 0, F.col("paid_thru")).otherwise(month_end("paid_thru", back)).alias("paid_thru"),
    )
    prior_year = month_begin("inc_start", -12)
    prospective = prior_year >= F.col("credible_start")
    return stepped.select(
        period_label(F.col("inc_start"), F.col("inc_end")).alias("time_period"),
        "inc_start",
        "inc_end",
        "paid_thru",
        F.when(prospective, prior_year).otherwise(F.col("inc_start")).alias("inc_start_riskscr_features"),
        F.when(prospective, month_end("inc_end", -12)).otherwise(F.col("inc_end")).alias("inc_end_riskscr_features"),
        F.when(prospective, "Prospective").otherwise("Concurrent").alias("riskscr_period_type"),
    )


def windows_for(spark: SparkSession, settings: ReportSettings) -> DataFrame:
    """The run's window table: four rows per year of history."""
    return time_windows(run_parameters(spark, settings), settings.runout_months)


def open_window(spark: SparkSession, start: date, label: str = "all") -> DataFrame:
    """A single window without an end."""
    return spark.range(1).select(
        F.lit(label).alias("time_period"),
        F.lit(start).alias("inc_start"),
        F.lit(OPEN_END).alias("inc_end"),
        F.lit(OPEN_END).alias("paid_thru"),
    )


def widened(windows: DataFrame, days_before: int) -> DataFrame:
    """Same windows with an earlier start."""
    return windows.withColumn("inc_start", F.date_sub("inc_start", days_before))
