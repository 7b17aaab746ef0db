"""Overlap between the assignment roster and the claims feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from popledger.functions.text import same_ci
from popledger.operators.aggregate import freq, share_of_rows
from popledger.operators.intervals import in_windows, nearest_day
from popledger.operators.joins import crosswalk
from popledger.operators.ordering import latest
from popledger.operators.reshape import stack


def assigned_by_period(client_member_time: DataFrame, xref: DataFrame, windows: DataFrame) -> DataFrame:
    """Assigned members (current id) and the windows whose last day their span holds."""
    assigned = client_member_time.where(same_ci("assignment_indicator", "Y")).select("member_id", "date_start", "date_end")
    current = crosswalk(assigned, "member_id", xref, "prvs_hic_num", "crnt_hic_num")
    return in_windows(
        current,
        windows.select("time_period", "inc_end"),
        F.col("inc_end").between(F.col("date_start"), F.col("date_end")),
    ).select("member_id", "time_period")


def feed_by_period(
    raw_stack: DataFrame, xref: DataFrame, eligibility: DataFrame, windows: DataFrame
) -> DataFrame:
    """Feed members per window, taken from the snapshot nearest to the window's end."""
    ends = windows.select("time_period", "inc_end")
    chosen = nearest_day(ends, "inc_end", raw_stack, "date_latestpaid")
    # a snapshot may serve several windows; the table of chosen days has one row per window
    picked = raw_stack.join(chosen, "date_latestpaid")
    current = crosswalk(
        picked.select(F.col("bene_hic_num").alias("member_id"), "time_period", "inc_end", "bene_death_dt"),
        "member_id", xref, "prvs_hic_num", "crnt_hic_num",
    )
    people = current.groupBy("member_id", "time_period", "inc_end").agg(F.max("bene_death_dt").alias("_death"))
    # the question is only which span holds a window's last day: spans meet the few windows, not the months they touch
    status = in_windows(
        eligibility.select("member_id", "date_start", "date_end", "elig_status_1"), ends,
        F.col("inc_end").between(F.col("date_start"), F.col("date_end")),
    ).select("member_id", "time_period", "elig_status_1")
    return (
        people.join(status, ["member_id", "time_period"], "left")
        .groupBy("member_id", "elig_status_1", "time_period")
        .agg(F.max(F.when(F.col("_death").isNotNull(), 1).otherwise(0)).alias("died_in_period"))
    )


def roster_overlap(assigned: DataFrame, feed: DataFrame, client: str) -> DataFrame:
    """Three metrics: feed members found in assignment, share of assigned members found in the feed, assigned members."""
    # fixed values: ids and display names of the metrics
    names = {
        "cnt_cclf_mems_in_assignment": "Count of CCLF Members with Assignment Information",
        "pct_assigned_mems_in_cclf": "Percent of Assigned Members with CCLF Information",
        "cnt_assigned_mems": "Count of Assigned Members",
    }
    both = ["time_period", "member_id"]
    mark_a = assigned.select(*both).distinct().withColumn("_in", F.lit(1))
    mark_f = feed.select(*both).distinct().withColumn("_in", F.lit(1))
    found = (
        feed.where("died_in_period = 0").join(mark_a, both, "left")
        .groupBy("time_period", "elig_status_1")
        .agg(F.sum(F.coalesce("_in", F.lit(0))).cast("double").alias("metric_value"))
        .withColumn("metric_id", F.lit("cnt_cclf_mems_in_assignment"))
    )
    per_period = assigned.join(mark_f, both, "left").groupBy("time_period").agg(
        share_of_rows(F.col("_in").isNotNull()).alias("pct_assigned_mems_in_cclf"),
        freq().cast("double").alias("cnt_assigned_mems"),
    )
    sides = per_period.unpivot(
        ["time_period"], ["pct_assigned_mems_in_cclf", "cnt_assigned_mems"], "metric_id", "metric_value"
    ).withColumn("elig_status_1", F.lit("All"))
    labels = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return stack([found, sides]).select(
        F.lit(client).alias("name_client"), "time_period", "elig_status_1",
        F.lit("Basic").alias("metric_category"), "metric_id",
        F.element_at(labels, F.col("metric_id")).alias("metric_name"), "metric_value",
    )


# Share that is plausible, lower bound left out, upper bound; of assigned members the upper bound is left out too.
FEED_LIMITS = (0.1, 1.0)
ASSIGNED_LIMITS = (0.2, 1.0)


def overlap_limits(assigned: DataFrame, feed: DataFrame) -> DataFrame:
    """Both shares of the overlap in the newest window, each with whether it is plausible: of living feed members found in assignment,
    by status, and of assigned members found in the feed."""
    both = ["time_period", "member_id"]
    share = share_of_rows(F.col("_in").isNotNull()).alias("value")
    mark = lambda df: df.select(*both).distinct().withColumn("_in", F.lit(1))
    newest_feed = latest(feed.where("died_in_period = 0"), "time_period")
    in_assignment = newest_feed.join(mark(assigned), both, "left").groupBy("time_period", "elig_status_1").agg(share)
    in_feed = latest(assigned, "time_period").join(mark(feed), both, "left").groupBy("time_period").agg(share)
    value = F.round("value", 4)
    return stack([
        in_assignment.select(F.lit("feed_in_assignment").alias("measure"), "time_period", "elig_status_1", "value",
                             ((value > FEED_LIMITS[0]) & (value <= FEED_LIMITS[1])).alias("plausible")),
        in_feed.select(F.lit("assigned_in_feed").alias("measure"), "time_period", F.lit("All").alias("elig_status_1"), "value",
                       ((value > ASSIGNED_LIMITS[0]) & (value < ASSIGNED_LIMITS[1])).alias("plausible")),
    ])
