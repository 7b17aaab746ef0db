"""Service-line risk scores and the risk-adjusted benchmarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from popledger.functions.nulls import safe_ratio
from popledger.functions.text import same_ci
from popledger.operators.joins import reference
from popledger.operators.ordering import first_per_group
from popledger.plans.roster import scores_for_period_type
from popledger.settings import ReportSettings

# Component named by a line -> score column it selects.
COMPONENTS = {
    "RISKSCR_IP": "riskscr_ip",
    "RISKSCR_ER": "riskscr_er",
    "RISKSCR_OP": "riskscr_op",
    "RISKSCR_PHY": "riskscr_phy",
    "RISKSCR_RX": "riskscr_rx",
}
SCORES = ["riskscr_ip", "riskscr_er", "riskscr_op", "riskscr_phy", "riskscr_rx", "riskscr_other"]


def line_map(link: DataFrame, lob: str) -> DataFrame:
    """Service line -> reporting line for one line of business."""
    return link.where(same_ci("lob", lob)).select("mr_line", "mcrm_line")


def reporting_line_component(mr_line_info: DataFrame, link: DataFrame, lob: str) -> DataFrame:
    """One score component per reporting line: that of its first service line; the unassigned line takes 'other'."""
    pairs = line_map(link, lob).join(mr_line_info.select("mr_line", "riskscr_component"), "mr_line")
    first = first_per_group(pairs, ["mcrm_line"], ["mr_line"])
    chosen = F.when(same_ci("mcrm_line", "X99"), "riskscr_other")
    for name, column in COMPONENTS.items():
        chosen = chosen.when(same_ci("riskscr_component", name), column)
    return first.select("mcrm_line", chosen.otherwise("riskscr_other").alias("component"))


def riskscr_service(
    members: DataFrame,
    component_scores: DataFrame,
    windows: DataFrame,
    mr_line_info: DataFrame,
    link: DataFrame,
    calibrations: DataFrame,
    settings: ReportSettings,
) -> DataFrame:
    """Mean score by window, status and reporting line, weighted by member months.

    A member's score for a line depends on the line and on few facts of the member: the
    total score rounded to cents for calibrated members, the components for members
    scored by component, the score itself for the others. So members are summed over
    those facts first and meet the lines afterwards; members times lines never exists.
    """
    own = scores_for_period_type(component_scores, windows).select(
        "member_id", F.col("time_slice").alias("time_period"), *SCORES
    )
    kind = (
        F.when(same_ci("riskscr_1_type", settings.hcc_label), "calibrated")
        .when(same_ci("riskscr_1_type", settings.component_label), "component")
        .otherwise("plain")
    )
    rows = members.join(own, ["member_id", "time_period"], "left").select(
        "time_period", "elig_status_1", kind.alias("_kind"), "memmos", "riskscr_1", *SCORES
    )
    cents = F.when(F.col("_kind") == "calibrated", F.round("riskscr_1", 2))

    def weighted(c: str) -> list[Column]:
        return [
            F.sum(F.col(c) * F.col("memmos")).alias(f"x_{c}"),
            F.sum(F.when(F.col(c).isNotNull(), F.col("memmos"))).alias(f"w_{c}"),
        ]

    grain = rows.groupBy("time_period", "elig_status_1", "_kind", cents.alias("_cents")).agg(
        F.sum("memmos").alias("_w"), *[e for c in ["riskscr_1", *SCORES] for e in weighted(c)]
    )
    lines = reporting_line_component(mr_line_info, link, settings.lob)
    factors = calibrations.select(
        F.col("mcrm_line").alias("_line"), "hcc_range_bottom", "hcc_range_top", "factor_util", "factor_cost"
    )

    # grain is a few rows per window, status and cent
    crossed = grain.join(reference(lines))
    calibrated = crossed.join(
        reference(factors),
        (F.col("mcrm_line") == F.col("_line")) & F.col("_cents").between(F.col("hcc_range_bottom"), F.col("hcc_range_top")),
        "left",
    )

    def by_component(side: str) -> Column:
        chain = None
        for c in SCORES:
            test = F.col("component") == c
            value = F.col(f"{side}_{c}")
            chain = F.when(test, value) if chain is None else chain.when(test, value)
        return chain

    def side(factor: str) -> tuple[Column, Column]:
        is_cal, is_comp = F.col("_kind") == "calibrated", F.col("_kind") == "component"
        has = F.col(factor).isNotNull()
        total = (
            F.when(is_cal & has, F.col(factor) * F.col("_w"))
            .when(is_comp, by_component("x"))
            .otherwise(F.col("x_riskscr_1"))
        )
        weight = F.when(is_cal & has, F.col("_w")).when(is_comp, by_component("w")).otherwise(F.col("w_riskscr_1"))
        return total, weight

    util, util_w = side("factor_util")
    cost, cost_w = side("factor_cost")
    return calibrated.groupBy("time_period", "elig_status_1", "mcrm_line").agg(
        safe_ratio(F.sum(util), F.sum(util_w)).alias("riskscr_1_util_avg"),
        safe_ratio(F.sum(cost), F.sum(cost_w)).alias("riskscr_1_cost_avg"),
        F.sum(util_w).alias("memmos_sum"),
    )


def with_service_risk(df: DataFrame, riskscr: DataFrame) -> DataFrame:
    """Mean service scores next to rows that carry window, status and a possibly missing reporting line."""
    r = riskscr.select(
        F.col("time_period").alias("_rp"), F.col("elig_status_1").alias("_re"), F.col("mcrm_line").alias("_rm"),
        "riskscr_1_util_avg", "riskscr_1_cost_avg",
    )
    return df.join(
        r,
        (df["time_period"] == F.col("_rp")) & (df["elig_status_1"] == F.col("_re")) & df["mcrm_line"].eqNullSafe(F.col("_rm")),
        "left",
    ).drop("_rp", "_re", "_rm")


def cost_util_benchmark(
    members: DataFrame, ref_mcrm_line: DataFrame, benchmarks: DataFrame, riskscr: DataFrame, settings: ReportSettings
) -> DataFrame:
    """Published rates times the mean service score, for every window and status with members."""
    dims = members.select("time_period", "elig_status_1").distinct()
    rates = ref_mcrm_line.where(same_ci("lob", settings.lob)).select("lob", "mcrm_line").join(benchmarks, ["lob", "mcrm_line"])
    rows = with_service_risk(dims.join(reference(rates)), riskscr)
    util = F.coalesce("util_per1k", F.lit(0.0)) * F.col("riskscr_1_util_avg")
    return rows.select(
        F.lit(settings.client).alias("name_client"),
        "time_period",
        "mcrm_line",
        "elig_status_1",
        F.col("loosely_well").alias("type_benchmark"),
        F.col("riskscr_1_util_avg").alias("riskscr_service_avg_util"),
        F.col("riskscr_1_cost_avg").alias("riskscr_service_avg_cost"),
        F.when(F.col("admits_per1k").isNotNull(), F.col("admits_per1k") * F.col("riskscr_1_util_avg"))
        .otherwise(0.0)
        .alias("benchmark_discharges_per1k"),
        F.when(same_ci("util_type", "DAYS"), util).otherwise(0.0).alias("benchmark_days_per1k"),
        util.alias("benchmark_util_per1k"),
    )
