"""Members active at the end of each window, their attributes, and the counts by status."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from popledger.functions.dates import age_at, days_apart, whole_months
from popledger.functions.nulls import gt_missing, le_missing, safe_ratio
from popledger.functions.text import in_ci, same_ci, starts_ci
from popledger.operators.aggregate import freq, weighted_mean_all
from popledger.operators.claims import agg_claims
from popledger.operators.intervals import band_join, in_windows
from popledger.operators.windows import widened
from popledger.settings import ReportSettings

EOL_FLAGS = [
    "endoflife_numer_yn_chemolt14days", "endoflife_denom_yn_chemolt14days",
    "endoflife_numer_yn_hospicelt3day", "endoflife_denom_yn_hospicelt3day",
    "endoflife_numer_yn_hospicenever", "endoflife_denom_yn_hospicenever",
]


def member_roster(eligibility: DataFrame, member: DataFrame, windows: DataFrame) -> DataFrame:
    """Member and window for every assigned span that holds the window's last day."""
    assigned = eligibility.where(same_ci("assignment_indicator", "Y")).select(
        "member_id", "date_start", "date_end", "elig_status_1", "mem_prv_id_align", "prv_name_align"
    )
    active = in_windows(
        assigned,
        windows.select("time_period", "inc_end"),
        F.col("inc_end").between(F.col("date_start"), F.col("date_end")),
    ).drop("date_start", "date_end", "inc_end")
    types = member.select("member_id", F.col("risk_score_type").alias("riskscr_1_type"))
    return active.join(types, "member_id", "left")


def scores_for_period_type(component_scores: DataFrame, windows: DataFrame) -> DataFrame:
    """Component scores of the model that fits the window's period type (three-letter code in the model name)."""
    wanted = windows.select(
        F.col("time_period").alias("time_slice"), F.upper(F.substring("riskscr_period_type", 1, 3)).alias("_kind")
    )
    return (
        component_scores.withColumn("_kind", F.upper(F.substring("model_name", 3, 3)))
        .join(wanted, ["time_slice", "_kind"])
        .drop("_kind")
    )


def roster_with_months(eligibility: DataFrame, member: DataFrame, windows: DataFrame) -> DataFrame:
    """Roster, demographics and medical member months in one pass over the spans.

    Demographics join while the spans are still one row each and partitioned by member.
    Spans of a member do not overlap, so at most one of them holds a window's last day.
    """
    people = member.select(
        "member_id", "dob", "gender", "mem_name", F.col("risk_score_type").alias("riskscr_1_type")
    )
    attributes = ["elig_status_1", "mem_prv_id_align", "prv_name_align", "riskscr_1_type", "dob", "gender", "mem_name"]
    placed = in_windows(
        eligibility.join(people, "member_id", "left"),
        windows.select("time_period", "inc_start", "inc_end"),
        (F.col("date_start") <= F.col("inc_end")) & (F.col("date_end") >= F.col("inc_start")),
    )
    active = same_ci("assignment_indicator", "Y") & F.col("inc_end").between(F.col("date_start"), F.col("date_end"))
    months = F.when(
        same_ci("cover_medical", "Y"), whole_months(F.greatest("date_start", "inc_start"), F.least("date_end", "inc_end"))
    ).otherwise(0)
    per_window = placed.groupBy("member_id", "time_period", "inc_end").agg(
        F.sum(months.cast("double")).alias("memmos"), F.max(F.when(active, F.struct(*attributes))).alias("_who")
    )
    return per_window.where("_who is not null").select("member_id", "time_period", "inc_end", "memmos", "_who.*")


def members_all(
    roster: DataFrame, windows: DataFrame, hcc_results: DataFrame, component_scores: DataFrame, settings: ReportSettings
) -> DataFrame:
    """Roster with age and the chosen risk score, before the zero-month rows are dropped."""
    hcc = hcc_results.select(
        F.col("hicno").alias("member_id"), F.col("time_slice").alias("time_period"),
        "score_community", "score_new_enrollee", F.col("riskscr_mm").alias("_hcc_mm"),
    )
    component = scores_for_period_type(component_scores, windows).select(
        "member_id", F.col("time_slice").alias("time_period"), F.col("riskscr_tot").alias("_component")
    )
    is_hcc = same_ci("riskscr_1_type", settings.hcc_label)
    is_component = same_ci("riskscr_1_type", settings.component_label)
    joined = roster.join(hcc, ["member_id", "time_period"], "left").join(component, ["member_id", "time_period"], "left")
    return joined.select(
        "member_id", "time_period", "elig_status_1", "mem_prv_id_align", "prv_name_align", "riskscr_1_type",
        "dob",
        "gender",
        "mem_name",
        age_at("dob", "inc_end").alias("age"),
        "memmos",
        F.when(
            is_hcc,
            F.when(le_missing("_hcc_mm", 11), F.col("score_new_enrollee")).otherwise(F.col("score_community")),
        )
        .when(is_component, F.col("_component"))
        .alias("riskscr_1"),
        F.when(is_hcc, F.col("_hcc_mm")).when(is_component, F.col("memmos")).alias("riskscr_memmos"),
    )


def members(all_members: DataFrame) -> DataFrame:
    return all_members.where("memmos <> 0")


def decedents(
    members: DataFrame, windows: DataFrame, excluded: DataFrame, outclaims: DataFrame, basis: str = "discharge"
) -> DataFrame:
    """Members who died in a window they are rostered in, with their end-of-life facts.

    Claims are first summed per member, day, line and status, then matched to the death
    within a 30-day band.
    """
    death = F.col("death_date_excluded")
    dead = (
        members.select("member_id", "time_period")
        .join(windows.select("time_period", "inc_start", "inc_end"), "time_period")
        .join(excluded.withColumnRenamed("member_id_excluded", "member_id"), "member_id")
        .where(death.between(F.col("inc_start"), F.col("inc_end")))
        .select(
            "member_id",
            "time_period",
            *EOL_FLAGS,
            death.alias("_death"),
            F.when(
                F.abs(days_apart(death, "latest_hospice_date_discharge")) < 3,
                days_apart("latest_hospice_date_discharge", "latest_hospice_date_admit") + 1,
            ).otherwise(0).cast("bigint").alias("final_hospice_days"),
        )
    )
    # only members who died are needed from the claims
    theirs = outclaims.join(excluded.select(F.col("member_id_excluded").alias("member_id")), "member_id", "left_semi")
    spend = agg_claims(
        theirs, widened(windows, 90), ["member_id", "dischargestatus", "prm_todate", "prm_line"],
        basis=basis, measures={"prm_costs": "prm_costs"},
    )
    near = band_join(
        dead.select("member_id", "time_period", "_death"),
        spend,
        ["member_id", "time_period"],
        later="_death", earlier="prm_todate", low=0, high=30,
    )
    in_hospital = starts_ci("prm_line", "I") & ~in_ci("prm_line", ["I31"]) & (F.col("dischargestatus") == "20")
    facts = near.groupBy("member_id", "time_period").agg(
        F.sum("prm_costs").alias("_cost"), F.max(F.when(in_hospital, 1).otherwise(0)).alias("_hospital")
    )
    return dead.join(facts, ["member_id", "time_period"], "left").select(
        "member_id",
        "time_period",
        *EOL_FLAGS,
        "final_hospice_days",
        F.coalesce("_cost", F.lit(0)).cast("decimal(28,4)").alias("costs_final_30_days"),
        F.when(F.col("_hospital") == 1, "Y").otherwise("N").alias("deceased_hospital_yn"),
    )


def memcnt(members: DataFrame, decedents: DataFrame, client: str) -> DataFrame:
    """Counts and weighted means by window, status and end-of-life attributes."""
    gone = decedents.withColumn("_dead", F.lit(1))
    rows = members.join(gone, ["member_id", "time_period"], "left").select(
        "time_period",
        "elig_status_1",
        F.when(F.col("_dead").isNotNull(), "Y").otherwise("N").alias("deceased_yn"),
        F.coalesce("deceased_hospital_yn", F.lit("N")).alias("deceased_hospital_yn"),
        *[F.coalesce(c, F.lit("N")).alias(c) for c in EOL_FLAGS],
        F.coalesce("final_hospice_days", F.lit(0)).alias("final_hospice_days"),
        F.coalesce("costs_final_30_days", F.lit(0)).cast("decimal(28,4)").alias("_cost"),
        F.col("riskscr_1_type").alias("risk_score_type"),
        "memmos", "riskscr_1", "riskscr_memmos", "age",
    )
    keys = ["time_period", "elig_status_1", "deceased_yn", "deceased_hospital_yn", *EOL_FLAGS, "final_hospice_days", "risk_score_type"]
    credible = F.when(gt_missing("riskscr_memmos", 11), F.col("memmos")).otherwise(0.0)
    return (
        rows.groupBy(*keys)
        .agg(
            F.sum("_cost").alias("costs_final_30_days_sum"),
            F.sum("memmos").alias("riskscr_wgt"),
            weighted_mean_all("riskscr_1", "memmos").alias("riskscr_avg"),
            freq().alias("memcnt"),
            safe_ratio(F.sum(credible), F.sum("memmos")).alias("riskscr_cred"),
            weighted_mean_all("age", "memmos").alias("age_avg"),
        )
        .withColumn("name_client", F.lit(client))
    )
