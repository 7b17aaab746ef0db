"""End-of-life metrics from the member counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from popledger.functions.nulls import safe_ratio
from popledger.operators.aggregate import sum_where
from popledger.operators.reshape import metrics_long

# Ids and labels of the metrics.
LABELS = {
    "mortality_rate": "Mortality Rate",
    "decedent_count": "Number of Deaths",
    "rsk_adj_mortality_rate": "Risk Adjusted Mortality Rate",
    "rsk_adj_decedent_count": "Risk Adjusted Number of Deaths",
    "avg_cost_final_30days": "Average Cost in 30 Days Prior to Death",
    "tot_cost_final_30days": "Total Cost in 30 Days Prior to Death",
    "avg_cost_final_30days_riskadj": "Average Cost in 30 Days Prior to Death, Risk Adjusted",
    "tot_cost_final_30days_riskadj": "Total Cost in 30 Days Prior to Death, Risk Adjusted",
    "pct_death_in_hosp": "Percentage of Deaths in Hospital",
    "cnt_death_in_hosp": "Count of Deaths in Hospital",
    "pct_chemo": "Percentage of Cancer Decedents Recieving Chemotherapy Within 14 Days of Death",
    "cnt_chemo": "Count of Cancer Decedents Recieving Chemotherapy Within 14 Days of Death",
    "cnt_cancer": "Count of Cancer Decedents",
    "cnt_cancer_hospice": "Count of Cancer Decedents Admitted to Hospice",
    "pct_cancer_hospice_lt3days": "Percentage of Cancer Decedents Admitted to Hospice for Less Than 3 Days",
    "cnt_cancer_hospice_lt3days": "Count of Cancer Decedents Admitted to Hospice for Less Than 3 Days",
    "pct_cancer_hospice_never": "Percentage of Cancer Decedents Never Admitted to Hospice",
    "cnt_cancer_hospice_never": "Count of Cancer Decedents Never Admitted to Hospice",
    "pct_hospice_lt3days": "Percentage of Hospice Decedents Admitted to Hospice for Less Than 3 Days",
    "cnt_hospice_lt3days": "Count of Hospice Decedents Admitted to Hospice for Less Than 3 Days",
    "pct_hospice_never": "Percentage of Decedents Never Admitted to Hospice",
    "cnt_hospice_never": "Count of Decedents Never Admitted to Hospice",
    "pct_hospice_gt_6months": "Percentage of Decedents in Hospice Over 6 Months",
    "cnt_hospice_gt_6months": "Count of Decedents in Hospice Over 6 Months",
}
HALF_YEAR = 365.25 / 2


def eol_measures(memcnt: DataFrame, basic: DataFrame) -> DataFrame:
    """Wide form: one row per window and status."""
    dead = F.col("deceased_yn") == "Y"
    days = F.col("final_hospice_days")
    yes = lambda c: F.col(c) == "Y"
    n = lambda test: sum_where(test, "memcnt")
    sums = memcnt.groupBy("time_period", "elig_status_1").agg(
        F.sum("memcnt").alias("_all"),
        n(dead).alias("decedent_count"),
        sum_where(dead, "costs_final_30_days_sum").alias("tot_cost_final_30days"),
        n(dead & yes("deceased_hospital_yn")).alias("cnt_death_in_hosp"),
        n(yes("endoflife_numer_yn_chemolt14days")).alias("cnt_chemo"),
        n(yes("endoflife_denom_yn_chemolt14days")).alias("cnt_cancer"),
        n(yes("endoflife_denom_yn_hospicelt3day")).alias("cnt_cancer_hospice"),
        n(yes("endoflife_numer_yn_hospicelt3day")).alias("cnt_cancer_hospice_lt3days"),
        n(yes("endoflife_numer_yn_hospicenever")).alias("cnt_cancer_hospice_never"),
        n(yes("endoflife_denom_yn_hospicenever")).alias("_never_base"),
        n((days > 0) & (days < 3)).alias("cnt_hospice_lt3days"),
        n(days > 0).alias("_hospice"),
        n(dead & (days == 0)).alias("cnt_hospice_never"),
        n(days > HALF_YEAR).alias("cnt_hospice_gt_6months"),
    )
    scored = sums.join(basic.select("time_period", "elig_status_1", "riskscr_1_avg"), ["time_period", "elig_status_1"], "left")
    ratios = {
        "mortality_rate": ("decedent_count", "_all"),
        "rsk_adj_decedent_count": ("decedent_count", "riskscr_1_avg"),
        "avg_cost_final_30days": ("tot_cost_final_30days", "decedent_count"),
        "tot_cost_final_30days_riskadj": ("tot_cost_final_30days", "riskscr_1_avg"),
        "pct_death_in_hosp": ("cnt_death_in_hosp", "decedent_count"),
        "pct_chemo": ("cnt_chemo", "cnt_cancer"),
        "pct_cancer_hospice_lt3days": ("cnt_cancer_hospice_lt3days", "cnt_cancer_hospice"),
        "pct_cancer_hospice_never": ("cnt_cancer_hospice_never", "_never_base"),
        "pct_hospice_lt3days": ("cnt_hospice_lt3days", "_hospice"),
        "pct_hospice_never": ("cnt_hospice_never", "decedent_count"),
        "pct_hospice_gt_6months": ("cnt_hospice_gt_6months", "decedent_count"),
    }
    first = scored.withColumns({name: safe_ratio(a, b) for name, (a, b) in ratios.items()})
    return first.withColumns({
        "rsk_adj_mortality_rate": safe_ratio("mortality_rate", "riskscr_1_avg"),
        "avg_cost_final_30days_riskadj": safe_ratio("avg_cost_final_30days", "riskscr_1_avg"),
    })


def metrics_endoflife(memcnt: DataFrame, basic: DataFrame, client: str) -> DataFrame:
    """Long form; metrics without a value are left out."""
    long = metrics_long(eol_measures(memcnt, basic), ["time_period", "elig_status_1"], LABELS)
    return long.where(F.col("metric_value").isNotNull()).withColumns(
        {"name_client": F.lit(client), "metric_category": F.lit("end_of_life")}
    )
