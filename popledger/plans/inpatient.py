"""Inpatient details and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from popledger.functions.nulls import null_safe_join, safe_ratio
from popledger.functions.text import has_phrase, in_ci, letters_only, same_ci, starts_ci, word_at
from popledger.operators.aggregate import remerge_distinct, sum_where
from popledger.operators.claims import MEASURES, agg_claims, with_cases
from popledger.operators.ordering import latest
from popledger.operators.reshape import metrics_long, stack
from popledger.plans.lattice import ClaimLattice
from popledger.plans.risk import line_map, with_service_risk
from popledger.settings import ReportSettings

# Admission-quality codes of the combined indicator.
COMBINED_PQI = [
    "PQI01", "PQI03", "PQI05", "PQI07", "PQI08", "PQI10",
    "PQI11", "PQI12", "PQI13", "PQI14", "PQI15", "PQI16",
]
# Ids and labels of the inpatient metrics.
LABELS = {
    "pqi": "PQI Combined (Chronic and Acute) Admits",
    "pref_sens": "Preference Sensitive Admits",
    "Num_1_Day_LOS": "Number of One Day LOSs",
    "Denom_1_Day_LOS": "Number of inpatient discharges",
    "Num_1_Day_LOS_Medical": "Number of Medical One Day LOSs",
    "Denom_1_day_LOS_Medical": "Number of medical inpatient discharges",
    "pct_acute_IP_costs": "Acute Inpatient Costs as a Percentage of Total Costs",
    "pct_IP_disch_to_SNF": "Percentage of IP Stays Discharged to SNF",
    "pct_ip_readmits": "Percentage of IP discharges with an all cause readmission within 30 days",
    "cnt_ip_readmits": "Number of IP discharges with an all cause readmission within 30 days",
    "cnt_pot_readmits": "Number of IP discharges with the potential for readmission",
    "acute": "Acute Discharges",
    "acute_riskadj": "Acute Discharges Risk Adjusted",
    "surgical": "Surgical Discharges",
    "surgical_riskadj": "Surgical Discharges Risk Adjusted",
    "medical": "Medical Discharges",
    "medical_riskadj": "Medical Discharges Risk Adjusted",
    "medical_general": "General Medical Discharges",
    "medical_general_riskadj": "General Medical Discharges Risk Adjusted",
}
DETAIL_KEYS = [
    "time_period", "elig_status_1", "prv_id_inpatient", "discharge_status_code", "discharge_status_desc",
    "drg_inpatient", "drg_version_inpatient", "acute_yn", "medical_surgical", "inpatient_pqi_yn", "prm_ahrq_pqi",
    "inpatient_discharge_to_snf_yn", "preference_sensitive_yn", "prm_pref_sensitive_category",
    "inpatient_readmit_potential_yn", "inpatient_readmit_yn", "los_inpatient",
]
DETAIL_FACTS = ["cnt_discharges_inpatient", "sum_days_inpatient", "sum_costs_inpatient"]


def is_acute_line() -> Column:
    return starts_ci("prm_line", "I") & ~same_ci("prm_line", "I31")


# what an inpatient row is: a case of a member under one line, status, provider and unit type
STAY = ["prm_line", "caseadmitid", "member_id", "dischargestatus", "providerid", "prm_util_type"]
STAY_MEASURES = ["discharges", "prm_util", "prm_costs"]


def inpatient_claims(outclaims: DataFrame, cases: DataFrame, windows: DataFrame, settings: ReportSettings) -> DataFrame:
    """Acute inpatient lines of all members per window and stay, with case attributes."""
    return agg_claims(
        outclaims, windows, STAY, where=is_acute_line(), basis=settings.claims_basis,
        measures={m: MEASURES[m] for m in STAY_MEASURES}, cases=cases,
    )


def rostered_stays(medical: ClaimLattice, cases: DataFrame) -> DataFrame:
    """The same for rostered members, with the member's status."""
    return with_cases(medical.at([*STAY, "elig_status_1"], STAY_MEASURES, where=is_acute_line()), cases)


def with_discharge_text(claims: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """The text of the discharge code, as the site's file has it; 'Other' for a code that the file does not name. Codes repeated in the
    file do not multiply claims."""
    texts = crosswalk.groupBy("dischargestatus").agg(F.max("discharge_status_desc").alias("discharge_status_desc"))
    named = claims.join(texts, "dischargestatus", "left")
    return named.withColumn("discharge_status_desc", F.coalesce("discharge_status_desc", F.lit("Other")))


def partial_details(claims: DataFrame, link: DataFrame, crosswalk: DataFrame, settings: ReportSettings) -> DataFrame:
    """Stays of rostered members summed over everything the details and the metrics need."""
    lines = line_map(link, settings.lob).withColumnRenamed("mr_line", "prm_line")
    yn = lambda test: F.when(test, "Y").otherwise("N")
    rows = with_discharge_text(claims, crosswalk).join(lines, "prm_line", "left").select(
        "time_period",
        "elig_status_1",
        F.coalesce("providerid", F.lit("Unknown")).alias("prv_id_inpatient"),
        F.col("dischargestatus").alias("discharge_status_code"),
        "discharge_status_desc",
        F.col("prm_drg").alias("drg_inpatient"),
        F.col("prm_drgversion").alias("drg_version_inpatient"),
        yn(~same_ci("prm_line", "I31")).alias("acute_yn"),
        F.when(starts_ci("prm_line", "I11"), "Medical")
        .when(starts_ci("prm_line", "I12"), "Surgical")
        .otherwise("None")
        .alias("medical_surgical"),
        yn(in_ci("prm_ahrq_pqi", COMBINED_PQI)).alias("inpatient_pqi_yn"),
        "prm_ahrq_pqi",
        yn(F.col("dischargestatus") == "03").alias("inpatient_discharge_to_snf_yn"),
        yn(
            same_ci("prm_pref_sensitive_included_yn", "Y")
            & ~F.upper("prm_pref_sensitive_category").eqNullSafe(F.lit("NOT PSA"))
        ).alias("preference_sensitive_yn"),
        "prm_pref_sensitive_category",
        F.col("prm_readmit_potential_yn").alias("inpatient_readmit_potential_yn"),
        F.col("prm_readmit_all_cause_yn").alias("inpatient_readmit_yn"),
        F.col("prm_util").alias("los_inpatient"),
        "mcrm_line",
        "prm_line",
        "discharges", "prm_util", "prm_costs",
    )
    return rows.groupBy(*DETAIL_KEYS, "mcrm_line", "prm_line").agg(
        F.sum("discharges").alias("cnt_discharges_inpatient"),
        F.sum("prm_util").alias("sum_days_inpatient"),
        F.sum("prm_costs").alias("sum_costs_inpatient"),
    )


def details_inpatient(partial: DataFrame, client: str) -> DataFrame:
    return partial.groupBy(*DETAIL_KEYS).agg(*[F.sum(c).alias(c) for c in DETAIL_FACTS]).withColumn("name_client", F.lit(client))


def inpatient_measures(partial: DataFrame, basic: DataFrame, riskscr: DataFrame) -> DataFrame:
    """One row per window and status with the named inpatient metrics."""
    # the metrics need few of the detail keys: sum to those before the risk join
    small = partial.groupBy(
        "time_period", "elig_status_1", "mcrm_line", "prm_line", "acute_yn", "medical_surgical", "inpatient_pqi_yn",
        "preference_sensitive_yn", "inpatient_discharge_to_snf_yn", "inpatient_readmit_yn", "inpatient_readmit_potential_yn",
        (F.col("los_inpatient") == 1).alias("_one_day"),
    ).agg(F.sum("cnt_discharges_inpatient").alias("_n"), F.sum("sum_costs_inpatient").alias("_cost"))
    rows = with_service_risk(small, riskscr).withColumn("_adj", safe_ratio("_n", "riskscr_1_util_avg"))
    medical, surgical = same_ci("medical_surgical", "Medical"), same_ci("medical_surgical", "Surgical")
    acute = F.col("acute_yn") == "Y"
    general = same_ci("prm_line", "I11a")
    count = lambda test: sum_where(test, "_n")
    # a row without a score has no adjusted count; it adds nothing
    adjusted = lambda test: F.sum(F.when(test, F.col("_adj")).otherwise(F.lit(0.0)))
    readmit, potential = same_ci("inpatient_readmit_yn", "Y"), same_ci("inpatient_readmit_potential_yn", "Y")
    wide = rows.groupBy("time_period", "elig_status_1").agg(
        count(F.col("inpatient_pqi_yn") == "Y").alias("pqi"),
        count(F.col("preference_sensitive_yn") == "Y").alias("pref_sens"),
        count(F.col("_one_day")).alias("Num_1_Day_LOS"),
        F.sum("_n").alias("Denom_1_Day_LOS"),
        count(medical & F.col("_one_day")).alias("Num_1_Day_LOS_Medical"),
        count(medical).alias("Denom_1_day_LOS_Medical"),
        sum_where(acute, "_cost").alias("_acute_cost"),
        count(F.col("inpatient_discharge_to_snf_yn") == "Y").alias("_to_snf"),
        count(readmit).alias("cnt_ip_readmits"),
        count(potential).alias("cnt_pot_readmits"),
        count(acute).alias("acute"),
        adjusted(acute).alias("acute_riskadj"),
        count(surgical).alias("surgical"),
        adjusted(surgical).alias("surgical_riskadj"),
        count(medical).alias("medical"),
        adjusted(medical).alias("medical_riskadj"),
        count(general).alias("medical_general"),
        adjusted(general).alias("medical_general_riskadj"),
    )
    totals = basic.select("time_period", "elig_status_1", "prm_costs_sum_all_services")
    return wide.join(totals, ["time_period", "elig_status_1"], "left").withColumns({
        "pct_acute_IP_costs": safe_ratio("_acute_cost", "prm_costs_sum_all_services"),
        "pct_IP_disch_to_SNF": safe_ratio("_to_snf", "Denom_1_Day_LOS"),
        "pct_ip_readmits": safe_ratio("cnt_ip_readmits", "cnt_pot_readmits"),
    })


def metrics_inpatient(partial: DataFrame, basic: DataFrame, riskscr: DataFrame, client: str) -> DataFrame:
    """Named metrics, one count per admission-quality code and one per preference category."""
    ids = ["time_period", "elig_status_1"]
    named = metrics_long(inpatient_measures(partial, basic, riskscr), ids, LABELS)
    admits = F.sum("cnt_discharges_inpatient").cast("double").alias("metric_value")
    pqi = (
        partial.where("inpatient_pqi_yn = 'Y'").groupBy(*ids, "prm_ahrq_pqi").agg(admits)
        .withColumns({
            "metric_id": F.concat("prm_ahrq_pqi", F.lit("_admits")),
            "metric_name": F.concat_ws(" ", F.lit("Admits for"), "prm_ahrq_pqi"),
        })
        .drop("prm_ahrq_pqi")
    )
    category = F.col("prm_pref_sensitive_category")
    psa = (
        partial.where("preference_sensitive_yn = 'Y'")
        .groupBy(
            *ids,
            F.lower(F.concat(F.lit("psa_admits_"), letters_only(category))).alias("metric_id"),
            F.concat_ws(" ", F.lit("Admits for PSA -"), category).alias("metric_name"),
        )
        .agg(admits)
    )
    return stack([named, pqi, psa]).withColumns({"name_client": F.lit(client), "metric_category": F.lit("Inpatient")})


def heart_failure_by_mem(claims: DataFrame, members: DataFrame, legend: DataFrame, client: str) -> DataFrame:
    """Latest window: members with at least one discharge for the heart-failure code, most discharges first."""
    newest = latest(claims, "time_period").where(same_ci("prm_ahrq_pqi", "PQI08"))
    rows = newest.join(members.select("member_id", "time_period", "elig_status_1"), ["member_id", "time_period"]).join(
        legend, "prm_ahrq_pqi", "left"
    )
    counted = remerge_distinct(rows, ["time_period", "member_id"], ["elig_status_1", "pqi_full_desc"], {"case_count": "discharges"})
    return counted.where("case_count > 0").select(
        F.lit(client).alias("name_client"), "time_period", "member_id", "elig_status_1", "pqi_full_desc", "case_count"
    )


def metrics_discharge_status(details: DataFrame, client: str) -> DataFrame:
    """Discharges by the last word of the status text; home health is kept whole and the dead are one group."""
    last_word = word_at("discharge_status_desc", -1)
    metric = F.when(has_phrase("discharge_status_desc", "Home Health"), "discharge_to_home_health").otherwise(
        F.concat(F.lit("discharge_to_"), F.when(last_word == "Died", "death").otherwise(F.lower(last_word)))
    )
    return (
        details.groupBy("time_period", "elig_status_1", metric.alias("metric_id"))
        .agg(F.sum("cnt_discharges_inpatient").cast("double").alias("metric_value"))
        .withColumns({
            "name_client": F.lit(client),
            "metric_category": F.lit("discharge_status"),
            "metric_name": F.concat_ws(" ", F.lit("Count of Inpatient Discharges with"), "metric_id", F.lit("status")),
        })
    )
