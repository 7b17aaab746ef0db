"""Skilled-nursing stays: readmission windows, details, metrics and professional services."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from popledger.functions.nulls import safe_ratio
from popledger.functions.text import in_ci, same_ci, starts_ci
from popledger.operators.aggregate import sum_of_ratio, sum_where
from popledger.operators.claims import agg_claims
from popledger.operators.joins import with_flag
from popledger.operators.reshape import metrics_long
from popledger.operators.windows import open_window
from popledger.plans.lattice import ClaimLattice
from popledger.plans.risk import line_map, with_service_risk
from popledger.settings import ReportSettings

SNF_LINE = "I31"
# Ids and labels of the metrics.
LABELS = {
    "distinct_SNFs": "Number of Distinct SNFs Utilized",
    "SNF": "SNF Discharges",
    "SNF_rskadj": "SNF Admissions Risk Adjusted",
    "pct_SNF_costs": "SNF Costs as a Percentage of Total Costs",
    "alos": "SNF Average Length of Stay",
    "avg_cost_per_day": "Average Cost Per Day in SNF",
    "avg_cost_per_discharge": "Average Cost Per SNF Discharge",
    "number_SNF_over_21_days": "Count of SNF stays over 21 days",
    "number_SNF_readmit": "Count of SNF Discharges during an All-Cause IP Readmission Window",
}
PROFESSIONAL_LABELS = {
    "distinct_prof_SNFs": "Number of Distinct SNFs Utilized (Professional Services only)",
    "prof_SNF_costs": "Professional SNF Costs",
}
# Equipment and prosthetics lines counted with the professional services.
EQUIPMENT_LINES = ["P84", "P85"]


def open_inpatient_cases(outclaims: DataFrame, cases: DataFrame, settings: ReportSettings) -> DataFrame:
    """Inpatient cases by member and line over all time since the credible start, with case attributes."""
    window = open_window(outclaims.sparkSession, settings.credible_start)
    return agg_claims(
        outclaims, window, ["member_id", "prm_line", "caseadmitid"], where=starts_ci("prm_line", "I"),
        basis=settings.claims_basis, measures={}, cases=cases,
    )


def snf_readmissions(inpatient: DataFrame) -> DataFrame:
    """Skilled-nursing stays that end inside a failure window: from the last day of an index stay to the first day of its
    readmission, both included.

    One stream of the cases serves for all three parts. A case stands under its own id, and an index stay under its readmission's id as
    well, so the readmission's first day reaches it within that id. Then a member's windows and stays are put in the order of their
    days, and a stay is inside a window if any that began by its day ends on it or later.
    """
    event = lambda kind, key, day: F.struct(F.lit(kind).alias("kind"), F.col(key).alias("key"), F.col(day).alias("day"))
    index = ~same_ci("prm_line", SNF_LINE) & same_ci("prm_readmit_all_cause_yn", "Y")
    events = F.array_compact(F.array(
        event("readmission", "caseadmitid", "date_case_earliest"),
        F.when(index, event("window", "prm_readmit_all_cause_caseid", "date_case_latest")),
        F.when(same_ci("prm_line", SNF_LINE), event("stay", "caseadmitid", "date_case_latest")),
    ))
    stream = inpatient.select("member_id", F.explode(events).alias("e")).select("member_id", "e.*").distinct()
    begun = F.max(F.when(F.col("kind") == "readmission", F.col("day"))).over(Window.partitionBy("member_id", "key"))
    ordered = stream.withColumn("_end", F.when(F.col("kind") == "window", begun)).where("kind = 'stay' or (kind = 'window' and _end >= day)")
    # of one day, windows come before stays
    by_day = Window.partitionBy("member_id").orderBy("day", F.desc("kind")).rowsBetween(Window.unboundedPreceding, 0)
    reached = ordered.withColumn("_reach", F.max("_end").over(by_day))
    return reached.where("kind = 'stay' and _reach >= day").select("member_id", F.col("key").alias("caseadmitid")).distinct()


def details_snf_wide(
    medical: ClaimLattice, readmissions: DataFrame, link: DataFrame, riskscr: DataFrame, settings: ReportSettings
) -> DataFrame:
    """Stays by provider, readmission flag and length, with risk-adjusted sums."""
    active = medical.at(
        ["providerid", "member_id", "elig_status_1", "prm_line", "caseadmitid"], ["discharges", "prm_util", "prm_costs"],
        where=same_ci("prm_line", SNF_LINE),
    )
    flagged = with_flag(active, readmissions, ["member_id", "caseadmitid"], "snf_readmit_yn")
    mapped = flagged.join(line_map(link, settings.lob).withColumnRenamed("mr_line", "prm_line"), "prm_line", "left")
    keys = ["time_period", "elig_status_1", "prv_id_snf", "snf_readmit_yn", "los_snf"]
    # one risk value per window, status and reporting line: sum first, adjust afterwards
    by_line = mapped.groupBy(
        "time_period", "elig_status_1", F.coalesce("providerid", F.lit("Unknown")).alias("prv_id_snf"),
        "snf_readmit_yn", F.col("prm_util").alias("los_snf"), "mcrm_line",
    ).agg(F.sum("discharges").alias("_d"), F.sum("prm_util").alias("_u"), F.sum("prm_costs").alias("_c"))
    return with_service_risk(by_line, riskscr).groupBy(*keys).agg(
        F.sum("_d").alias("cnt_discharges_snf"),
        F.sum("_u").alias("sum_days_snf"),
        F.sum("_c").alias("sum_costs_snf"),
        sum_of_ratio("_d", "riskscr_1_util_avg").alias("cnt_discharges_snf_riskadj"),
        sum_of_ratio("_u", "riskscr_1_util_avg").alias("sum_days_snf_riskadj"),
        sum_of_ratio("_c", "riskscr_1_cost_avg").alias("sum_costs_snf_riskadj"),
    ).withColumn("name_client", F.lit(settings.client))


def metrics_snf(details: DataFrame, basic: DataFrame, client: str) -> DataFrame:
    """Metrics for windows and statuses with discharges and days."""
    sums = details.groupBy("time_period", "elig_status_1").agg(
        F.countDistinct("prv_id_snf").alias("distinct_SNFs"),
        F.sum("cnt_discharges_snf").alias("SNF"),
        F.sum("cnt_discharges_snf_riskadj").alias("SNF_rskadj"),
        F.sum("sum_costs_snf").alias("_cost"),
        F.sum("sum_days_snf").alias("_days"),
        sum_where(F.col("los_snf") > 21, "cnt_discharges_snf").alias("number_SNF_over_21_days"),
        sum_where(F.col("snf_readmit_yn") == "Y", "cnt_discharges_snf").alias("number_SNF_readmit"),
    ).where("SNF > 0 and _days > 0")
    totals = basic.select("time_period", "elig_status_1", "prm_costs_sum_all_services")
    wide = sums.join(totals, ["time_period", "elig_status_1"], "left").withColumns({
        "pct_SNF_costs": safe_ratio("_cost", "prm_costs_sum_all_services"),
        "alos": safe_ratio("_days", "SNF"),
        "avg_cost_per_day": safe_ratio("_cost", "_days"),
        "avg_cost_per_discharge": safe_ratio("_cost", "SNF"),
    })
    return metrics_long(wide, ["time_period", "elig_status_1"], LABELS).withColumns(
        {"name_client": F.lit(client), "metric_category": F.lit("SNF")}
    )


def snf_professional_claims(medical: ClaimLattice, mr_line_info: DataFrame) -> DataFrame:
    """Rostered members' professional lines whose facility case is a skilled-nursing case of the same member and window."""
    facility = medical.at(["caseadmitid", "member_id"], [], where=same_ci("prm_line", SNF_LINE), needs=["prm_line"])
    facility = facility.select("member_id", "time_period", F.col("caseadmitid").alias("facilitycaseid"))
    lines = medical.at(
        ["providerid", "member_id", "elig_status_1", "prm_line", "facilitycaseid"], ["prm_costs"], where=starts_ci("prm_line", "P")
    )
    allowed = mr_line_info.where(same_ci("prm_line_desc1", "PROF") | in_ci("mr_line", EQUIPMENT_LINES)).select(
        F.col("mr_line").alias("prm_line")
    )
    return lines.join(facility, ["facilitycaseid", "member_id", "time_period"]).join(allowed, "prm_line")


def details_snf_professional(
    professional: DataFrame, link: DataFrame, riskscr: DataFrame, settings: ReportSettings
) -> DataFrame:
    mapped = professional.join(line_map(link, settings.lob).withColumnRenamed("mr_line", "prm_line"), "prm_line", "left")
    by_line = mapped.groupBy(
        "time_period", "elig_status_1", F.coalesce("providerid", F.lit("Unknown")).alias("prv_id_snf"), "mcrm_line"
    ).agg(F.sum("prm_costs").alias("_c"))
    return with_service_risk(by_line, riskscr).groupBy("time_period", "elig_status_1", "prv_id_snf").agg(
        F.sum("_c").alias("sum_costs_prof_snf"),
        sum_of_ratio("_c", "riskscr_1_cost_avg").alias("sum_costs_prof_snf_riskadj"),
    ).withColumn("name_client", F.lit(settings.client))


def metrics_snf_professional(details: DataFrame, client: str) -> DataFrame:
    wide = details.groupBy("time_period", "elig_status_1").agg(
        F.countDistinct("prv_id_snf").alias("distinct_prof_SNFs"), F.sum("sum_costs_prof_snf").alias("prof_SNF_costs")
    )
    return metrics_long(wide, ["time_period", "elig_status_1"], PROFESSIONAL_LABELS).withColumns(
        {"name_client": F.lit(client), "metric_category": F.lit("SNF")}
    )
