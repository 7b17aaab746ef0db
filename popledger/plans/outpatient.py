"""Outpatient and office metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from popledger.functions.nulls import safe_ratio
from popledger.functions.text import in_ci, same_ci, starts_ci
from popledger.operators.aggregate import sum_of_ratio, sum_where
from popledger.operators.reshape import pivot_ids, stack
from popledger.plans.lattice import ClaimLattice
from popledger.plans.risk import line_map, with_service_risk
from popledger.settings import ReportSettings

# Lines of a metric (whole code or prefix), its id and its name; the first match counts.
LINE_METRICS = [
    ("in", ["O14A", "O14B", "O14C"], "high_tech_imaging", "High Tech Imaging Utilization"),
    ("in", ["O10"], "observation_stays", "Observation Stays Utilization"),
    ("prefix", ["P57"], "hi_tec_img_fop", "FOP High Tech Imaging Procedure Utilization"),
    ("prefix", ["P59"], "hi_tec_img_office", "Office High Tech Imaging Procedure Utilization"),
    ("prefix", ["P33"], "urgent_care_prof", "Office Urgent Care Visits"),
    ("prefix", ["P32"], "office_visits", "Office Visits"),
]
PCP_ID = "pct_office_visits_pcp"
PCP_NAME = "% Primary Care Office Visits"


def wanted_lines() -> Column:
    """Lines any outpatient metric reads."""
    return (
        starts_ci("prm_line", "O")
        | in_ci("prm_line", ["P32c", "P32d"])
        | starts_ci("prm_line", "P57")
        | starts_ci("prm_line", "P59")
        | starts_ci("prm_line", "P33")
    )


def line_metrics(mr_line_info: DataFrame) -> DataFrame:
    """Service line -> metric, for the lines that belong to one; the others drop out."""
    def test(kind: str, codes: list[str]) -> Column:
        if kind == "in":
            return in_ci("mr_line", codes)
        return starts_ci("mr_line", codes[0])

    pick_id = pick_name = None
    for kind, codes, metric_id, name in LINE_METRICS:
        t = test(kind, codes)
        pick_id = F.when(t, metric_id) if pick_id is None else pick_id.when(t, metric_id)
        pick_name = F.when(t, name) if pick_name is None else pick_name.when(t, name)
    return mr_line_info.select(
        "mr_line", "costmodel_util", pick_id.alias("metric_id"), pick_name.alias("metric_name")
    ).where(F.col("metric_id").isNotNull())


def util_types_per_metric(lines: DataFrame) -> DataFrame:
    """Largest number of unit types mixed in one metric; 1 when all is well."""
    return lines.groupBy("metric_id").agg(F.countDistinct("costmodel_util").alias("_n")).agg(
        F.max("_n").alias("max_util_types")
    )


def outpatient_claims(medical: ClaimLattice) -> DataFrame:
    """Utilisation of rostered members by window, status and line."""
    return medical.at(["elig_status_1", "prm_line"], ["prm_util"], where=wanted_lines())


def pct_office_visits(claims: DataFrame) -> DataFrame:
    office = claims.where(in_ci("prm_line", ["P32c", "P32d"]))
    return office.groupBy("time_period", "elig_status_1").agg(
        safe_ratio(sum_where(same_ci("prm_line", "P32c"), "prm_util"), F.sum("prm_util")).alias("metric_value")
    ).withColumns({"metric_id": F.lit(PCP_ID), "metric_name": F.lit(PCP_NAME)})


def util_rates(
    claims: DataFrame, lines: DataFrame, link: DataFrame, riskscr: DataFrame, basic_metrics: DataFrame, settings: ReportSettings
) -> DataFrame:
    """Each utilisation metric as a raw and a risk-adjusted row."""
    named = claims.join(lines.select(F.col("mr_line").alias("prm_line"), "metric_id", "metric_name"), "prm_line")
    mapped = named.join(line_map(link, settings.lob).withColumnRenamed("mr_line", "prm_line"), "prm_line", "left")
    by_line = mapped.groupBy("time_period", "elig_status_1", "metric_id", "metric_name", "mcrm_line").agg(
        F.sum("prm_util").alias("_util")
    )
    summed = with_service_risk(by_line, riskscr).groupBy("time_period", "elig_status_1", "metric_id", "metric_name").agg(
        F.sum("_util").cast("double").alias("_raw"), sum_of_ratio("_util", "riskscr_1_util_avg").alias("_adj")
    )
    pair = F.array(
        F.struct(F.col("metric_id").alias("id"), F.col("metric_name").alias("name"), F.col("_raw").alias("value")),
        F.struct(
            F.concat_ws("_", "metric_id", F.lit("riskadj")).alias("id"),
            F.concat_ws(", ", "metric_name", F.lit("Risk Adjusted")).alias("name"),
            F.col("_adj").alias("value"),
        ),
    )
    return summed.select("time_period", "elig_status_1", F.explode(pair).alias("m")).select(
        "time_period", "elig_status_1", F.col("m.id").alias("metric_id"), F.col("m.name").alias("metric_name"),
        F.col("m.value").alias("metric_value"),
    )


def metrics_outpatient(
    claims: DataFrame, mr_line_info: DataFrame, link: DataFrame, riskscr: DataFrame, basic_metrics: DataFrame, settings: ReportSettings
) -> DataFrame:
    rates = util_rates(claims, line_metrics(mr_line_info), link, riskscr, basic_metrics, settings)
    return stack([rates, pct_office_visits(claims)]).withColumns(
        {"name_client": F.lit(settings.client), "metric_category": F.lit("outpatient")}
    )
