"""Emergency-department metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from popledger.functions.nulls import safe_ratio
from popledger.functions.text import starts_ci
from popledger.operators.claims import with_cases
from popledger.operators.ordering import latest
from popledger.operators.reshape import metrics_long
from popledger.plans.lattice import ClaimLattice
from popledger.plans.risk import line_map, with_service_risk
from popledger.settings import ReportSettings

# Metric id -> share it is made of, and the labels.
CLASSES = {
    "ED_emer_nec": "prm_nyu_emergent_non_avoidable",
    "ED_emer_prev": "prm_nyu_emergent_avoidable",
    "ED_emer_pricare": "prm_nyu_emergent_primary_care",
    "ED_injury": "prm_nyu_injury",
    "ED_nonemer": "prm_nyu_nonemergent",
    "ED_other": "prm_nyu_unclassified",
}
LABELS = {
    "ED": "ED visits",
    "ED_rskadj": "ED visits Risk Adjusted",
    "ED_emer_nec": "# of ED visits Emergent Necessary (NYU logic)",
    "ED_emer_prev": "# of ED visits Emergent Preventable (NYU logic)",
    "ED_emer_pricare": "# of ED visits Emergent Primary Care Treatable (NYU logic)",
    "ED_injury": "# of ED visits Injury (NYU logic)",
    "ED_nonemer": "# of ED visits Non Emergent (NYU logic)",
    "ED_other": "# of ED visits other (NYU logic)",
}


def ed_cases(medical: ClaimLattice, cases: DataFrame, link: DataFrame, riskscr: DataFrame, settings: ReportSettings) -> DataFrame:
    """Emergency cases of rostered members with visit shares and the mean service score."""
    visits = medical.at(["member_id", "elig_status_1", "caseadmitid", "prm_line"], ["prm_util"], where=starts_ci("prm_line", "O11"))
    claims = with_cases(visits, cases.select("caseadmitid", *CLASSES.values()))
    mapped = claims.join(line_map(link, settings.lob).withColumnRenamed("mr_line", "prm_line"), "prm_line", "left")
    return with_service_risk(mapped, riskscr).withColumn("prm_util_riskadj", safe_ratio("prm_util", "riskscr_1_util_avg"))


def metrics_er(cases: DataFrame, client: str) -> DataFrame:
    wide = cases.groupBy("time_period", "elig_status_1").agg(
        F.sum("prm_util").alias("ED"),
        F.sum("prm_util_riskadj").alias("ED_rskadj"),
        *[F.sum(F.col(share) * F.col("prm_util")).alias(metric) for metric, share in CLASSES.items()],
    )
    return metrics_long(wide, ["time_period", "elig_status_1"], LABELS).withColumns(
        {"name_client": F.lit(client), "metric_category": F.lit("ER")}
    )


def ed_prev_by_mem(cases: DataFrame, client: str) -> DataFrame:
    """Latest window: members with visits that primary care could have treated."""
    summed = latest(cases, "time_period").groupBy("member_id", "time_period", "elig_status_1").agg(
        F.sum("prm_util").alias("ED_util"),
        F.sum(F.col(CLASSES["ED_emer_pricare"]) * F.col("prm_util")).alias("ED_emer_pricare"),
    )
    return summed.where("ED_emer_pricare > 0").select(
        F.lit(client).alias("name_client"), "time_period", "member_id", "elig_status_1", "ED_util", "ED_emer_pricare",
        safe_ratio("ED_emer_pricare", "ED_util").alias("ED_prct_pricare"),
    )
