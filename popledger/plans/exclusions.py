"""Members excluded from data sharing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from popledger.functions.text import same_ci
from popledger.operators.reshape import metrics_long

# Reason codes.
REASONS = {
    "BD": "Beneficiary Declined",
    "EC": "Excluded by CMS",
    "PL": "Participant List Change",
}
LABELS = {"opt_out_count": "Number of Beneficiaries Opting Out of Data Sharing"}


def reason_text(code: str = "beneexcreason") -> Column:
    mapping = F.create_map(*[F.lit(x) for kv in REASONS.items() for x in kv])
    return F.coalesce(F.try_element_at(mapping, F.col(code)), F.col(code))


def bene_exclusion(rows: DataFrame) -> DataFrame:
    return rows.select("hicno", reason_text().alias("beneexcreason"))


def control_mismatch(rows: DataFrame, control: DataFrame) -> DataFrame:
    """Rows read against the supplier's control total; a row only when they differ."""
    read = rows.agg(F.count(F.lit(1)).alias("rows_read"))
    return read.join(F.broadcast(control.select("recordcount")), F.col("rows_read") != F.col("recordcount"))


def members_with_exclusion(members: DataFrame, exclusion: DataFrame) -> DataFrame:
    """Exclusion reason on members, left outer; the second key is dropped."""
    reasons = exclusion.select(F.col("hicno"), F.col("beneexcreason").alias("mem_excluded_reason"))
    return members.join(reasons, F.col("member_id") == F.col("hicno"), "left_outer").drop("hicno")


def declined() -> Column:
    return same_ci("beneexcreason", "Beneficiary Declined")


def metrics_optoutcount(exclusion: DataFrame, memcnt: DataFrame, client: str) -> DataFrame:
    """Members who declined, repeated for every window with members."""
    total = exclusion.agg(F.sum(F.when(declined(), 1).otherwise(0)).alias("metric_value"))
    return optout_rows(memcnt.select("time_period").distinct().join(total), client)


def optout_rows(counts: DataFrame, client: str) -> DataFrame:
    """Counts by window as metric rows."""
    wide = counts.withColumnRenamed("metric_value", "opt_out_count").withColumns({
        "name_client": F.lit(client), "metric_category": F.lit("Basic"), "elig_status_1": F.lit("All")
    })
    return metrics_long(wide, ["name_client", "time_period", "metric_category", "elig_status_1"], LABELS)
