"""Corrections applied to claims before a run."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from popledger.functions.text import same_ci, starts_ci


def version_fix(claims: DataFrame, day: str = "prm_fromdate", version: str = "icdversion", start: date = date(2015, 10, 1)) -> DataFrame:
    """From the switch-over day on, code version 09 becomes 10."""
    return claims.withColumn(
        version, F.when((F.col(day) >= F.lit(start)) & (F.col(version) == "09"), "10").otherwise(F.col(version))
    )


def split_by_setting(claims: DataFrame, ip_start: date, snf_start: date) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Skilled-nursing, other inpatient and remaining lines; each line goes to exactly one."""
    snf = same_ci("prm_line", "I31") & (F.col("prm_fromdate") >= F.lit(snf_start))
    ip = starts_ci("prm_line", "I") & ~same_ci("prm_line", "I31") & (F.col("prm_fromdate") >= F.lit(ip_start))
    # a missing line or day belongs to the rest
    snf, ip = F.coalesce(snf, F.lit(False)), F.coalesce(ip, F.lit(False))
    return claims.where(snf), claims.where(ip), claims.where(~snf & ~ip)


def sign_fix(claims: DataFrame, ip_start: date = date(2016, 1, 1), snf_start: date = date(2016, 2, 1)) -> DataFrame:
    """Cases whose admits and days differ in sign: zeroed when they cost less than 2, else the days take the admits' sign.
    Only inpatient lines from their setting's first day on are corrected; totals are formed once and joined once."""
    snf = same_ci("prm_line", "I31") & (F.col("prm_fromdate") >= F.lit(snf_start))
    ip = starts_ci("prm_line", "I") & ~same_ci("prm_line", "I31") & (F.col("prm_fromdate") >= F.lit(ip_start))
    concerned = F.coalesce(snf | ip, F.lit(False))
    totals = (
        claims.where(starts_ci("prm_line", "I") & (F.col("prm_fromdate") >= F.lit(ip_start)))
        .groupBy("caseadmitid")
        .agg(F.sum("prm_admits").alias("_admits"), F.sum("prm_util").alias("_util"), F.sum("prm_costs").alias("_costs"))
    )
    clash = concerned & ~F.sign("_admits").eqNullSafe(F.sign("_util"))
    trivial = clash & (F.abs("_costs") < 2)

    def zero_when_trivial(c: str) -> Column:
        return F.when(trivial, F.lit(0).cast(claims.schema[c].dataType)).otherwise(F.col(c))

    util_type = claims.schema["prm_util"].dataType
    flipped = (F.sign("_admits") * F.abs("prm_util")).cast(util_type)
    return claims.join(totals, "caseadmitid", "left").withColumns({
        "prm_util": F.when(trivial, F.lit(0).cast(util_type)).when(clash, flipped).otherwise(F.col("prm_util")),
        "prm_costs": zero_when_trivial("prm_costs"),
        "prm_admits": zero_when_trivial("prm_admits"),
    }).select(*claims.columns)
