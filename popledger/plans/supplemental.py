"""Supplemental mart: claims, pharmacy, line reference, monthly eligibility, facility names."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from popledger.functions.nulls import coalesce_text
from popledger.functions.text import same_ci, tidy_name
from popledger.operators.reshape import first_slot

# Fixed value: identifier type of a certification number.
CERTIFICATION = "06"


def facility_names(register: DataFrame, slots: int = 48) -> DataFrame:
    """Facility name per certification number: the number is the first slot of its type, the name the last by order."""
    number = first_slot(
        [f"other_prvdr_id_type_cd_{i}" for i in range(1, slots + 1)], [f"other_prvdr_id_{i}" for i in range(1, slots + 1)], CERTIFICATION
    )
    found = register.select(number.alias("oscar"), "prvdr_org_name").where("oscar is not null and oscar <> ''")
    return found.groupBy("oscar").agg(F.max("prvdr_org_name").alias("_name")).select("oscar", tidy_name("_name").alias("prv_org_name"))


def outclaims(claims: DataFrame) -> DataFrame:
    """Claims with derived days."""
    return claims.withColumn("prm_days", F.when(same_ci("prm_util_type", "DAYS"), F.col("prm_util")).otherwise(F.lit(0)))


def with_facility_name(claims: DataFrame, names: DataFrame, ccn: str = "prm_prv_id_ccn") -> DataFrame:
    """Facility name on claims; names are unique per number, so claims never multiply."""
    return claims.join(names.withColumnRenamed("oscar", ccn), ccn, "left")


def outpharmacy(claims: DataFrame, providers: DataFrame) -> DataFrame:
    """Pharmacy claims with the provider's network tier, 'OON' where there is none."""
    tiers = providers.select(F.col("prv_id").alias("providerid"), "prv_net_hier_1")
    return claims.join(tiers, "providerid", "left").withColumn("prv_net_hier_1", coalesce_text("prv_net_hier_1", "OON"))


def ref_prm_line(mr_line_info: DataFrame) -> DataFrame:
    return mr_line_info.withColumns({"prm_line": F.col("mr_line"), "prm_line_category": F.col("prm_line_desc1")})


def memmos_elig(member_time: DataFrame, member: DataFrame) -> DataFrame:
    """Months of medical cover by member and month, with demographics."""
    people = [
        "age", "gender", "mem_name", "mem_address_line_1", "mem_address_line_2", "mem_city_state", "mem_state", "mem_zip5", "dob",
    ]
    keys = ["member_id", "elig_month", "elig_status_1", "cover_medical"]
    # months are dealt anew before they are summed: a task of spans becomes many times as many months, and would sum them all at once
    dealt = member_time.where(same_ci("cover_medical", "Y")).select(*keys, "memmos").repartition("member_id", "elig_month")
    # and they are summed before the demographics are joined: they depend on the member alone
    months = dealt.groupBy(*keys).agg(F.sum("memmos").alias("memmos"))
    return months.join(member.select("member_id", *people), "member_id", "left").select(*keys, *people, "memmos")
