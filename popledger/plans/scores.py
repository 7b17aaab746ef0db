"""Additive explanation of a risk score: one row per variable that counts, with its coefficients."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from popledger.functions.nulls import sum_present
from popledger.operators.reshape import flags_set, row_to_pairs

# Columns that identify or score a member and are not flags.
NOT_FLAGS = {
    "HICNO", "DOB", "TIME_SLICE", "INCSTART", "INCEND", "PAIDTHRU", "OREC", "SEX", "MCAID", "NEMCAID", "RISKSCR_MM",
    "SCORE_COMMUNITY", "SCORE_INSTITUTIONAL", "SCORE_NEW_ENROLLEE", "SCORE_SNP_NEW_ENROLLEE", "AGEF", "ORIGDS", "DISABL",
}
# Categories that count extra for disabled members.
DISABLED_WITH = [6, 34, 46, 54, 55, 110, 176]
# Combinations that count extra: any category of the first group with any of the second.
COMBINATIONS = {
    "DIABETES_CHF": ([17, 18, 19], [85]),
    "SEPSIS_CARD_RESP_FAIL": ([2], [82, 83, 84]),
    "CHF_COPD": ([85], [110, 111]),
    "COPD_CARD_RESP_FAIL": ([110, 111], [82, 83, 84]),
    "CHF_RENAL": ([85], [134, 135, 136, 137]),
    "CANCER_IMMUNE": ([8, 9, 10, 11, 12], [47]),
}
SEXES = {"Male": "1", "Female": "2"}


def with_interactions(flags: DataFrame) -> DataFrame:
    """Add the flags that combine a member's class with categories, or categories with each other."""
    on = lambda c: F.col(c) == 1
    any_of = lambda ids: F.greatest(*[F.col(f"hcc{i}") for i in ids]) == 1 if len(ids) > 1 else on(f"hcc{ids[0]}")
    flag = lambda test: F.when(test, 1).otherwise(0)
    extra: dict[str, Column] = {}
    for sex, code in SEXES.items():
        is_sex = F.col("sex") == code
        extra[f"OriginallyDisabled_{sex}"] = flag(is_sex & on("origds"))
        extra[f"MCAID_{sex}_Aged"] = flag(is_sex & on("mcaid") & (F.col("disabl") == 0))
        extra[f"MCAID_{sex}_Disabled"] = flag(is_sex & on("mcaid") & on("disabl"))
    for i in DISABLED_WITH:
        extra[f"DISABLED_HCC{i}"] = flag(on("disabl") & on(f"hcc{i}"))
    for name, (first, second) in COMBINATIONS.items():
        extra[name] = flag(any_of(first) & any_of(second))
    return flags.withColumns(extra)


def coefficient_table(row: DataFrame) -> DataFrame:
    """Coefficients by variable: community, and new enrollee for the four classes."""
    pairs = row_to_pairs(row, "_name", "_coef")
    community = F.upper(F.substring("_name", 1, 3)) == "CE_"
    kind = F.when(community, "CE").otherwise(F.upper(F.regexp_extract("_name", "(?i)^NE_(N?MCAID_N?ORIGDIS)_", 1)))
    variable = F.when(community, F.expr("substring(_name, 4)")).otherwise(
        F.regexp_replace("_name", "(?i)^NE_N?MCAID_N?ORIGDIS_", "")
    )
    classes = ["CE", "NMCAID_NORIGDIS", "NMCAID_ORIGDIS", "MCAID_NORIGDIS", "MCAID_ORIGDIS"]
    return pairs.select(kind.alias("_kind"), variable.alias("_variable"), "_coef").groupBy("_variable").pivot("_kind", classes).agg(F.first("_coef"))


def score_explanation(hcc_results: DataFrame, coefficients: DataFrame) -> DataFrame:
    """Per member and window the variables with flag 1 and their coefficients."""
    flagged = with_interactions(hcc_results)
    names = [c for c in flagged.columns if c.upper() not in NOT_FLAGS and not c.upper().startswith("CC")]
    long = flags_set(flagged, ["hicno", "time_slice", "origds", "mcaid"], names, "_variable")
    disabled, medicaid = F.col("origds") == 1, F.col("mcaid") == 1
    prefix = F.concat_ws(
        "_", F.when(disabled, "ORIGDIS").otherwise("NORIGDIS"), F.when(medicaid, "MCAID").otherwise("NMCAID"), F.col("_variable")
    )
    enrollee = (
        F.when(~disabled & ~medicaid, F.col("NMCAID_NORIGDIS"))
        .when(~disabled & medicaid, F.col("MCAID_NORIGDIS"))
        .when(disabled & ~medicaid, F.col("NMCAID_ORIGDIS"))
        .otherwise(F.col("MCAID_ORIGDIS"))
    )
    # one row per variable of the model
    return long.join(coefficients, "_variable", "left").select(
        "hicno",
        "time_slice",
        F.when(F.upper(F.substring("_variable", 1, 2)) == "NE", prefix).otherwise(F.col("_variable")).alias("variable"),
        F.col("CE").alias("comm_coeff"),
        enrollee.alias("ne_coeff"),
    )


def score_reconciliation(explained: DataFrame, hcc_results: DataFrame) -> DataFrame:
    """Coefficient sums next to the reported scores, and their rounded differences."""
    sums = explained.groupBy("hicno", "time_slice").agg(F.sum("ne_coeff").alias("ne_coeff"), F.sum("comm_coeff").alias("comm_coeff"))
    scores = hcc_results.select("hicno", "time_slice", "riskscr_mm", "score_community", "score_new_enrollee")
    joined = sums.join(scores, ["hicno", "time_slice"], "left")
    ne = F.round(sum_present("ne_coeff", -F.col("score_new_enrollee")), 3)
    # a new-enrollee score of 0.01 is a placeholder and is not compared
    return joined.withColumns({
        "diff_ne": F.when(F.col("score_new_enrollee").eqNullSafe(F.lit(0.01)), 0.0).otherwise(ne),
        "diff_comm": F.round(sum_present("comm_coeff", -F.col("score_community")), 3),
    })
