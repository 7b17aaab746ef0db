"""Data checks. Each returns the violating rows (or the compared totals) as a frame;
``enforce`` turns a frame into an error or a warning."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from popledger.functions.nulls import safe_ratio
from popledger.functions.numbers import smape
from popledger.functions.text import in_ci, is_identifier, same_ci, starts_ci
from popledger.operators.joins import full_mismatch, merge_flags
from popledger.operators.reshape import stack
from popledger.sources.schema import MartSchema

LOG = logging.getLogger("popledger.checks")

# Metric -> measure of the cost table, line prefix, lines left out. Ids are those the reports produce.
PREFIX_RULES = [
    ("acute", "prm_discharges", "I", ["I31"]),
    ("medical", "prm_discharges", "I11", []),
    ("medical_general", "prm_discharges", "I11a", []),
    ("surgical", "prm_discharges", "I12", []),
    ("high_tech_imaging", "prm_util", "O14", []),
    ("hi_tec_img_fop", "prm_util", "P57", []),
    ("hi_tec_img_office", "prm_util", "P59", []),
    ("observation_stays", "prm_util", "O10", []),
    ("SNF", "prm_discharges", "I31", []),
    ("ED", "prm_util", "O11", []),
]
# Field of the inpatient details and its value -> line prefix of the cost table, lines left out.
DETAIL_RULES = [
    ("acute_yn", "Y", "I", ["I31"]),
    ("medical_surgical", "None", "I", ["I31", "I11a", "I11b", "I11c", "I12"]),
    ("medical_surgical", "Medical", "I11", ["I31"]),
    ("medical_surgical", "Surgical", "I12", ["I31"]),
]


class CheckFailed(AssertionError):
    pass


def enforce(violations: DataFrame, message: str, notify_only: bool = False) -> bool:
    """True when there are no violating rows; else raise, or warn."""
    if violations.isEmpty():
        return True
    if notify_only:
        LOG.warning(message)
        return False
    raise CheckFailed(message)


def with_fault(df: DataFrame, faults: DataFrame, keys: Sequence[str], changes: dict[str, Column]) -> DataFrame:
    """The table with other values in the rows that the fault table names by ``keys``: a check of the result must find just these."""
    marks = faults.select(*keys).distinct().withColumn("_fault", F.lit(True))
    marked = df.join(marks, list(keys), "left")
    return marked.select(*[F.when(F.col("_fault"), changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in df.columns])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def nulls_in(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def populated(df: DataFrame, name: str) -> DataFrame:
    """A row when the table is empty."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name_table"), "rows").where("rows = 0")


def unpopulated_parts(expected: DataFrame, df: DataFrame, part: str) -> DataFrame:
    """Expected parts (months, groups, sources) of which a table has no row."""
    seen = df.groupBy(part).agg(F.count(F.lit(1)).alias("rows"))
    return expected.join(seen, part, "left").withColumn("rows", F.coalesce("rows", F.lit(0))).where("rows = 0")


def outside(df: DataFrame, value: Column, low: float | None = None, high: float | None = None) -> DataFrame:
    """A row when an aggregate lies outside its plausible range (bounds included)."""
    got = df.agg(value.cast("double").alias("value"))
    test = F.lit(False)
    if low is not None:
        test = test | F.coalesce(F.col("value") < low, F.lit(True))
    if high is not None:
        test = test | F.coalesce(F.col("value") > high, F.lit(True))
    return got.where(test)


def count_mismatch(a: DataFrame, b: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    # one row each
    return a.agg(n.alias("rows_a")).join(b.agg(n.alias("rows_b")), F.col("rows_a") != F.col("rows_b"))


def total_smape(a: DataFrame, measure_a: str, b: DataFrame, measure_b: str) -> DataFrame:
    """Symmetric difference of two grand totals."""
    ta, tb = a.agg(F.sum(measure_a).alias("total_a")), b.agg(F.sum(measure_b).alias("total_b"))
    return ta.join(F.broadcast(tb)).select(
        F.col("total_a").cast("double").alias("total_a"), F.col("total_b").cast("double").alias("total_b"),
        F.round(smape("total_a", "total_b"), 4).alias("smape"),
    )


def rounded_totals_differ(
    a: DataFrame, b: DataFrame, keys: Sequence[str], pairs: Sequence[tuple[str, str, int]]
) -> DataFrame:
    """Totals by key that differ after rounding, full outer. ``pairs``: column of a, column of b, digits."""
    left = a.groupBy(*keys).agg(*[F.round(F.sum(x).cast("double"), d).alias(f"a_{x}") for x, _, d in pairs])
    right = b.groupBy(*keys).agg(*[F.round(F.sum(y).cast("double"), d).alias(f"b_{y}") for _, y, d in pairs])
    return full_mismatch(left, right, keys, [(f"a_{x}", f"b_{y}") for x, y, _ in pairs])


def memmos_differ(memmos: DataFrame, metrics: DataFrame) -> DataFrame:
    """Reported member months against the month table, one grand total per coverage."""
    medical = memmos.where(same_ci("prm_coverage_type", "Medical")).select("time_period", "elig_status_1", "prm_memmos")
    reported = metrics.where(same_ci("metric_id", "memmos_sum")).select("time_period", "elig_status_1", "metric_value")
    both = medical.join(reported, ["time_period", "elig_status_1"])
    return both.agg(F.sum("prm_memmos").alias("memmos_check"), F.sum("metric_value").alias("memmos_metric")).where(
        ~F.round("memmos_check").eqNullSafe(F.round("memmos_metric"))
    )


def metric_differs(cost_util: DataFrame, metrics: DataFrame, metric_id: str, measure: str, coverage: str | None = "Medical") -> DataFrame:
    """A metric re-derived from the cost table, by default from its medical part.
    Costs of runs with priced pharmacy claims are compared over all coverages."""
    lines = cost_util.where(same_ci("prm_coverage_type", coverage)) if coverage else cost_util
    return _compare(lines, metrics, metric_id, F.sum(measure))


def prefix_metric_differs(cost_util: DataFrame, metrics: DataFrame, metric_id: str, measure: str, prefix: str, left_out: Sequence[str]) -> DataFrame:
    lines = cost_util.where(same_ci("prm_coverage_type", "Medical") & starts_ci("prm_line", prefix))
    if left_out:
        lines = lines.where(~in_ci("prm_line", left_out))
    return _compare(lines, metrics, metric_id, F.sum(measure))


def office_visits_differ(cost_util: DataFrame, metrics: DataFrame) -> DataFrame:
    lines = cost_util.where(same_ci("prm_coverage_type", "Medical") & starts_ci("prm_line", "P32"))
    pcp = F.sum(F.when(same_ci("prm_line", "P32c"), F.col("prm_util")).otherwise(0))
    return _compare(lines, metrics, "pct_office_visits_pcp", safe_ratio(pcp, F.sum("prm_util")), digits=6)


def _compare(lines: DataFrame, metrics: DataFrame, metric_id: str, value: Column, digits: int = 0) -> DataFrame:
    keys = ["time_period", "elig_status_1"]
    check = lines.groupBy(*keys).agg(F.round(value.cast("double"), digits).alias("check_value"))
    reported = metrics.where(same_ci("metric_id", metric_id)).select(*keys, F.round("metric_value", digits).alias("metric_value"))
    return (
        check.join(reported, keys)
        .where(~F.col("check_value").eqNullSafe(F.col("metric_value")))
        .select(F.lit(metric_id).alias("metric_id"), *keys, "check_value", "metric_value")
    )


def all_prefix_metrics(cost_util: DataFrame, metrics: DataFrame) -> DataFrame:
    """The ten prefix rules in one pass: each cost row is spread to the metrics it belongs to."""
    keys = ["time_period", "elig_status_1"]
    medical = cost_util.where(same_ci("prm_coverage_type", "Medical"))
    hits = F.array_compact(F.array(*[
        F.when(
            starts_ci("prm_line", p) & (~in_ci("prm_line", out) if out else F.lit(True)),
            F.struct(F.lit(m).alias("metric_id"), F.col(measure).cast("double").alias("v")),
        )
        for m, measure, p, out in PREFIX_RULES
    ]))
    check = medical.select(*keys, F.explode(hits).alias("h")).groupBy(*keys, F.col("h.metric_id").alias("metric_id")).agg(
        F.round(F.sum("h.v")).alias("check_value")
    )
    reported = metrics.where(in_ci("metric_id", [r[0] for r in PREFIX_RULES])).select(*keys, "metric_id", F.round("metric_value").alias("metric_value"))
    return check.join(reported, [*keys, "metric_id"])


def prefix_metrics_differ(cost_util: DataFrame, metrics: DataFrame) -> DataFrame:
    return all_prefix_metrics(cost_util, metrics).where(~F.col("check_value").eqNullSafe(F.col("metric_value")))


def details_differ(details: DataFrame, cost_util: DataFrame, field: str, value: str, prefix: str, left_out: Sequence[str]) -> DataFrame:
    """Inpatient details against the cost table for one class of stays."""
    keys = ["time_period", "elig_status_1"]
    lines = cost_util.where(starts_ci("prm_line", prefix))
    if left_out:
        lines = lines.where(~in_ci("prm_line", left_out))
    return rounded_totals_differ(
        details.where(same_ci(field, value)), lines, keys,
        [("cnt_discharges_inpatient", "prm_discharges", 0), ("sum_days_inpatient", "prm_days", 0), ("sum_costs_inpatient", "prm_costs", 2)],
    )


def snf_details_differ(details: DataFrame, cost_util: DataFrame) -> DataFrame:
    return rounded_totals_differ(
        details, cost_util.where(same_ci("prm_line", "I31")), ["time_period", "elig_status_1"],
        [("cnt_discharges_snf", "prm_discharges", 0), ("sum_days_snf", "prm_days", 0), ("sum_costs_snf", "prm_costs", 2)],
    )


def non_acute_rows(details: DataFrame) -> DataFrame:
    return details.where("acute_yn = 'N'")


def discharges_differ(cost_util: DataFrame, discharge_metrics: DataFrame) -> DataFrame:
    """Discharges of the cost table against the discharge-status metrics."""
    a = cost_util.where(~same_ci("prm_line", "I31")).agg(F.sum("prm_discharges").cast("double").alias("cost_model_discharges"))
    b = discharge_metrics.agg(F.sum("metric_value").alias("ip_disch"))
    return a.join(F.broadcast(b), ~F.col("cost_model_discharges").eqNullSafe(F.col("ip_disch")))


def months_differ(members: DataFrame, member_elig: DataFrame) -> DataFrame:
    return rounded_totals_differ(members, member_elig, ["member_id", "time_period"], [("memmos", "elig_months", 2)])


def member_costs_differ(member_costs: DataFrame, cost_util: DataFrame) -> DataFrame:
    return rounded_totals_differ(member_costs, cost_util, ["time_period"], [("total_cost", "prm_paid", 2)])


def category_coverage(metrics: DataFrame, schema: MartSchema) -> DataFrame:
    """Expected against observed metric categories; rows are categories found on one side only.

    The expected ones are exploded from the declared list."""
    allowed = "~".join(schema.fields["metric_category"].whitelist)
    expected = metrics.sparkSession.range(1).select(F.explode(F.split(F.lit(allowed), "~")).alias("metric_category"))
    observed = metrics.select(F.lower("metric_category").alias("metric_category"))
    return merge_flags(expected, observed, ["metric_category"], ("in_expected", "in_observed")).where(
        "in_expected = 'N' or in_observed = 'N'"
    )


def client_names(tables: dict[str, DataFrame], client: str) -> DataFrame:
    """Client names other than the expected one, over all tables; a table without the column gives a row of its own."""
    found = []
    for name, df in tables.items():
        if "name_client" in df.columns:
            found.append(df.select(F.lit(name).alias("name_table"), "name_client").where(~same_ci("name_client", client)).distinct())
        else:
            found.append(df.sparkSession.range(1).select(F.lit(name).alias("name_table"), F.lit(None).cast("string").alias("name_client")))
    return stack(found)


def bad_metric_ids(metrics: DataFrame) -> DataFrame:
    return metrics.select("metric_id").distinct().where(~is_identifier("metric_id"))


def living_with_death_data(memcnt: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows of living members that carry death attributes."""
    test = (F.col("deceased_hospital_yn") == "Y") | (F.col("final_hospice_days") != 0) | (F.col("costs_final_30_days_sum") != 0)
    for f in flags:
        test = test | (F.col(f) == "Y")
    return memcnt.where((F.col("deceased_yn") == "N") & test)


def unit_types(claims: DataFrame, expected: str = "DAYS") -> DataFrame:
    """Number of rows whose unit type is not the expected one."""
    return claims.agg(F.sum(F.when(~F.upper("prm_util_type").eqNullSafe(F.lit(expected)), 1).otherwise(0)).alias("rows_other_unit"))


def label_problems(meta_field: DataFrame) -> DataFrame:
    """Labels used twice, and labels that repeat the field's name."""
    labelled = meta_field.where("meta_field_label is not null")
    twice = labelled.groupBy("meta_field_label").agg(F.count(F.lit(1)).alias("n"), F.min("meta_field").alias("meta_field")).where("n > 1")
    return stack([
        twice.select("meta_field", "meta_field_label", F.lit("duplicate").alias("problem")),
        labelled.where(F.lower("meta_field") == F.lower("meta_field_label")).select("meta_field", "meta_field_label", F.lit("noise").alias("problem")),
    ])


def scores_differ(reconciliation: DataFrame) -> DataFrame:
    return reconciliation.where("coalesce(diff_ne, 0) <> 0 or coalesce(diff_comm, 0) <> 0")
