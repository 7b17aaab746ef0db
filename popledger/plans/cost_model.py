"""Cost and utilisation tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from popledger.functions.nulls import coalesce_text, safe_ratio
from popledger.functions.text import same_ci, starts_ci
from popledger.operators.aggregate import freq, weighted_mean_all
from popledger.operators.claims import MEASURES, agg_claims, agg_memmos, annualised, bucket_label
from popledger.operators.intervals import carry_forward, in_windows
from popledger.operators.joins import with_flag
from popledger.operators.reshape import metrics_long, stack, unpivot_prefix
from popledger.plans.lattice import OWN_STATUS, ClaimLattice
from popledger.plans.risk import line_map
from popledger.settings import ReportSettings

MEASURE_NAMES = list(MEASURES)

# Inclusive upper bound and label of the yearly cost buckets.
COST_BUCKETS = [
    (500, "0-500"),
    (1000, "501-1000"),
    (1750, "1001-1750"),
    (2500, "1751-2500"),
    (3500, "2501-3500"),
    (5000, "3501-5000"),
    (7500, "5001-7500"),
    (15000, "7501-15000"),
    (25000, "15001-25000"),
    (50000, "25001-50000"),
    (100000, "50001-100000"),
    (200000, "100001-200000"),
]
COST_BUCKET_BEYOND = "200000+"

# Reporting lines holding office-administered drugs.
OFFICE_DRUG_LINES = ["O16", "P34"]

# Ids and labels of the basic metrics.
BASIC_LABELS = {
    "memmos_sum": "Total Member Months",
    "memmos_sum_riskadj": "Total Member Months (Risk Adjusted)",
    "riskscr_1_avg": "Average Risk Score",
    "prm_costs_sum_all_services": "Total Costs (All Services)",
    "discharges_sum_all_services": "Total Discharges",
}
CLAIM_SHARE_LABELS = {
    "percent_members_w_claims_med": "Percentage of Members with Medical Claims",
    "percent_members_w_claims_rx": "Percentage of Members with Rx Claims",
    "percent_members_w_claims_any": "Percentage of Members with Any Claims",
}


def _both_sources(
    outclaims: DataFrame, outpharmacy: DataFrame | None, windows: DataFrame, members: DataFrame, dims: list[str],
    settings: ReportSettings, measures: dict[str, str] | None = None, where=None,
) -> DataFrame:
    """Medical and, where supplied, pharmacy claims of rostered members, summed and stacked.

    The status is the claim line's where the claim tables carry one, else the roster's.
    """
    status = coalesce_text("elig_status_1", "Unknown").alias("elig_status_1")
    own_status = "elig_status_1" in outclaims.columns
    roster = members.select("member_id", "time_period", "memmos", *([] if own_status else [status]))

    def summed(claims: DataFrame, kind: str) -> DataFrame:
        have = [d for d in dims if d in claims.columns or d in roster.columns]
        rows = agg_claims(claims, windows, have, where=where, basis=settings.claims_basis, measures=measures, roster=roster)
        return rows.withColumn("prm_coverage_type", F.lit(kind))

    parts = [summed(outclaims, "Medical")]
    if settings.has_rx and outpharmacy is not None:
        parts.append(summed(outpharmacy, "Rx"))
    stacked = stack(parts)
    defaults = {m: F.coalesce(F.col(m), F.lit(0)) for m in ["prm_costs", "allowed", "paid"] if m in stacked.columns}
    if own_status:
        defaults["elig_status_1"] = status
    return stacked.withColumns(defaults)


def claims_limited(
    outclaims: DataFrame,
    outpharmacy: DataFrame | None,
    windows: DataFrame,
    members: DataFrame,
    link: DataFrame,
    settings: ReportSettings,
    reporting_lines: list[str] | None = None,
) -> DataFrame:
    """Claims of rostered members by window, member, line, network, provider and procedure.

    ``reporting_lines`` restricts the claims before they are summed.
    """
    lines = line_map(link, settings.lob).withColumnRenamed("mr_line", "prm_line")
    if reporting_lines:
        # a handful of service lines: the small list cuts the claims before any shuffle
        lines = lines.where(F.col("mcrm_line").isin(reporting_lines))
        wanted = lines.select("prm_line")
        outclaims = outclaims.join(wanted, "prm_line", "left_semi")
        outpharmacy = None if outpharmacy is None else outpharmacy.join(wanted, "prm_line", "left_semi")
    dims = ["member_id", "prm_line", "elig_status_1", "memmos", "prv_net_aco_yn", "providerid", "hcpcs"]
    rows = _both_sources(outclaims, outpharmacy, windows, members, dims, settings)
    return rows.withColumn("prv_net_aco_yn", coalesce_text("prv_net_aco_yn", "N")).join(lines, "prm_line", "left")


def _rolled_up(medical: ClaimLattice, pharmacy: ClaimLattice | None, dims: list[str], final: bool = True) -> DataFrame:
    """Medical and, where supplied, pharmacy claims at one grain, or for a caller that sums again (``final=False``) not summed yet. The status is the claim line's where the claims carry one, else the roster's."""
    parts = []
    for lattice, kind in ((medical, "Medical"), (pharmacy, "Rx")):
        if lattice is not None:
            own = OWN_STATUS in lattice.dims
            status = coalesce_text(OWN_STATUS if own else "elig_status_1", "Unknown")
            rows = lattice.at([*dims, *([OWN_STATUS] if own else [])], final=final).withColumn("elig_status_1", status)
            parts.append(rows.drop(OWN_STATUS).withColumn("prm_coverage_type", F.lit(kind)))
    return stack(parts).withColumns({m: F.coalesce(F.col(m), F.lit(0)) for m in ["prm_costs", "allowed", "paid"]})


def member_spend(medical: ClaimLattice, pharmacy: ClaimLattice | None) -> DataFrame:
    """Costs and utilisation per rostered member, window and status."""
    rows = _rolled_up(medical, pharmacy, ["member_id", "elig_status_1", "memmos"], final=False)
    measures = [*MEASURE_NAMES, "claim_lines"]
    return rows.groupBy("member_id", "time_period", "elig_status_1", "memmos").agg(*[F.sum(m).alias(m) for m in measures])


def cost_util(medical: ClaimLattice, pharmacy: ClaimLattice | None, link: DataFrame, settings: ReportSettings) -> DataFrame:
    """Discharges, days, utilisation and amounts by window, line, status, network and coverage."""
    rows = _rolled_up(medical, pharmacy, ["prm_line", "elig_status_1", "prv_net_aco_yn"])
    lines = line_map(link, settings.lob).withColumnRenamed("mr_line", "prm_line")
    summed = (
        rows.withColumn("prv_net_aco_yn", coalesce_text("prv_net_aco_yn", "N"))
        .join(lines, "prm_line", "left")
        .groupBy("time_period", "prm_line", "mcrm_line", "elig_status_1", "prv_net_aco_yn", "prm_coverage_type")
        .agg(*[F.sum(m).alias(m) for m in MEASURE_NAMES])
    )
    inpatient = starts_ci("prm_line", "I")
    return summed.select(
        F.lit(settings.client).alias("name_client"),
        "time_period", "prm_line", "mcrm_line", "elig_status_1", "prv_net_aco_yn",
        F.when(inpatient, F.col("discharges")).otherwise(0).alias("prm_discharges"),
        F.when(inpatient, F.col("prm_util")).otherwise(0).alias("prm_days"),
        "prm_util",
        "prm_costs",
        F.col("allowed").alias("prm_allowed"),
        F.col("paid").alias("prm_paid"),
        "prm_coverage_type",
    )


def memmos(eligibility: DataFrame, windows: DataFrame, members: DataFrame, client: str) -> DataFrame:
    """Member months by window, status and coverage, long form."""
    return memmos_long(agg_memmos(eligibility, windows, ["member_id"]), members, client)


def memmos_long(months: DataFrame, members: DataFrame, client: str) -> DataFrame:
    """Months per member and window as the month table of the rostered ones."""
    limit = members.select("member_id", "time_period", "elig_status_1")
    wide = months.join(limit, ["member_id", "time_period"]).groupBy("time_period", "elig_status_1").agg(
        F.sum("memmos_medical").alias("memmos_medical"), F.sum("memmos_rx").alias("memmos_rx")
    )
    return unpivot_prefix(wide, ["time_period", "elig_status_1"], "memmos", "prm_coverage_type", "prm_memmos").withColumn(
        "name_client", F.lit(client)
    )


def ref_prm_line(mr_line_info: DataFrame, link: DataFrame, ref_mcrm_line: DataFrame, settings: ReportSettings) -> DataFrame:
    """Line reference with the descriptions of its reporting line."""
    levels = [f"mcrm_line_desc_l{i}" for i in range(1, 7)]
    pairs = link.where(same_ci("lob", settings.lob))
    return (
        mr_line_info.join(pairs, "mr_line")
        .join(ref_mcrm_line, ["lob", "mcrm_line"], "left")
        .select(
            F.lit(settings.client).alias("name_client"),
            F.col("mr_line").alias("prm_line"),
            "prm_line_desc",
            "mcrm_line",
            *levels,
            F.col("costmodel_util").alias("prm_util_type"),
            "prm_coverage_type",
        )
    )


def claims_distribution(spend: DataFrame, client: str) -> DataFrame:
    """Members and yearly cost by cost bucket.

    All claims of a member and window share its months, so the yearly rate of the sum is
    the sum of the yearly rates. It is kept as an exact amount: bucket totals do not
    depend on the order of the members.
    """
    yearly = spend.withColumn("prm_costs", annualised("prm_costs", "memmos").cast("decimal(24,6)"))
    return (
        yearly.withColumn("cost_bucket", bucket_label("prm_costs", COST_BUCKETS, COST_BUCKET_BEYOND))
        .groupBy("time_period", "elig_status_1", "cost_bucket")
        .agg(freq().alias("member_count"), F.sum("prm_costs").alias("prm_costs"))
        .withColumn("name_client", F.lit(client))
    )


def office_admin_drug(limited: DataFrame, providers: DataFrame, client: str) -> DataFrame:
    """Claims and cost of office-administered drugs by status, procedure code and provider."""
    drug = limited.where(F.col("mcrm_line").isin(OFFICE_DRUG_LINES))
    summed = drug.groupBy(
        "time_period", "elig_status_1",
        coalesce_text("hcpcs", "XXXXX").alias("hcpcs"), coalesce_text("providerid", "Unknown").alias("providerid"),
    ).agg(freq().alias("claim_count"), F.sum("prm_costs").alias("prm_costs"))
    who = providers.select(F.col("prv_id").alias("providerid"), "prv_name", "prv_specialty")
    return summed.join(who, "providerid", "left").select(
        F.lit(client).alias("name_client"), "time_period", "elig_status_1", "providerid", "claim_count",
        coalesce_text("prv_name", "Unknown").alias("provider"),
        coalesce_text("prv_specialty", "XX").alias("specialty"),
        "hcpcs", "prm_costs",
    )


def basic_aggs_elig_status(members: DataFrame, cost_util: DataFrame, client: str) -> DataFrame:
    """Months, mean score, costs and discharges by window and status."""
    costs = cost_util.groupBy("time_period", "elig_status_1").agg(
        F.sum("prm_costs").alias("_costs"), F.sum("prm_discharges").alias("_discharges")
    )
    base = members.groupBy("time_period", "elig_status_1").agg(
        F.sum("memmos").alias("memmos_sum"),
        F.sum(F.col("memmos") * F.col("riskscr_1")).alias("memmos_sum_riskadj"),
        weighted_mean_all("riskscr_1", "memmos").alias("riskscr_1_avg"),
    )
    return base.join(costs, ["time_period", "elig_status_1"], "left").select(
        F.lit(client).alias("name_client"), "time_period", "elig_status_1",
        F.lit("Basic").alias("metric_category"),
        "memmos_sum", "memmos_sum_riskadj", "riskscr_1_avg",
        F.coalesce("_costs", F.lit(0)).alias("prm_costs_sum_all_services"),
        F.coalesce("_discharges", F.lit(0)).alias("discharges_sum_all_services"),
    )


def basic_aggs(by_status: DataFrame) -> DataFrame:
    """The same by window; the mean score is weighted by the months of each status."""
    return by_status.groupBy("name_client", "time_period", "metric_category").agg(
        F.sum("memmos_sum").alias("memmos_sum"),
        F.sum("memmos_sum_riskadj").alias("memmos_sum_riskadj"),
        weighted_mean_all("riskscr_1_avg", "memmos_sum").alias("riskscr_1_avg"),
        F.sum("prm_costs_sum_all_services").alias("prm_costs_sum_all_services"),
        F.sum("discharges_sum_all_services").alias("discharges_sum_all_services"),
    )


def metrics_basic(by_status: DataFrame) -> DataFrame:
    return metrics_long(by_status, ["name_client", "time_period", "metric_category", "elig_status_1"], BASIC_LABELS)


def metrics_claims_percentages(members: DataFrame, medical: ClaimLattice, pharmacy: ClaimLattice | None, settings: ReportSettings) -> DataFrame:
    """Share of members with medical, pharmacy and any claims."""
    keys = ["member_id", "time_period"]

    def seen(lattice: ClaimLattice) -> DataFrame:
        # stored rows are made distinct below, not summed before that
        return lattice.at(["member_id"], [], final=False).select(*keys)

    marked = with_flag(members.select(*keys, "elig_status_1"), seen(medical), keys, "_med")
    if pharmacy is not None:
        marked = with_flag(marked, seen(pharmacy), keys, "_rx")
    else:
        marked = marked.withColumn("_rx", F.lit("N"))

    def share(test):
        return safe_ratio(F.sum(F.when(test, 1).otherwise(0)), freq())

    med, rx = F.col("_med") == "Y", F.col("_rx") == "Y"
    wide = marked.groupBy("time_period", "elig_status_1").agg(
        share(med).alias("percent_members_w_claims_med"),
        share(rx).alias("percent_members_w_claims_rx"),
        share(med | rx).alias("percent_members_w_claims_any"),
    )
    long = metrics_long(wide, ["time_period", "elig_status_1"], CLAIM_SHARE_LABELS)
    return long.withColumns({"name_client": F.lit(settings.client), "metric_category": F.lit("Basic")})


def monthly_status(member_time: DataFrame, monthly_elig_status: DataFrame, since: date | None = None) -> DataFrame:
    """Status per member and month: the reported one, else that of the next later month,
    else the one of the member's latest month.

    A member's reported months, a calendar at most, travel as one list, so the months meet them on the member alone and stay in
    the member's partition through the join, the carrying and the sums above. With ``since`` only the months from that day on come
    out, as they would without it: a status is carried to earlier months only."""
    if since is not None:
        member_time = member_time.where(F.col("elig_month") >= F.lit(since))
        monthly_elig_status = monthly_elig_status.where(F.date_add("date_elig_start", 14) >= F.lit(since))
    reported = monthly_elig_status.groupBy(F.col("hicno").alias("member_id")).agg(
        F.collect_list(F.struct(F.date_add("date_elig_start", 14).alias("month"), F.col("elig_status").alias("status"))).alias("_known")
    )
    by_month = (
        member_time.where("cover_medical = 'Y'")
        .groupBy("member_id", "elig_month")
        .agg(F.sum("memmos").alias("memmos"), F.max("elig_status_1").alias("elig_status_1"))
    )
    found = F.transform(F.filter("_known", lambda x: x["month"] == F.col("elig_month")), lambda x: x["status"])
    mapped = by_month.join(reported, "member_id", "left").withColumn("_reported", F.explode_outer(found)).drop("_known")
    return carry_forward(
        mapped, ["member_id"], [F.col("elig_month").desc()], value="_reported", seed="elig_status_1", into="elig_status"
    ).select("member_id", "elig_month", "elig_status", "memmos")


def member_elig(monthly: DataFrame, windows: DataFrame, members: DataFrame, client: str) -> DataFrame:
    """Months per member, window and monthly status, for rostered members. A member's windows travel as one list, like its months."""
    rostered = members.groupBy("member_id").agg(F.collect_set("time_period").alias("_rostered"))
    placed = in_windows(
        monthly.join(rostered, "member_id"),
        windows.select("time_period", "inc_start", "inc_end"),
        F.col("elig_month").between(F.col("inc_start"), F.col("inc_end")) & F.array_contains("_rostered", F.col("time_period")),
    )
    return placed.groupBy("member_id", "time_period", F.col("elig_status").alias("elig_status_1")).agg(
        F.sum("memmos").alias("elig_months")
    ).withColumn("name_client", F.lit(client))


def member_elig_from_roster(members: DataFrame, client: str) -> DataFrame:
    """Alternative without monthly statuses: the roster's own months and status."""
    return members.groupBy("member_id", "time_period", "elig_status_1").agg(F.sum("memmos").alias("elig_months")).withColumn(
        "name_client", F.lit(client)
    )


def member_costs(spend: DataFrame, client: str) -> DataFrame:
    """Paid total per member and window."""
    return spend.groupBy("member_id", "time_period").agg(F.sum("paid").alias("total_cost")).withColumn(
        "name_client", F.lit(client)
    )
