"""A whole report over one set of input tables."""

from __future__ import annotations

from collections.abc import Collection
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from popledger import checks
from popledger.plans import (
    cost_model, emergency, end_of_life, exclusions, inpatient, mart, outpatient, overlap, risk, roster, snf,
)
from popledger.plans.lattice import MEDICAL_GRAIN, PHARMACY_GRAIN, ClaimLattice
from popledger.operators.claims import day_bounds
from popledger.operators.reshape import stack
from popledger.sources.schema import MartSchema, rule_results
from popledger.sources.writers import materialise, staging_folder, write_observed, write_table


class Report:
    """Lazy results by name. With ``staged`` the intermediates that many results share are
    written once to the checkpoint folder (or to ``folder``); without it every result is one plan. ``only`` names the
    intermediates to write, where a single result needs few of them more than once."""

    def __init__(self, model, staged: bool = False, folder: str | None = None, only: Collection[str] | None = None):
        self.m = model
        self.s = model.settings
        self.folder = folder or (staging_folder(model.spark) if staged else None)
        self.only = only
        self.schema = MartSchema.declared(self.s)

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        return materialise(df, name, self.folder if self.only is None or name in self.only else None)

    # -- shared intermediates --------------------------------------------------------

    @cached_property
    def eligibility(self) -> DataFrame:
        return self._keep(self.m.eligibility, "eligibility")

    @property
    def _stores_spans(self) -> bool:
        return bool(self.folder) and (self.only is None or "eligibility" in self.only) and hasattr(self.m, "over_spans")

    def _member_time(self, since: date | None = None) -> DataFrame:
        """Member months; with ``since`` none of the spans that end before that day."""
        if not self._stores_spans:
            return self.m.member_time
        spans = self.eligibility if since is None else self.eligibility.where(F.col("date_end") >= F.lit(since))
        # stored spans are dealt by member before they become months, which then stay where they are
        return self.m.over_spans(spans.repartition("member_id")).member_time

    @cached_property
    def member_time(self) -> DataFrame:
        return self._member_time()

    @cached_property
    def client_member_time(self) -> DataFrame:
        return self.m.over_spans(self.eligibility).client_member_time if self._stores_spans else self.m.client_member_time

    @cached_property
    def cases(self) -> DataFrame:
        return self._keep(self.m.cases, "cases")

    @property
    def outclaims(self) -> DataFrame:
        return self.m.outclaims

    @property
    def outpharmacy(self) -> DataFrame | None:
        return self.m.outpharmacy if self.s.has_rx else None

    def _lattice(self, claims: DataFrame, dims: list[str], name: str) -> ClaimLattice:
        keep = self._keep if self.folder and self.only is None else None
        return ClaimLattice(claims, self.m.windows, self.members, dims, self.s.claims_basis, name, keep)

    @cached_property
    def medical(self) -> ClaimLattice:
        return self._lattice(self.outclaims, MEDICAL_GRAIN, "medical")

    @cached_property
    def pharmacy(self) -> ClaimLattice | None:
        return self._lattice(self.outpharmacy, PHARMACY_GRAIN, "pharmacy") if self.outpharmacy is not None else None

    @cached_property
    def members_all(self) -> DataFrame:
        people = roster.roster_with_months(self.eligibility, self.m.member, self.m.windows)
        return roster.members_all(people, self.m.windows, self.m.hcc_results, self.m.component_scores, self.s)

    @cached_property
    def members(self) -> DataFrame:
        return self._keep(roster.members(self.members_all), "members")

    @cached_property
    def member_spend(self) -> DataFrame:
        return self._keep(cost_model.member_spend(self.medical, self.pharmacy), "member_spend")

    @cached_property
    def drug_claims(self) -> DataFrame:
        return cost_model.claims_limited(
            self.outclaims, self.outpharmacy, self.m.windows, self.members, self.m.link_mr_mcrm_line, self.s,
            cost_model.OFFICE_DRUG_LINES,
        )

    @cached_property
    def riskscr_service(self) -> DataFrame:
        scores = risk.riskscr_service(
            self.members, self.m.component_scores, self.m.windows, self.m.mr_line_info, self.m.link_mr_mcrm_line,
            self.m.mcrm_hcc_calibrations, self.s,
        )
        return self._keep(scores, "riskscr_service")

    @cached_property
    def basic_aggs_elig_status(self) -> DataFrame:
        return self._keep(cost_model.basic_aggs_elig_status(self.members, self.cost_util, self.s.client), "basic")

    @cached_property
    def decedents(self) -> DataFrame:
        dead = self.m.decedents
        theirs = self.m.of_members(dead.select(F.col("member_id_excluded").alias("member_id"))) if hasattr(self.m, "of_members") else self.m
        return roster.decedents(self.members, self.m.windows, dead, theirs.outclaims, self.s.claims_basis)

    @cached_property
    def inpatient_claims(self) -> DataFrame:
        return inpatient.inpatient_claims(self.outclaims, self.cases, self.m.windows, self.s)

    @cached_property
    def inpatient_partial(self) -> DataFrame:
        partial = inpatient.partial_details(
            inpatient.rostered_stays(self.medical, self.cases), self.m.link_mr_mcrm_line, self.m.discharge_crosswalk, self.s
        )
        return self._keep(partial, "inpatient")

    @cached_property
    def ed_cases(self) -> DataFrame:
        cases = emergency.ed_cases(self.medical, self.cases, self.m.link_mr_mcrm_line, self.riskscr_service, self.s)
        return self._keep(cases, "ed_cases")

    @cached_property
    def snf_cases(self) -> DataFrame:
        return self._keep(snf.open_inpatient_cases(self.outclaims, self.cases, self.s), "snf_cases")

    @cached_property
    def snf_wide(self) -> DataFrame:
        wide = snf.details_snf_wide(self.medical, self.snf_readmissions, self.m.link_mr_mcrm_line, self.riskscr_service, self.s)
        return self._keep(wide, "details_snf")

    @cached_property
    def outpatient_claims(self) -> DataFrame:
        return outpatient.outpatient_claims(self.medical)

    @cached_property
    def assigned(self) -> DataFrame:
        return self._keep(overlap.assigned_by_period(self.client_member_time, self.m.bene_xref, self.m.windows), "assigned")

    @cached_property
    def feed(self) -> DataFrame:
        return self._keep(overlap.feed_by_period(self.m.member_raw_stack, self.m.bene_xref, self.eligibility, self.m.windows), "feed")

    # -- declared results --------------------------------------------------------------

    @cached_property
    def time_windows(self) -> DataFrame:
        return self.m.windows.withColumn("name_client", F.lit(self.s.client))

    @cached_property
    def memcnt(self) -> DataFrame:
        return self._keep(roster.memcnt(self.members, self.decedents, self.s.client), "memcnt")

    @cached_property
    def cost_util(self) -> DataFrame:
        return self._keep(cost_model.cost_util(self.medical, self.pharmacy, self.m.link_mr_mcrm_line, self.s), "cost_util")

    @cached_property
    def memmos(self) -> DataFrame:
        return cost_model.memmos(self.eligibility, self.m.windows, self.members, self.s.client)

    @cached_property
    def ref_prm_line(self) -> DataFrame:
        return cost_model.ref_prm_line(self.m.mr_line_info, self.m.link_mr_mcrm_line, self.m.ref_mcrm_line, self.s)

    @cached_property
    def claims_distribution(self) -> DataFrame:
        return cost_model.claims_distribution(self.member_spend, self.s.client)

    @cached_property
    def office_admin_drug(self) -> DataFrame:
        return cost_model.office_admin_drug(self.drug_claims, self.m.providers, self.s.client)

    @cached_property
    def member_elig(self) -> DataFrame:
        bounds = day_bounds(self.m.windows)
        since = bounds.first if bounds else None
        monthly = cost_model.monthly_status(self._member_time(since), self.m.monthly_elig_status, since)
        return cost_model.member_elig(monthly, self.m.windows, self.members, self.s.client)

    @cached_property
    def member_costs(self) -> DataFrame:
        return cost_model.member_costs(self.member_spend, self.s.client)

    @cached_property
    def cost_util_benchmark(self) -> DataFrame:
        return risk.cost_util_benchmark(self.members, self.m.ref_mcrm_line, self.m.benchmarks_hcg, self.riskscr_service, self.s)

    @cached_property
    def details_inpatient(self) -> DataFrame:
        return self._keep(inpatient.details_inpatient(self.inpatient_partial, self.s.client), "details_inpatient")

    @cached_property
    def details_snf(self) -> DataFrame:
        return self.snf_wide

    @cached_property
    def snf_readmissions(self) -> DataFrame:
        return snf.snf_readmissions(self.snf_cases)

    @cached_property
    def details_snf_professional(self) -> DataFrame:
        lines = snf.snf_professional_claims(self.medical, self.m.mr_line_info)
        details = snf.details_snf_professional(lines, self.m.link_mr_mcrm_line, self.riskscr_service, self.s)
        return self._keep(details, "details_snf_professional")

    # -- metrics -------------------------------------------------------------------------

    @cached_property
    def metrics_basic(self) -> DataFrame:
        return cost_model.metrics_basic(self.basic_aggs_elig_status)

    @cached_property
    def metrics_claims_percentages(self) -> DataFrame:
        return cost_model.metrics_claims_percentages(self.members, self.medical, self.pharmacy, self.s)

    @cached_property
    def metrics_cclf_assign(self) -> DataFrame:
        return overlap.roster_overlap(self.assigned, self.feed, self.s.client)

    @cached_property
    def metrics_optoutcount(self) -> DataFrame:
        return exclusions.metrics_optoutcount(exclusions.bene_exclusion(self.m.bene_exclusion), self.memcnt, self.s.client)

    @cached_property
    def metrics_inpatient(self) -> DataFrame:
        return inpatient.metrics_inpatient(self.inpatient_partial, self.basic_aggs_elig_status, self.riskscr_service, self.s.client)

    @cached_property
    def metrics_discharge_status(self) -> DataFrame:
        return inpatient.metrics_discharge_status(self.details_inpatient, self.s.client)

    @cached_property
    def metrics_outpatient(self) -> DataFrame:
        return outpatient.metrics_outpatient(
            self.outpatient_claims, self.m.mr_line_info, self.m.link_mr_mcrm_line, self.riskscr_service, self.metrics_basic, self.s
        )

    @cached_property
    def metrics_endoflife(self) -> DataFrame:
        return end_of_life.metrics_endoflife(self.memcnt, self.basic_aggs_elig_status, self.s.client)

    @cached_property
    def metrics_snf(self) -> DataFrame:
        return snf.metrics_snf(self.snf_wide, self.basic_aggs_elig_status, self.s.client)

    @cached_property
    def metrics_snf_professional(self) -> DataFrame:
        return snf.metrics_snf_professional(self.details_snf_professional, self.s.client)

    @cached_property
    def metrics_er(self) -> DataFrame:
        return emergency.metrics_er(self.ed_cases, self.s.client)

    METRICS = [
        "metrics_basic", "metrics_claims_percentages", "metrics_cclf_assign", "metrics_optoutcount", "metrics_inpatient",
        "metrics_discharge_status", "metrics_outpatient", "metrics_endoflife", "metrics_snf", "metrics_snf_professional", "metrics_er",
    ]
    #: Labels of delivered fields; a site's own come instead.
    labels = {"elig_status_1": "Beneficiary Status", "metric_id": "Metric Identifier", "metric_name": "Metric Description"}
    DECLARED = [
        "time_windows", "memcnt", "cost_util", "memmos", "ref_prm_line", "claims_distribution", "office_admin_drug", "member_elig",
        "member_costs", "cost_util_benchmark", "details_inpatient", "details_snf", "details_snf_professional", "metrics_key_value",
        "meta_field", "meta_project",
    ]

    @cached_property
    def metrics_key_value(self) -> DataFrame:
        return mart.metrics_key_value({n: getattr(self, n) for n in self.METRICS})

    @cached_property
    def meta_field(self) -> DataFrame:
        return mart.meta_field(self.m.spark, self.schema, self.labels, {}, self.s)

    @cached_property
    def meta_project(self) -> DataFrame:
        return mart.meta_project(self.m.spark, self.schema, self.s)

    def tables(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in self.DECLARED}

    def store(self, folder: str) -> "StoredReport":
        """A mart in this folder, whose declared tables are written when they are first asked for."""
        return StoredReport(self.m.spark, folder, self.schema, self.s, self)

    def write(self, folder: str) -> "StoredReport":
        """Write every declared table with its manifest, then hand back the stored mart for checking and export."""
        return self.store(folder).complete()


class StoredReport:
    """A written mart: its tables and the checks that tie them together. With a ``report`` behind it a table is written, with its
    counts for the manifest, when it is first asked for, and the manifest once all tables stand; nothing is written twice."""

    MANIFESTS = ("manifest", "manifest_fields")

    def __init__(self, spark, folder: str, schema: MartSchema, settings, report: Report | None = None):
        self.spark, self.folder, self.schema, self.s, self.report = spark, folder.rstrip("/"), schema, settings, report
        self._observed: dict[str, dict] = {}
        self._complete = report is None

    def _written(self, name: str) -> None:
        if self.report is not None and name not in self._observed:
            self._observed[name] = write_observed(getattr(self.report, name), self.schema, name, self.folder, self.report.labels)

    def complete(self) -> "StoredReport":
        """Write what is not written yet, and the manifest."""
        if not self._complete:
            for name in self.report.DECLARED:
                self._written(name)
            rows = mart.manifest_rows(self.spark, [self._observed[n] for n in self.report.DECLARED])
            for name, df in zip(self.MANIFESTS, rows):
                write_table(df, f"{self.folder}/{name}")
            self._complete = True
        return self

    def table(self, name: str) -> DataFrame:
        if name in self.MANIFESTS:
            self.complete()
        else:
            self._written(name)
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def tables(self) -> dict[str, DataFrame]:
        return {n: self.table(n) for n in self.schema.tables}

    def rule_results(self) -> DataFrame:
        """Every declared rule of every table with the rows that violate it."""
        return stack([rule_results(df, self.schema, n, self.s.client) for n, df in self.tables().items()])

    def dictionary(self) -> DataFrame:
        return mart.data_dictionary(self.tables(), self.schema)

    def reconciliations(self) -> dict[str, DataFrame]:
        """Every cross-table check by name; all frames must be empty."""
        cu, kv = self.table("cost_util"), self.table("metrics_key_value")
        ip = self.table("details_inpatient")
        out = {
            "memmos": checks.memmos_differ(self.table("memmos"), kv),
            "discharges": checks.metric_differs(cu.where("prm_coverage_type = 'Medical'"), kv, "discharges_sum_all_services", "prm_discharges"),
            "prefix_metrics": checks.prefix_metrics_differ(cu, kv),
            "office_visits": checks.office_visits_differ(cu, kv),
            "details_snf": checks.snf_details_differ(self.table("details_snf"), cu),
            "non_acute": checks.non_acute_rows(ip),
            "member_costs": checks.member_costs_differ(self.table("member_costs"), cu),
            "categories": checks.category_coverage(kv, self.schema),
            "metric_ids": checks.bad_metric_ids(kv),
            "metric_id_unique": checks.duplicate_keys(kv, ["name_client", "time_period", "elig_status_1", "metric_id"]),
            "metric_name_unique": checks.duplicate_keys(kv, ["name_client", "time_period", "elig_status_1", "metric_name"]),
            "labels": checks.label_problems(self.table("meta_field")),
            "client": checks.client_names({n: self.table(n) for n in self.schema.tables}, self.s.client),
        }
        for field, value, prefix, left_out in checks.DETAIL_RULES:
            out[f"details_{field}_{value}"] = checks.details_differ(ip, cu, field, value, prefix, left_out)
        return out
