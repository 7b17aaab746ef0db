"""The report's tables and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from popledger import checks
from popledger.functions.dates import month_end
from popledger.operators.claims import agg_claims, agg_memmos
from popledger.operators.intervals import merge_spans
from popledger.operators.windows import time_windows
from popledger.plans import (
    case_mix, cost_model, end_of_life, emergency, exclusions, fixes, groups, inpatient, mart, outpatient, overlap, roster, scores, snf, supplemental,
)
from popledger.registry.base import ORACLES, QUERIES, long_sql, money, query, ratio, tidy, whole, written
from popledger.oracle.base import grouped_ctes, with_ctes
from popledger.plans.roster import EOL_FLAGS
from popledger.sources.star import StarModel

CLIENT = "'Sample Client' as name_client"
METRIC_COLS = "name_client, time_period, elig_status_1, metric_category, metric_id, metric_name, metric_value"


# -- windows, members ----------------------------------------------------------------


@query(
    "time_windows",
    """
    with p as (select last_day(cast(max(l_shipdate) - interval 1 month as date)) as paid0 from lineitem),
    e as (select paid0, last_day(cast(e0 - to_months(cast(month(e0) % 3 as integer)) as date)) as e from (select paid0, last_day(cast(date_trunc('month', paid0) - interval 2 month as date)) as e0 from p)),
    k as (select *, cast(date_trunc('month', e) - interval 11 month as date) as s from e),
    n as (select paid0, e, s, unnest(generate_series(0, datediff('month', date '1999-01-01', s) // 3)) as k from k where s >= date '1999-01-01'),
    w as (select cast(s - to_months(cast(3*k as integer)) as date) as s, last_day(cast(date_trunc('month', e) - to_months(cast(3*k as integer)) as date)) as e,
                 last_day(cast(date_trunc('month', paid0) - to_months(cast(3*k as integer)) as date)) as p from n)
    select 'Sample Client' as name_client, year(s) || 'Q' || quarter(s) || '_' || year(e) || 'Q' || quarter(e) as time_period, s as inc_start, e as inc_end, p as paid_thru,
      cast(case when s - interval 12 month >= date '1999-01-01' then s - interval 12 month else s end as date) as inc_start_riskscr_features,
      case when s - interval 12 month >= date '1999-01-01' then last_day(cast(e - interval 12 month as date)) else e end as inc_end_riskscr_features,
      case when s - interval 12 month >= date '1999-01-01' then 'Prospective' else 'Concurrent' end as riskscr_period_type
    from w""",
)
def _(r):
    # here the paid-through month is read off the claims: the last full month with shipments
    latest = r.m.table("lineitem").agg(F.max("l_shipdate").cast("date").alias("_latest"))
    params = latest.select(
        month_end("_latest", -1).alias("paid_thru"),
        F.lit(r.s.credible_start).alias("credible_start"), F.lit(r.s.history_cutoff).alias("history_cutoff"),
    )
    return time_windows(params, r.s.runout_months).withColumn("name_client", F.lit(r.s.client))


@query("spans_merged", "select member_id, date_start, date_end from spans")
def _(r):
    return merge_spans(r.m.order_spans, ["member_id"], "date_start", "date_end")


@query("member_roster", "select member_id, time_period, elig_status_1, mem_prv_id_align, prv_name_align, riskscr_1_type from roster")
def _(r):
    return roster.member_roster(r.eligibility, r.m.member, r.m.windows)


@query(
    "members",
    f"""select member_id, time_period, elig_status_1, mem_prv_id_align, prv_name_align, riskscr_1_type, dob, gender, mem_name, {whole('age')} as age,
    {ratio('memmos')} as memmos, {ratio('riskscr_1')} as riskscr_1, {ratio('riskscr_memmos')} as riskscr_memmos from mem""",
)
def _(r):
    return r.members


@query("members_assign", f"select {CLIENT}, member_id, time_period, elig_status_1, {ratio('memmos')} as memmos from mem")
def _(r):
    return mart.members_assign(r.members, r.s.client).select("name_client", "member_id", "time_period", "elig_status_1", "memmos")


_FLAGS = ", ".join(EOL_FLAGS)


@query(
    "decedents",
    f"select member_id, time_period, {_FLAGS}, {whole('final_hospice_days')} as final_hospice_days, {money('costs_final_30_days')} as costs_final_30_days, deceased_hospital_yn from dec",
)
def _(r):
    return r.decedents


@query(
    "memcnt",
    f"""select {CLIENT}, time_period, elig_status_1, deceased_yn, deceased_hospital_yn, {_FLAGS}, final_hospice_days, risk_score_type,
    {money('costs_final_30_days_sum')} as costs_final_30_days_sum, {ratio('riskscr_wgt')} as riskscr_wgt, {ratio('riskscr_avg')} as riskscr_avg, memcnt,
    {ratio('riskscr_cred')} as riskscr_cred, {ratio('age_avg')} as age_avg from mc""",
)
def _(r):
    return r.memcnt


_OVERLAP = f"""
    select {CLIENT}, f.time_period, f.elig_status_1, 'Basic' as metric_category, 'cnt_cclf_mems_in_assignment' as metric_id,
      'Count of CCLF Members with Assignment Information' as metric_name, {ratio('sum(case when a.member_id is null then 0 else 1 end)')} as metric_value
    from feed f left join (select distinct member_id, time_period from assigned) a using (time_period, member_id) where died_in_period = 0 group by all
    union all
    select {CLIENT}, a.time_period, 'All', 'Basic', 'pct_assigned_mems_in_cclf', 'Percent of Assigned Members with CCLF Information',
      {ratio('avg(case when f.member_id is null then 0 else 1 end)')} from assigned a left join (select distinct member_id, time_period from feed) f using (time_period, member_id) group by all
    union all
    select {CLIENT}, time_period, 'All', 'Basic', 'cnt_assigned_mems', 'Count of Assigned Members', {ratio('count(*)')} from assigned group by all"""


@query("roster_overlap", _OVERLAP)
def _(r):
    return r.metrics_cclf_assign


# -- risk and benchmarks ----------------------------------------------------------------


@query(
    "riskscr_service",
    f"select time_period, elig_status_1, mcrm_line, {ratio('riskscr_1_util_avg')} as riskscr_1_util_avg, {ratio('riskscr_1_cost_avg')} as riskscr_1_cost_avg, {ratio('memmos_sum')} as memmos_sum from rs",
)
def _(r):
    return r.riskscr_service


@query(
    "benchmarks",
    f"""select {CLIENT}, d.time_period, m.mcrm_line, d.elig_status_1, loosely_well as type_benchmark, {ratio('riskscr_1_util_avg')} as riskscr_service_avg_util,
      {ratio('riskscr_1_cost_avg')} as riskscr_service_avg_cost, {ratio('case when admits_per1k is not null then admits_per1k * riskscr_1_util_avg else 0 end')} as benchmark_discharges_per1k,
      {ratio("case when upper(util_type) = 'DAYS' then coalesce(util_per1k, 0) * riskscr_1_util_avg else 0 end")} as benchmark_days_per1k,
      {ratio('coalesce(util_per1k, 0) * riskscr_1_util_avg')} as benchmark_util_per1k
    from (select distinct time_period, elig_status_1 from mem) d cross join (select * from mcrm where upper(lob) = 'MEDICARE') m join bench using (lob, mcrm_line)
      left join rs on rs.time_period = d.time_period and rs.elig_status_1 = d.elig_status_1 and rs.mcrm_line = m.mcrm_line""",
)
def _(r):
    return r.cost_util_benchmark


# -- cost model ----------------------------------------------------------------------------


@query(
    "agg_claims",
    f"""select time_period, prm_line, {whole('sum(prm_admits)')} as discharges, {whole('sum(prm_util)')} as prm_util, {money('sum(prm_costs)')} as prm_costs,
    {money('sum(allowed)')} as allowed, {money('sum(paid)')} as paid, count(*) as claim_lines, prv_net_aco_yn from pm group by all""",
)
def _(r):
    return agg_claims(r.outclaims, r.m.windows, ["prm_line", "prv_net_aco_yn"])


@query(
    "agg_memmos",
    f"""select time_period, elig_status_1, {ratio("sum(case when cover_medical = 'Y' then n else 0 end)")} as memmos_medical, {ratio("sum(case when cover_rx = 'Y' then n else 0 end)")} as memmos_rx from (
      select elig.*, time_period, datediff('month', greatest(date_start, inc_start), least(date_end, inc_end)) + 1 as n from elig join win on date_start <= inc_end and date_end >= inc_start) group by all""",
)
def _(r):
    return agg_memmos(r.eligibility, r.m.windows, ["elig_status_1"])


_CU = f"""select name_client, time_period, prm_line, mcrm_line, elig_status_1, prv_net_aco_yn, {whole('prm_discharges')} as prm_discharges, {whole('prm_days')} as prm_days,
    {whole('prm_util')} as prm_util, {money('prm_costs')} as prm_costs, {money('prm_allowed')} as prm_allowed, {money('prm_paid')} as prm_paid, prm_coverage_type from cu"""


@query("cost_util", _CU)
def _(r):
    return r.cost_util


_MEMMOS = f"""select {CLIENT}, time_period, elig_status_1, prm_coverage_type, {ratio('n')} as prm_memmos from (
      select time_period, elig_status_1, 'Medical' as prm_coverage_type, sum(mm.memmos_medical) as n from mm join mem using (member_id, time_period) group by all
      union all select time_period, elig_status_1, 'Rx', sum(mm.memmos_rx) from mm join mem using (member_id, time_period) group by all)"""


@query("memmos", _MEMMOS)
def _(r):
    return r.memmos


@query(
    "ref_lines",
    f"""select {CLIENT}, l.mr_line as prm_line, prm_line_desc, k.mcrm_line, mcrm_line_desc_l1, mcrm_line_desc_l2, mcrm_line_desc_l3, mcrm_line_desc_l4, mcrm_line_desc_l5, mcrm_line_desc_l6,
      costmodel_util as prm_util_type, prm_coverage_type from mrline l join linkall k on l.mr_line = k.mr_line and upper(k.lob) = 'MEDICARE' left join mcrm m on m.lob = k.lob and m.mcrm_line = k.mcrm_line""",
)
def _(r):
    return r.ref_prm_line


_BUCKET = "case " + " ".join(f"when c <= {b} then '{label}'" for b, label in cost_model.COST_BUCKETS) + f" else '{cost_model.COST_BUCKET_BEYOND}' end"


@query(
    "claims_distribution",
    f"""select {CLIENT}, time_period, elig_status_1, {_BUCKET} as cost_bucket, count(*) as member_count, {money('sum(c)')} as prm_costs from (
      select member_id, time_period, elig_status_1, cast(cast(sum(prm_costs) as double) / max(memmos) * 12 as decimal(24,6)) as c from lim group by all) group by all""",
)
def _(r):
    return r.claims_distribution


@query(
    "office_drug",
    f"""select {CLIENT}, time_period, elig_status_1, s.providerid, claim_count, coalesce(prv_name, 'Unknown') as provider, coalesce(prv_specialty, 'XX') as specialty, hcpcs, {money('prm_costs')} as prm_costs from (
      select time_period, elig_status_1, coalesce(hcpcs, 'XXXXX') as hcpcs, coalesce(providerid, 'Unknown') as providerid, count(*) as claim_count, sum(prm_costs) as prm_costs
      from lim where mcrm_line in ('O16', 'P34') group by all) s left join prov on s.providerid = prv_id""",
)
def _(r):
    return r.office_admin_drug


_BA = f"""{ratio('memmos_sum')} as memmos_sum, {ratio('memmos_sum_riskadj')} as memmos_sum_riskadj, {ratio('riskscr_1_avg')} as riskscr_1_avg,
    {money('prm_costs_sum_all_services')} as prm_costs_sum_all_services, {whole('discharges_sum_all_services')} as discharges_sum_all_services"""


@query("basic_aggs_elig_status", f"select {CLIENT}, time_period, elig_status_1, 'Basic' as metric_category, {_BA} from ba")
def _(r):
    return r.basic_aggs_elig_status


@query(
    "basic_aggs",
    f"""select {CLIENT}, time_period, 'Basic' as metric_category, {_BA} from (
      select time_period, sum(memmos_sum) as memmos_sum, sum(memmos_sum_riskadj) as memmos_sum_riskadj, sum(riskscr_1_avg * b.memmos_sum) / sum(b.memmos_sum) as riskscr_1_avg,
        sum(prm_costs_sum_all_services) as prm_costs_sum_all_services, sum(discharges_sum_all_services) as discharges_sum_all_services from ba b group by 1)""",
)
def _(r):
    return cost_model.basic_aggs(r.basic_aggs_elig_status)


_METRICS_BASIC = long_sql("ba", {m: (label, m) for m, label in cost_model.BASIC_LABELS.items()}, "Basic")


@query("metrics_basic", _METRICS_BASIC)
def _(r):
    return r.metrics_basic


_PCT_SRC = """(select m.time_period, m.elig_status_1, avg(case when a.member_id is null then 0.0 else 1.0 end) as med, avg(case when b.member_id is null then 0.0 else 1.0 end) as rx,
      avg(case when a.member_id is null and b.member_id is null then 0.0 else 1.0 end) as anyc
    from mem m left join (select distinct member_id, time_period from pm) a using (member_id, time_period) left join (select distinct member_id, time_period from prx) b using (member_id, time_period) group by all)"""
_PCT = long_sql(_PCT_SRC, dict(zip(cost_model.CLAIM_SHARE_LABELS, [(l, c) for l, c in zip(cost_model.CLAIM_SHARE_LABELS.values(), ["med", "rx", "anyc"])])), "Basic")


@query("pct_with_claims", _PCT)
def _(r):
    return r.metrics_claims_percentages


@query(
    "member_elig",
    f"""select {CLIENT}, member_id, time_period, elig_status as elig_status_1, {ratio('sum(f.memmos)')} as elig_months from (
      select *, coalesce(last_value(reported ignore nulls) over (partition by member_id order by elig_month desc rows unbounded preceding), elig_status_1) as elig_status from (
        select t.member_id, t.elig_month, t.memmos, t.elig_status_1, s.elig_status as reported from mtime t left join mstatus s on s.hicno = t.member_id and s.date_elig_start + 14 = t.elig_month)) f
      join win on elig_month between inc_start and inc_end join mem using (member_id, time_period) group by all""",
)
def _(r):
    return r.member_elig


@query("member_elig_roster", f"select {CLIENT}, member_id, time_period, elig_status_1, {ratio('sum(memmos)')} as elig_months from mem group by all")
def _(r):
    return cost_model.member_elig_from_roster(r.members, r.s.client)


@query("member_costs", f"select {CLIENT}, member_id, time_period, {money('sum(paid)')} as total_cost from lim group by all")
def _(r):
    return r.member_costs


_OPT = f"""select {CLIENT}, time_period, 'Basic' as metric_category, 'All' as elig_status_1, 'opt_out_count' as metric_id, 'Number of Beneficiaries Opting Out of Data Sharing' as metric_name,
    {ratio("(select count(*) from beneexc where upper(beneexcreason) = 'BENEFICIARY DECLINED')")} as metric_value from (select distinct time_period from mc)"""


@query(
    "overlap_limits",
    f"""select 'feed_in_assignment' as measure, time_period, elig_status_1, {ratio('v')} as value, round(v, 4) > 0.1 and round(v, 4) <= 1 as plausible from (
      select time_period, elig_status_1, avg(case when a.member_id is null then 0.0 else 1.0 end) as v from feed f left join (select distinct member_id, time_period from assigned) a using (member_id, time_period)
      where died_in_period = 0 and time_period = (select max(time_period) from feed where died_in_period = 0) group by 1, 2)
    union all select 'assigned_in_feed', time_period, 'All', {ratio('v')}, round(v, 4) > 0.2 and round(v, 4) < 1 from (
      select time_period, avg(case when f.member_id is null then 0.0 else 1.0 end) as v from assigned a left join (select distinct member_id, time_period from feed) f using (member_id, time_period)
      where time_period = (select max(time_period) from assigned) group by 1)""",
)
def _(r):
    return overlap.overlap_limits(r.assigned, r.feed)


@query("opt_out", _OPT)
def _(r):
    return r.metrics_optoutcount


# -- inpatient ------------------------------------------------------------------------------------

_IPD = """time_period, elig_status_1, prv_id_inpatient, discharge_status_code, discharge_status_desc, drg_inpatient, drg_version_inpatient, acute_yn, medical_surgical, inpatient_pqi_yn,
    prm_ahrq_pqi, inpatient_discharge_to_snf_yn, preference_sensitive_yn, prm_pref_sensitive_category, inpatient_readmit_potential_yn, inpatient_readmit_yn, los_inpatient"""


@query(
    "inpatient_details",
    f"select {CLIENT}, {_IPD}, {whole('cnt_discharges_inpatient')} as cnt_discharges_inpatient, {whole('sum_days_inpatient')} as sum_days_inpatient, {money('sum_costs_inpatient')} as sum_costs_inpatient from ipd",
)
def _(r):
    return r.details_inpatient


_N = "cnt_discharges_inpatient"
_IP_EXPR = {
    "pqi": f"sum(case when inpatient_pqi_yn = 'Y' then {_N} else 0 end)",
    "pref_sens": f"sum(case when preference_sensitive_yn = 'Y' then {_N} else 0 end)",
    "Num_1_Day_LOS": f"sum(case when los_inpatient = 1 then {_N} else 0 end)",
    "Denom_1_Day_LOS": f"sum({_N})",
    "Num_1_Day_LOS_Medical": f"sum(case when medical_surgical = 'Medical' and los_inpatient = 1 then {_N} else 0 end)",
    "Denom_1_day_LOS_Medical": f"sum(case when medical_surgical = 'Medical' then {_N} else 0 end)",
    "pct_acute_IP_costs": "cast(sum(case when acute_yn = 'Y' then sum_costs_inpatient else 0 end) as double) / nullif(cast(max(prm_costs_sum_all_services) as double), 0)",
    "pct_IP_disch_to_SNF": f"cast(sum(case when inpatient_discharge_to_snf_yn = 'Y' then {_N} else 0 end) as double) / nullif(sum({_N}), 0)",
    "pct_ip_readmits": f"cast(sum(case when inpatient_readmit_yn = 'Y' then {_N} else 0 end) as double) / nullif(sum(case when inpatient_readmit_potential_yn = 'Y' then {_N} else 0 end), 0)",
    "cnt_ip_readmits": f"sum(case when inpatient_readmit_yn = 'Y' then {_N} else 0 end)",
    "cnt_pot_readmits": f"sum(case when inpatient_readmit_potential_yn = 'Y' then {_N} else 0 end)",
    "acute": f"sum(case when acute_yn = 'Y' then {_N} else 0 end)",
    "acute_riskadj": f"sum(case when acute_yn = 'Y' then {_N} / riskscr_1_util_avg else 0 end)",
    "surgical": f"sum(case when medical_surgical = 'Surgical' then {_N} else 0 end)",
    "surgical_riskadj": f"sum(case when medical_surgical = 'Surgical' then {_N} / riskscr_1_util_avg else 0 end)",
    "medical": f"sum(case when medical_surgical = 'Medical' then {_N} else 0 end)",
    "medical_riskadj": f"sum(case when medical_surgical = 'Medical' then {_N} / riskscr_1_util_avg else 0 end)",
    "medical_general": f"sum(case when lower(prm_line) = 'i11a' then {_N} else 0 end)",
    "medical_general_riskadj": f"sum(case when lower(prm_line) = 'i11a' then {_N} / riskscr_1_util_avg else 0 end)",
}
_IP_SRC = "(select time_period, elig_status_1, " + ", ".join(f"{e} as {m}" for m, e in _IP_EXPR.items()) + """ from ipp
    left join (select time_period, elig_status_1, prm_costs_sum_all_services from ba) using (time_period, elig_status_1) left join rs using (time_period, elig_status_1, mcrm_line) group by 1, 2)"""
_IP_SQL = long_sql("ipm", {m: (inpatient.LABELS[m], m) for m in _IP_EXPR}, "Inpatient") + f"""
    union all select {CLIENT}, time_period, elig_status_1, 'Inpatient', prm_ahrq_pqi || '_admits', 'Admits for ' || prm_ahrq_pqi, {ratio(f'sum({_N})')} from ipp where inpatient_pqi_yn = 'Y' group by time_period, elig_status_1, prm_ahrq_pqi
    union all select {CLIENT}, time_period, elig_status_1, 'Inpatient', lower('psa_admits_' || regexp_replace(prm_pref_sensitive_category, '[^A-Za-z]', '', 'g')), 'Admits for PSA - ' || prm_pref_sensitive_category,
      {ratio(f'sum({_N})')} from ipp where preference_sensitive_yn = 'Y' group by time_period, elig_status_1, prm_pref_sensitive_category"""
from popledger.oracle.base import CTE  # noqa: E402

CTE["ipm"] = f"select * from {_IP_SRC}"


@query("inpatient_metrics", _IP_SQL, staged=["inpatient"])
def _(r):
    return r.metrics_inpatient


@query(
    "case_by_member_remerge",
    f"""select {CLIENT}, time_period, member_id, elig_status_1, 'Quality indicator ' || prm_ahrq_pqi as pqi_full_desc, {whole('sum(discharges)')} as case_count
    from ipc join mem using (member_id, time_period) where prm_ahrq_pqi = 'PQI08' and time_period = (select max(time_period) from ipc) group by all having sum(discharges) > 0""",
)
def _(r):
    return inpatient.heart_failure_by_mem(r.inpatient_claims, r.members, r.m.prm_ahrq_pqi, r.s.client)


_DS_SQL = f"""select {CLIENT}, time_period, elig_status_1, 'discharge_status' as metric_category, metric_id, 'Count of Inpatient Discharges with ' || metric_id || ' status' as metric_name, {ratio(f'sum({_N})')} as metric_value
    from (select *, case when regexp_matches(discharge_status_desc, '\\bHome Health\\b', 'i') then 'discharge_to_home_health' else 'discharge_to_' ||
      case when split_part(discharge_status_desc, ' ', -1) = 'Died' then 'death' else lower(split_part(discharge_status_desc, ' ', -1)) end end as metric_id from ipd) group by all"""


@query("discharge_status", _DS_SQL)
def _(r):
    return r.metrics_discharge_status


# -- case mix ---------------------------------------------------------------------------------------

CTE["cmc"] = """select time_period, prv_id_inpatient, discharge_status_desc, drg_inpatient || '_' || drg_version_inpatient as drg, sum(cnt_discharges_inpatient) as discharges_sum
    from ipd group by all having sum(cnt_discharges_inpatient) > 0"""


@query(
    "case_mix_raw",
    f"""select time_period, prv_id_inpatient, discharge_status_desc, {whole('n')} as report_dischstatus_raw_cnt, {whole('sum(n) over (partition by time_period, prv_id_inpatient)')} as report_level_raw_cnt,
      {ratio('n / sum(n) over (partition by time_period, prv_id_inpatient)')} as mu_raw from (select time_period, prv_id_inpatient, discharge_status_desc, cast(sum(discharges_sum) as double) as n from cmc group by all)""",
)
def _(r):
    return case_mix.raw_shares(case_mix.case_counts(r.details_inpatient))


@query(
    "case_mix_cells",
    f"""select c.time_period, c.prv_id_inpatient, c.drg, s.discharge_status_desc, {whole('c.trials')} as trials, {whole('coalesce(h.successes, 0)')} as successes
    from (select time_period, prv_id_inpatient, drg, sum(discharges_sum) as trials from cmc group by all) c join (select distinct time_period, discharge_status_desc from cmc) s using (time_period)
    left join (select time_period, prv_id_inpatient, drg, discharge_status_desc, sum(discharges_sum) as successes from cmc group by all) h
      on h.time_period = c.time_period and h.prv_id_inpatient = c.prv_id_inpatient and h.drg = c.drg and h.discharge_status_desc = s.discharge_status_desc""",
)
def _(r):
    return case_mix.one_vs_rest(case_mix.case_counts(r.details_inpatient))


_CASE_MIX: dict = {}
CASE_MIX_ROUNDS = 12


def _case_mix_fit(spark, path):
    """The fit of a folder is solved once per application; its rounds are tables in the shared folder."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _CASE_MIX:
        r, _ = written(spark, path)
        counts = r._keep(case_mix.case_counts(r.details_inpatient), "case_counts")
        cells = case_mix.fit_cells(counts, r._keep, rounds=CASE_MIX_ROUNDS)
        _CASE_MIX[key] = case_mix.normalised(case_mix.fit_shares(cells), case_mix.raw_shares(counts))
    return _CASE_MIX[key]


def _case_mix_sql(rounds: int) -> str:
    """The rounds written out: f<r> holds the cells after round r."""
    p, block = "(1 / (1 + exp(-(b + u + v))))", "time_period, discharge_status_desc"
    miss, weight = f"sum(successes - trials * {p})", f"sum(trials * {p} * (1 - {p}))"
    step = lambda g, h: f"greatest(-1.0, least(1.0, ({g}) / ({h})))"
    out = ["""f0 as materialized (
    select c.time_period, c.prv_id_inpatient, c.drg, s.discharge_status_desc, cast(c.trials as double) as trials, cast(coalesce(h.successes, 0) as double) as successes,
      0.0::double as b, 0.0::double as u, 0.0::double as v, 1.0::double as var_level, 1.0::double as var_drg, 0.0::double as largest
    from (select time_period, prv_id_inpatient, drg, sum(discharges_sum) as trials from cmc group by all) c join (select distinct time_period, discharge_status_desc from cmc) s using (time_period)
    left join (select time_period, prv_id_inpatient, drg, discharge_status_desc, sum(discharges_sum) as successes from cmc group by all) h
      on h.time_period = c.time_period and h.prv_id_inpatient = c.prv_id_inpatient and h.drg = c.drg and h.discharge_status_desc = s.discharge_status_desc)"""]
    for r in range(rounds):
        out.append(f"""fb{r} as materialized (
    select f.* replace (b + step as b, abs(step) as largest) from f{r} f join (select {block}, {step(miss, weight)} as step from f{r} group by all) s using ({block}))""")
        for n, (of, effect, variance, bound) in enumerate((
            ("prv_id_inpatient", "u", "var_level", f"greatest(spread, {case_mix.MIN_LEVEL_VARIANCE})"), ("drg", "v", "var_drg", f"least(spread, {case_mix.MAX_TYPE_VARIANCE})"),
        )):
            before, after, held = (f"fb{r}", f"fu{r}")[n], (f"fu{r}", f"f{r + 1}")[n], f"(1 / any_value({variance}))"
            out.append(f"""e{n}_{r} as materialized (
    select {block}, {of}, any_value({effect}) as old, {step(f"{miss} - any_value({effect}) * {held}", f"{weight} + {held}")} as step, {weight} + {held} as information
    from {before} group by all)""")
            out.append(f"""{after} as materialized (
    select f.* replace (e.old + e.step - mid as {effect}, f.b + mid as b, {bound} as {variance}, greatest(f.largest, g.step) as largest) from {before} f join e{n}_{r} e using ({block}, {of})
    join (select {block}, avg(old + step) as mid, avg((old + step) * (old + step) + 1 / information) - mid * mid as spread, max(abs(step)) as step from e{n}_{r} group by all) g using ({block}))""")
    out.append(f"""fit as materialized (
    select {block}, prv_id_inpatient, 1 / (1 + exp(-(any_value(b) + any_value(u)))) as mu, any_value(var_level) as var_level, any_value(var_drg) as var_drg, any_value(largest) as largest
    from f{rounds} group by all),
  fitted as materialized (
    select time_period, prv_id_inpatient, discharge_status_desc, mu, var_level, var_drg, largest, sum(mu) over (partition by time_period, prv_id_inpatient) as total, n.n as size, coalesce(h.n, 0) as own
    from fit join (select time_period, prv_id_inpatient, cast(sum(discharges_sum) as double) as n from cmc group by all) n using (time_period, prv_id_inpatient)
    left join (select time_period, prv_id_inpatient, discharge_status_desc, cast(sum(discharges_sum) as double) as n from cmc group by all) h using (time_period, prv_id_inpatient, discharge_status_desc))""")
    return ",\n".join(out)


QUERIES["case_mix_fit"] = lambda spark, path: tidy(_case_mix_fit(spark, path))
ORACLES["case_mix_fit"] = with_ctes(f"""select * from (with {_case_mix_sql(CASE_MIX_ROUNDS)}
    select time_period, prv_id_inpatient, discharge_status_desc, {ratio('mu')} as mu, {ratio('var_level')} as var_level, {ratio('var_drg')} as var_drg,
      {ratio('largest')} as largest_step, largest <= 0.05 as converged, {ratio('total')} as report_level_slop_total, {whole('size')} as report_level_raw_cnt,
      {whole('own')} as report_dischstatus_raw_cnt, {ratio('own / size')} as mu_raw, {ratio('mu / total')} as mu_normalized from fitted)""")


def _case_mix_sums(spark, path):
    """What holds for every fit: shares of a provider add up to one, over all statuses of the window, each within bounds."""
    fitted = _case_mix_fit(spark, path)
    return tidy(fitted.groupBy("time_period", "prv_id_inpatient").agg(
        F.count(F.lit(1)).alias("statuses"), F.round(F.sum("mu_normalized"), 3).alias("total"),
        F.min(F.col("mu_normalized").between(0, 1)).alias("within"), F.min("converged").alias("converged"),
    ))


QUERIES["case_mix_sums"] = _case_mix_sums
ORACLES["case_mix_sums"] = with_ctes("""
    select p.time_period, p.prv_id_inpatient, s.n as statuses, cast(1.0 as double) as total, true as within, true as converged
    from (select distinct time_period, prv_id_inpatient from cmc) p join (select time_period, count(distinct discharge_status_desc) as n from cmc group by 1) s using (time_period)""")


def _case_mix_distortion(spark, path):
    return tidy(case_mix.distortion(_case_mix_fit(spark, path)))


QUERIES["case_mix_distortion"] = _case_mix_distortion
ORACLES["case_mix_distortion"] = with_ctes(f"""select * from (with {_case_mix_sql(CASE_MIX_ROUNDS)}
    select time_period, discharge_status_desc, {ratio('sum(own) / sum(size)')} as mu_comp_raw, {ratio('sum(mu * size) / sum(size)')} as mu_comp_slop,
      {ratio('sum(mu / total * size) / sum(size)')} as mu_comp_normalized, {ratio('any_value(var_drg)')} as cov_drg_estimate, {ratio('any_value(var_level)')} as cov_rpt_estimate
    from fitted group by all)""")


# -- outpatient, end of life, nursing facility, emergency --------------------------------------------

_OP_SQL = f"""select {CLIENT}, time_period, elig_status_1, 'outpatient' as metric_category, metric_id, metric_name, {ratio('raw')} as metric_value from opu
    union all select {CLIENT}, time_period, elig_status_1, 'outpatient', metric_id || '_riskadj', metric_name || ', Risk Adjusted', {ratio('adj')} from opu
    union all select {CLIENT}, time_period, elig_status_1, 'outpatient', 'pct_office_visits_pcp', '% Primary Care Office Visits', {ratio("cast(sum(case when lower(prm_line) = 'p32c' then prm_util else 0 end) as double) / nullif(sum(prm_util), 0)")}
      from opc where lower(prm_line) in ('p32c', 'p32d') group by time_period, elig_status_1"""


@query("outpatient_metrics", _OP_SQL)
def _(r):
    return r.metrics_outpatient


def _n(cond: str, what: str = "memcnt") -> str:
    return f"sum(case when {cond} then {what} else 0 end)"


_DEAD, _DAYS = "deceased_yn = 'Y'", "final_hospice_days"


def _div(a: str, b: str) -> str:
    return f"cast({a} as double) / nullif(cast({b} as double), 0)"


_dead_n = _n(_DEAD)
_cost = _n(_DEAD, "costs_final_30_days_sum")
_hosp = _n(f"{_DEAD} and deceased_hospital_yn = 'Y'")
_chemo, _cancer = _n("endoflife_numer_yn_chemolt14days = 'Y'"), _n("endoflife_denom_yn_chemolt14days = 'Y'")
_lt3, _lt3d = _n("endoflife_numer_yn_hospicelt3day = 'Y'"), _n("endoflife_denom_yn_hospicelt3day = 'Y'")
_nev, _nevd = _n("endoflife_numer_yn_hospicenever = 'Y'"), _n("endoflife_denom_yn_hospicenever = 'Y'")
_h3, _h = _n(f"{_DAYS} < 3 and {_DAYS} > 0"), _n(f"{_DAYS} > 0")
_h0, _h6 = _n(f"{_DAYS} = 0 and {_DEAD}"), _n(f"{_DAYS} > 365.25 / 2")
_EOL_EXPR = {
    "mortality_rate": _div(_dead_n, "sum(memcnt)"),
    "decedent_count": _dead_n,
    "rsk_adj_mortality_rate": f"({_div(_dead_n, 'sum(memcnt)')}) / max(riskscr_1_avg)",
    "rsk_adj_decedent_count": f"{_dead_n} / max(riskscr_1_avg)",
    "avg_cost_final_30days": _div(_cost, _dead_n),
    "tot_cost_final_30days": _cost,
    "avg_cost_final_30days_riskadj": f"({_div(_cost, _dead_n)}) / max(riskscr_1_avg)",
    "tot_cost_final_30days_riskadj": f"cast({_cost} as double) / max(riskscr_1_avg)",
    "pct_death_in_hosp": _div(_hosp, _dead_n),
    "cnt_death_in_hosp": _hosp,
    "pct_chemo": _div(_chemo, _cancer),
    "cnt_chemo": _chemo,
    "cnt_cancer": _cancer,
    "cnt_cancer_hospice": _lt3d,
    "pct_cancer_hospice_lt3days": _div(_lt3, _lt3d),
    "cnt_cancer_hospice_lt3days": _lt3,
    "pct_cancer_hospice_never": _div(_nev, _nevd),
    "cnt_cancer_hospice_never": _nev,
    "pct_hospice_lt3days": _div(_h3, _h),
    "cnt_hospice_lt3days": _h3,
    "pct_hospice_never": _div(_h0, _dead_n),
    "cnt_hospice_never": _h0,
    "pct_hospice_gt_6months": _div(_h6, _dead_n),
    "cnt_hospice_gt_6months": _h6,
}
CTE["eol"] = "select time_period, elig_status_1, " + ", ".join(f"{e} as {m}" for m, e in _EOL_EXPR.items()) + " from mc left join (select time_period, elig_status_1, riskscr_1_avg from ba) using (time_period, elig_status_1) group by 1, 2"
_EOL_SQL = long_sql("eol", {m: (end_of_life.LABELS[m], m) for m in _EOL_EXPR}, "end_of_life", "where metric_value is not null")


@query("end_of_life", _EOL_SQL)
def _(r):
    return r.metrics_endoflife


@query("snf_readmissions", "select member_id, caseadmitid from snfre")
def _(r):
    return r.snf_readmissions


@query(
    "snf_details",
    f"""select {CLIENT}, time_period, elig_status_1, prv_id_snf, snf_readmit_yn, los_snf, {whole('cnt_discharges_snf')} as cnt_discharges_snf, {whole('sum_days_snf')} as sum_days_snf,
    {money('sum_costs_snf')} as sum_costs_snf, {ratio('d_adj')} as cnt_discharges_snf_riskadj, {ratio('u_adj')} as sum_days_snf_riskadj, {ratio('c_adj')} as sum_costs_snf_riskadj from snfd""",
)
def _(r):
    return r.snf_wide


_SNF_EXPR = {
    "distinct_SNFs": "count(distinct prv_id_snf)", "SNF": "sum(cnt_discharges_snf)", "SNF_rskadj": "sum(d_adj)",
    "pct_SNF_costs": _div("sum(sum_costs_snf)", "max(prm_costs_sum_all_services)"), "alos": _div("sum(sum_days_snf)", "sum(cnt_discharges_snf)"),
    "avg_cost_per_day": _div("sum(sum_costs_snf)", "sum(sum_days_snf)"), "avg_cost_per_discharge": _div("sum(sum_costs_snf)", "sum(cnt_discharges_snf)"),
    "number_SNF_over_21_days": "sum(case when los_snf > 21 then cnt_discharges_snf else 0 end)",
    "number_SNF_readmit": "sum(case when snf_readmit_yn = 'Y' then cnt_discharges_snf else 0 end)",
}
CTE["snfm"] = "select time_period, elig_status_1, " + ", ".join(f"{e} as {m}" for m, e in _SNF_EXPR.items()) + """ from snfd
    left join (select time_period, elig_status_1, prm_costs_sum_all_services from ba) using (time_period, elig_status_1) group by 1, 2 having sum(cnt_discharges_snf) > 0 and sum(sum_days_snf) > 0"""
_SNF_SQL = long_sql("snfm", {m: (snf.LABELS[m], m) for m in _SNF_EXPR}, "SNF")


@query("snf_metrics", _SNF_SQL)
def _(r):
    return r.metrics_snf


@query("professional_link", f"select {CLIENT}, time_period, elig_status_1, prv_id_snf, {money('sum_costs_prof_snf')} as sum_costs_prof_snf, {ratio('c_adj')} as sum_costs_prof_snf_riskadj from profd")
def _(r):
    return r.details_snf_professional


_PROF_SQL = long_sql(
    "(select time_period, elig_status_1, count(distinct prv_id_snf) as a, sum(sum_costs_prof_snf) as b from profd group by 1, 2)",
    {"distinct_prof_SNFs": (snf.PROFESSIONAL_LABELS["distinct_prof_SNFs"], "a"), "prof_SNF_costs": (snf.PROFESSIONAL_LABELS["prof_SNF_costs"], "b")}, "SNF",
)


@query("professional_metrics", _PROF_SQL)
def _(r):
    return r.metrics_snf_professional


_ED_SRC = "(select time_period, elig_status_1, sum(prm_util) as ED, sum(prm_util / riskscr_1_util_avg) as ED_rskadj, " + ", ".join(
    f"sum({c} * prm_util) as {m}" for m, c in emergency.CLASSES.items()
) + " from edc group by 1, 2)"
_ED_SQL = long_sql(_ED_SRC, {m: (label, m) for m, label in emergency.LABELS.items()}, "ER")


@query("ed_metrics", _ED_SQL)
def _(r):
    return r.metrics_er


@query(
    "ed_by_member",
    f"""select {CLIENT}, time_period, member_id, elig_status_1, {whole('sum(prm_util)')} as "ED_util", {ratio('sum(prm_nyu_emergent_primary_care * prm_util)')} as "ED_emer_pricare",
    {ratio('sum(prm_nyu_emergent_primary_care * prm_util) / sum(prm_util)')} as "ED_prct_pricare" from edc where time_period = (select max(time_period) from edc)
    group by all having sum(prm_nyu_emergent_primary_care * prm_util) > 0""",
)
def _(r):
    return emergency.ed_prev_by_mem(r.ed_cases, r.s.client)


# -- stack, mart, checks over the mart ------------------------------------------------------------------


def _cols(sql: str) -> str:
    return f"select {METRIC_COLS} from ({sql})"


_KV_SQL = "\nunion all\n".join(
    _cols(s) for s in [_METRICS_BASIC, _PCT, _OVERLAP, _OPT, _IP_SQL, _DS_SQL, _OP_SQL, _EOL_SQL, _SNF_SQL, _PROF_SQL, _ED_SQL]
)


@query("metrics_key_value", _KV_SQL, staged=True)
def _(r):
    return r.metrics_key_value


# -- corrections, groups, supplemental ----------------------------------------------------------------------


@query("version_fix", "select prm_line, case when prm_fromdate >= date '2000-10-01' and icdversion = '09' then '10' else icdversion end as icdversion, count(*) as n, min(prm_fromdate) as first_day from med group by all")
def _(r):
    from datetime import date

    fixed = fixes.version_fix(r.outclaims, start=date(2000, 10, 1))
    return fixed.groupBy("prm_line", "icdversion").agg(F.count(F.lit(1)).alias("n"), F.min("prm_fromdate").alias("first_day"))


CTE["signed"] = """select caseadmitid, prm_line, prm_fromdate, case when l_linenumber = 7 then -prm_util else prm_util end as prm_util, case when l_linenumber = 7 then cast(0.0001 as decimal(18,4)) else prm_costs end as prm_costs, prm_admits
    from (select *, cast(linenum as integer) as l_linenumber from med)"""
_SIGN_SQL = f"""
    select prm_line, count(*) as n, {whole('sum(u)')} as prm_util, {money('sum(c)')} as prm_costs, {whole('sum(a)')} as prm_admits from (
      select s.prm_line, case when fix and trivial then 0 when fix and clash then sign(admits) * abs(s.prm_util) else s.prm_util end as u,
        case when fix and trivial then 0 else s.prm_costs end as c, case when fix and trivial then 0 else s.prm_admits end as a
      from (select *, (upper(prm_line) = 'I31' and prm_fromdate >= date '2000-02-01') or (prm_line like 'I%' and upper(prm_line) <> 'I31' and prm_fromdate >= date '2000-01-01') as fix from signed) s
      left join (select caseadmitid, sum(prm_admits) as admits, sign(sum(prm_admits)) <> sign(sum(prm_util)) as clash, sign(sum(prm_admits)) <> sign(sum(prm_util)) and abs(sum(prm_costs)) < 2 as trivial
        from signed where prm_line like 'I%' and prm_fromdate >= date '2000-01-01' group by 1) t using (caseadmitid)) group by 1"""


@query("claim_sign_fix", _SIGN_SQL)
def _(r):
    from datetime import date

    # lines numbered 7 stand for reversed days without cost
    reverse = F.col("linenum") == "7"
    signed = r.outclaims.select(
        "caseadmitid", "prm_line", "prm_fromdate", F.when(reverse, -F.col("prm_util")).otherwise(F.col("prm_util")).alias("prm_util"),
        F.when(reverse, F.lit("0.0001").cast("decimal(18,4)")).otherwise(F.col("prm_costs")).alias("prm_costs"), "prm_admits",
    )
    fixed = fixes.sign_fix(signed, date(2000, 1, 1), date(2000, 2, 1))
    return fixed.groupBy("prm_line").agg(
        F.count(F.lit(1)).alias("n"), F.sum("prm_util").alias("prm_util"), F.sum("prm_costs").alias("prm_costs"), F.sum("prm_admits").alias("prm_admits")
    )


@query(
    "exclusion_join",
    "select m.member_id, m.gender, b.beneexcreason as mem_excluded_reason from member m left join beneexc b on m.member_id = b.hicno",
)
def _(r):
    return exclusions.members_with_exclusion(r.m.member.select("member_id", "gender"), exclusions.bene_exclusion(r.m.bene_exclusion))


CTE["grp"] = 'select c_mktsegment as "group", cast(c_custkey as varchar) as member_id from customer'
CTE["closure"] = """select "group", crnt_hic_num as member_id from grp join xref on member_id = prvs_hic_num union select "group", prvs_hic_num from grp join xref on member_id = crnt_hic_num union select "group", member_id from grp"""


def _closure(r):
    lists = r.m.table("customer").select(F.col("c_mktsegment").alias("group"), F.col("c_custkey").cast("string").alias("member_id"))
    return groups.group_members(lists, r.m.bene_xref)


@query("id_closure", 'select "group", member_id from closure')
def _(r):
    return _closure(r)


@query(
    "group_split",
    f"""select "group", time_period, elig_status_1, count(distinct member_id) as members, {money('sum(prm_costs)')} as prm_costs, {whole('sum(prm_util)')} as prm_util, {whole('sum(discharges)')} as discharges
    from lim join closure using (member_id) group by all""",
)
def _(r):
    return groups.cost_by_group(r.member_spend, _closure(r))


# -- report by group ----------------------------------------------------------------------------------------

# two kinds of overlapping groups: the market segment, and members whose id ends in 0, 1 or 2; ids as the crosswalk knows them
CTE["grp2"] = """select * from grp union all select 'Sample', cast(c_custkey as varchar) from customer where c_custkey % 10 < 3"""
CTE["closure2"] = """select distinct "group", member_id from (select "group", crnt_hic_num as member_id from grp2 join xref on member_id = prvs_hic_num
    union all select "group", prvs_hic_num from grp2 join xref on member_id = crnt_hic_num union all select "group", member_id from grp2)"""
_BY_GROUP = grouped_ctes('select "group", member_id from closure2')
_LABEL = "split_part(time_period, chr(31), 1) as \"group\", split_part(time_period, chr(31), 2) as time_period"


def _group_report(r):
    customer = r.m.table("customer").select("c_mktsegment", F.col("c_custkey").cast("string").alias("member_id"), "c_custkey")
    lists = customer.select(F.col("c_mktsegment").alias("group"), "member_id").unionByName(
        customer.where("c_custkey % 10 < 3").select(F.lit("Sample").alias("group"), "member_id")
    )
    return groups.GroupReport(r, groups.group_members(lists, r.m.bene_xref))


_GROUP_KV = "\nunion all\n".join(_cols(x) for x in [_METRICS_BASIC, _PCT, _OVERLAP, _IP_SQL, _DS_SQL, _OP_SQL, _EOL_SQL, _SNF_SQL, _PROF_SQL, _ED_SQL])
_GROUP_OPT = f"""select {CLIENT}, time_period, 'All' as elig_status_1, 'Basic' as metric_category, 'opt_out_count' as metric_id, 'Number of Beneficiaries Opting Out of Data Sharing' as metric_name,
    {ratio('coalesce(n, 0)')} as metric_value from (select distinct time_period, split_part(time_period, chr(31), 1) as g from mem) p
    left join (select "group" as g, count(*) filter (upper(beneexcreason) = 'BENEFICIARY DECLINED') as n from beneexc join closure2 on hicno = member_id group by 1) o using (g)"""


@query("group_metrics", None, staged=True)
def _(r):
    return _group_report(r).metrics()


ORACLES["group_metrics"] = with_ctes(
    f"select {_LABEL}, name_client, elig_status_1, metric_category, metric_id, metric_name, metric_value from ({_GROUP_KV} union all {_cols(_GROUP_OPT)})", _BY_GROUP
)


@query("group_costs", None, staged=True)
def _(r):
    return _group_report(r).costs()


ORACLES["group_costs"] = with_ctes(f"select {_LABEL}, * exclude (time_period) from ({_CU})", _BY_GROUP)


@query("group_months", None, staged=True)
def _(r):
    return _group_report(r).months()


ORACLES["group_months"] = with_ctes(f"select {_LABEL}, * exclude (time_period) from ({_MEMMOS})", _BY_GROUP)


MARKETS = ["Automobile", "Building", "Furniture", "Household"]
CTE["mkt"] = """select hicno, market_name, row_number() over (partition by market_name order by substr(md5(hicno), 1, 3), hicno) as n from (
    select cast(c_custkey as varchar) as hicno, upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) as market_name from customer where c_mktsegment <> 'MACHINERY')"""


@query("ragged_lists", "select n as count, " + ", ".join(f"max(case when market_name = '{m}' then hicno end) as \"{m}\"" for m in MARKETS) + " from mkt group by n")
def _(r):
    tidy_lists = groups.market_lists(r.m.market_list, left_out=["Machinery"])
    return groups.ragged_lists(groups.numbered_lists(tidy_lists))


_slots = ", ".join(f"case when (s_suppkey + {j}) % 61 = 0 then '06' else '05' end" for j in range(1, StarModel.SLOTS + 1))
_ids = ", ".join(f"'C' || (s_suppkey % 50 + {j % 2})" for j in range(1, StarModel.SLOTS + 1))


@query(
    "first_slot",
    f"""select oscar, upper(left(nm, 1)) || lower(substr(nm, 2)) as prv_org_name from (select oscar, max(upper(s_name)) as nm from (
      select s_name, list_extract([{_ids}], list_position([{_slots}], '06')) as oscar from supplier) where oscar is not null group by 1)""",
)
def _(r):
    return supplemental.facility_names(r.m.provider_register, r.m.SLOTS)


@query(
    "supplemental_claims",
    f"select prm_line, prm_util_type, {whole('sum(case when upper(prm_util_type) = chr(68) || chr(65) || chr(89) || chr(83) then prm_util else 0 end)')} as prm_days, count(*) as n from med group by all",
)
def _(r):
    return supplemental.outclaims(r.outclaims).groupBy("prm_line", "prm_util_type").agg(F.sum("prm_days").alias("prm_days"), F.count(F.lit(1)).alias("n"))


@query(
    "supplemental_facility",
    f"""select m.prm_line, f.prv_org_name, {whole('sum(m.n)')} as n, {money('sum(m.paid)')} as paid from (
      select prm_line, prm_prv_id_ccn as ccn, count(*) as n, sum(paid) as paid from med group by 1, 2) m
    left join (select oscar, upper(left(nm, 1)) || lower(substr(nm, 2)) as prv_org_name from (select oscar, max(upper(s_name)) as nm from (
      select s_name, list_extract([{_ids}], list_position([{_slots}], '06')) as oscar from supplier) where oscar is not null group by 1)) f on f.oscar = m.ccn group by all""",
)
def _(r):
    """Claims with the name of their facility, by its certification number."""
    names = supplemental.facility_names(r.m.provider_register, r.m.SLOTS)
    return supplemental.with_facility_name(r.outclaims, names).groupBy("prm_line", "prv_org_name").agg(F.count(F.lit(1)).alias("n"), F.sum("paid").alias("paid"))


@query(
    "supplemental_pharmacy",
    f"select coalesce(prv_net_hier_1, 'OON') as prv_net_hier_1, prm_line, count(*) as n, {money('sum(paid)')} as paid, {whole('sum(dayssupply)')} as dayssupply from rx left join prov on providerid = prv_id group by all",
)
def _(r):
    return supplemental.outpharmacy(r.m.outpharmacy, r.m.providers).groupBy("prv_net_hier_1", "prm_line").agg(
        F.count(F.lit(1)).alias("n"), F.sum("paid").alias("paid"), F.sum("dayssupply").alias("dayssupply")
    )


@query("supplemental_lines", "select mr_line as prm_line, prm_line_desc, prm_line_desc1 as prm_line_category, costmodel_util from mrline")
def _(r):
    return supplemental.ref_prm_line(r.m.mr_line_info).select("prm_line", "prm_line_desc", "prm_line_category", "costmodel_util")


@query(
    "supplemental_memmos",
    f"""select t.member_id, elig_month, elig_status_1, cover_medical, {whole('age')} as age, gender, mem_name, mem_address_line_1, mem_address_line_2, mem_city_state, mem_state, mem_zip5, dob,
      {ratio('sum(memmos)')} as memmos from mtime t left join member m on t.member_id = m.member_id group by all""",
)
def _(r):
    return supplemental.memmos_elig(r.m.member_time, r.m.member)


# -- score explanation ------------------------------------------------------------------------------------

_FLAG_NAMES = [f"hcc{j}" for j in StarModel.HCCS] + ["ne_female_65"]
_ANY = lambda ids: "(" + " or ".join(f"hcc{i} = 1" for i in ids) + ")"
_DERIVED = {
    **{f"OriginallyDisabled_{n}": f"sex = '{c}' and origds = 1" for n, c in scores.SEXES.items()},
    **{f"MCAID_{n}_Aged": f"sex = '{c}' and mcaid = 1 and disabl = 0" for n, c in scores.SEXES.items()},
    **{f"MCAID_{n}_Disabled": f"sex = '{c}' and mcaid = 1 and disabl = 1" for n, c in scores.SEXES.items()},
    **{f"DISABLED_HCC{i}": f"disabl = 1 and hcc{i} = 1" for i in scores.DISABLED_WITH},
    **{n: f"{_ANY(a)} and {_ANY(b)}" for n, (a, b) in scores.COMBINATIONS.items()},
}
_COEF_NAMES = [f"hcc{j}" for j in StarModel.HCCS] + ["DIABETES_CHF", "CHF_COPD"]
_CE_CASE = "case v " + " ".join(f"when '{n}' then {i + 1} / 8.0::double" for i, n in enumerate(_COEF_NAMES)) + " end"
CTE["expl"] = "\nunion all\n".join(
    [f"select hicno, time_slice, origds, mcaid, '{n}' as v from hcc where {n} = 1" for n in _FLAG_NAMES]
    + [f"select hicno, time_slice, origds, mcaid, '{n}' as v from hcc where {t}" for n, t in _DERIVED.items()]
)
CTE["explained"] = f"""select hicno, time_slice,
    case when upper(left(v, 2)) = 'NE' then (case when origds = 1 then 'ORIGDIS_' else 'NORIGDIS_' end) || (case when mcaid = 1 then 'MCAID_' else 'NMCAID_' end) || v else v end as variable,
    (select min(p_size) from part) * ({_CE_CASE}) as comm_coeff,
    case when v = 'ne_female_65' then (select min(p_size) from part) * (case when mcaid = 0 then case when origds = 0 then 2 else 3 end else case when origds = 0 then 4 else 5 end end) / 4.0::double end as ne_coeff
    from expl"""


def _explained(r):
    return scores.score_explanation(r.m.hcc_results, scores.coefficient_table(r.m.coefficient_row))


@query("score_explanation", f"select hicno, time_slice, variable, {ratio('comm_coeff')} as comm_coeff, {ratio('ne_coeff')} as ne_coeff from explained")
def _(r):
    return _explained(r)


@query(
    "v_score_reconciliation",
    f"""select * from (select hicno, time_slice, {ratio('riskscr_mm')} as riskscr_mm, round(case when score_new_enrollee = 0.01 then 0 else coalesce(ne, 0) - score_new_enrollee end, 3) as diff_ne,
      round(coalesce(comm, 0) - score_community, 3) as diff_comm from (select hicno, time_slice, sum(ne_coeff) as ne, sum(comm_coeff) as comm from explained group by 1, 2) join hcc using (hicno, time_slice))
      where diff_ne <> 0 or diff_comm <> 0""",
)
def _(r):
    rec = scores.score_reconciliation(_explained(r), r.m.hcc_results)
    return checks.scores_differ(rec).select("hicno", "time_slice", "riskscr_mm", "diff_ne", "diff_comm")
