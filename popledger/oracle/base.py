"""DuckDB definitions of the input tables and shared intermediates, written independently
of the Spark plans: rows are matched and summed directly, without pre-aggregation."""

from __future__ import annotations

import re

from popledger.sources.star import DISCHARGE_CODES, MEDICAL_LINES, NYU_SHARES, PHARMACY_LINES, PREFERENCE_CATEGORIES, StarModel


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _claim_columns() -> str:
    return f"""
    cast(l_orderkey as varchar) as claimid, cast(l_linenumber as varchar) as linenum, cast(o_custkey as varchar) as member_id,
    prm_line, d as prm_fromdate, d + l_linenumber as prm_todate, d + 15 * l_linenumber as paiddate,
    o_custkey || '_' || year(d) || 'Q' || quarter(d) as caseadmitid,
    case when prm_line like 'P%' then o_custkey || '_' || year(d) || 'Q' || quarter(d) end as facilitycaseid,
    {_list(DISCHARGE_CODES)}[l_linenumber] as dischargestatus,
    case when l_suppkey % 17 <> 3 then cast(l_suppkey as varchar) end as providerid,
    'C' || (l_suppkey % 50) as prm_prv_id_ccn,
    case when l_partkey % 13 <> 0 then 'J' || lpad(cast(l_partkey % 97 as varchar), 4, '0') end as hcpcs,
    case when l_suppkey % 5 = 1 then 'Y' when l_suppkey % 5 <> 4 then 'N' end as prv_net_aco_yn,
    cast(l_extendedprice * (1 - l_discount) as decimal(18,4)) as prm_costs,
    cast(l_extendedprice as decimal(18,4)) as allowed,
    cast(l_extendedprice * (1 + l_tax) as decimal(18,4)) as paid,
    case when prm_line like 'I%' then cast(l_quantity as bigint) % 30 + 1 else cast(l_quantity as bigint) end as prm_util,
    cast(case when l_returnflag = 'R' then 1 else 0 end as bigint) as prm_admits,
    case when prm_line like 'I%' then 'Days' else 'Visits' end as prm_util_type,
    case when d >= date '2001-01-01' then '10' else '09' end as icdversion,
    case when prm_line like 'I%' then d + l_linenumber else d end as incurred"""


def _hcc_flags() -> str:
    return ", ".join(f"case when (c_custkey + month(inc_start)) % {j % 5 + 2} = 0 then 1 else 0 end as hcc{j}" for j in StarModel.HCCS)


def _shares() -> str:
    return ", ".join(f"case when k % 6 = {j} then 0.75::double when (k + 1) % 6 = {j} then 0.25::double else 0::double end as {n}" for j, n in enumerate(NYU_SHARES))


CTE = {
    "win": """
    select year(s) || 'Q' || quarter(s) || '_' || year(e) || 'Q' || quarter(e) as time_period, s as inc_start, e as inc_end, p as paid_thru,
      case when s - interval 12 month >= date '1999-01-01' then cast(s - interval 12 month as date) else s end as inc_start_riskscr_features,
      case when s - interval 12 month >= date '1999-01-01' then last_day(cast(e - interval 12 month as date)) else e end as inc_end_riskscr_features,
      case when s - interval 12 month >= date '1999-01-01' then 'Prospective' else 'Concurrent' end as riskscr_period_type
    from (select cast(date '2000-07-01' - to_months(cast(3 * k as integer)) as date) as s,
                 last_day(cast(date '2001-06-01' - to_months(cast(3 * k as integer)) as date)) as e,
                 last_day(cast(date '2001-10-01' - to_months(cast(3 * k as integer)) as date)) as p
          from range(7) t(k))""",
    "member": """
    select cast(c_custkey as varchar) as member_id, date '1940-01-01' + cast(c_custkey % 20000 as integer) as dob,
      case when c_custkey % 2 = 0 then 'F' else 'M' end as gender, c_name as mem_name,
      case when c_custkey % 20 = 19 then 'Manual' when c_custkey % 2 = 0 then 'CMS HCC Risk Score' else 'Component Risk Score' end as risk_score_type,
      'Street ' || c_nationkey as mem_address_line_1, cast(null as varchar) as mem_address_line_2, 'City ' || c_nationkey as mem_city_state,
      lpad(cast(c_nationkey as varchar), 2, '0') as mem_state, lpad(cast(c_custkey % 100000 as varchar), 5, '0') as mem_zip5,
      2001 - year(date '1940-01-01' + cast(c_custkey % 20000 as integer)) as age, c_custkey
    from customer""",
    "ospans": """
    select cast(o_custkey as varchar) as member_id, cast(date_trunc('month', o_orderdate) as date) as date_start,
      last_day(cast(date_trunc('month', o_orderdate) + interval 5 month as date)) as date_end
    from orders""",
    "spans": """
    select member_id, min(date_start) as date_start, max(date_end) as date_end from (
      select *, sum(opens) over (partition by member_id order by date_start, date_end rows unbounded preceding) as island from (
        select *, case when date_start > max(date_end) over (partition by member_id order by date_start, date_end rows between unbounded preceding and 1 preceding)
                       then 1 else 0 end as opens from (select distinct * from ospans))) group by member_id, island""",
    "elig": """
    select s.*, c_mktsegment as elig_status_1, case when c_custkey % 11 = 5 then 'N' else 'Y' end as assignment_indicator, 'Y' as cover_medical,
      case when c_custkey % 3 = 0 then 'N' else 'Y' end as cover_rx, 'P' || c_nationkey as mem_prv_id_align, 'Practice ' || c_nationkey as prv_name_align
    from spans s join customer c on s.member_id = cast(c.c_custkey as varchar)""",
    "mtime": """
    select member_id, elig_status_1, cover_medical, cast(m as date) + 14 as elig_month, 1.0::double as memmos
    from (select *, unnest(generate_series(date_start::timestamp, date_trunc('month', date_end)::timestamp, interval 1 month)) as m from elig)""",
    "mstatus": """
    select cast(o_custkey as varchar) as hicno, cast(date_trunc('month', o_orderdate) as date) as date_elig_start, max(o_orderpriority) as elig_status
    from orders where o_orderstatus = 'F' group by 1, 2""",
    "xref": """
    select distinct cast(c_custkey as varchar) as prvs_hic_num, cast(c_custkey - 1 as varchar) as crnt_hic_num from customer where c_custkey % 10 = 0 and c_custkey > 0""",
    "death": """
    select cast(o_custkey as varchar) as member_id, o_custkey as k, max(cast(o_orderdate as date)) as death_date
    from orders where o_custkey in (select c_custkey from customer where c_acctbal < 0) group by 1, 2""",
    "excl": """
    select member_id as member_id_excluded, death_date as death_date_excluded,
      case when k % 3 <> 0 then death_date - cast(k % 5 as integer) - cast(k % 250 as integer) end as latest_hospice_date_admit,
      case when k % 3 <> 0 then death_date - cast(k % 5 as integer) end as latest_hospice_date_discharge,
      case when k % 4 = 0 then 'Y' else 'N' end as endoflife_numer_yn_chemolt14days, case when k % 2 = 0 then 'Y' else 'N' end as endoflife_denom_yn_chemolt14days,
      case when k % 3 <> 0 and k % 250 < 3 then 'Y' else 'N' end as endoflife_numer_yn_hospicelt3day, case when k % 3 <> 0 then 'Y' else 'N' end as endoflife_denom_yn_hospicelt3day,
      case when k % 3 = 0 then 'Y' else 'N' end as endoflife_numer_yn_hospicenever, case when k % 7 <> 0 then 'Y' else 'N' end as endoflife_denom_yn_hospicenever
    from death""",
    "rawstack": """
    select cast(o_custkey as varchar) as bene_hic_num, last_day(cast(o_orderdate as date)) as date_latestpaid,
      case when death_date <= last_day(cast(o_orderdate as date)) then death_date end as bene_death_dt
    from orders left join death on cast(o_custkey as varchar) = member_id""",
    "lines": """
    select l.*, o_custkey, cast(l_shipdate as date) as d from lineitem l join orders on l_orderkey = o_orderkey""",
    "med": f"""
    select {_claim_columns()} from (select *, {_list(MEDICAL_LINES)}[l_partkey % 18 + 1] as prm_line from lines where l_linestatus = 'O')""",
    "rx": f"""
    select {_claim_columns()}, cast(l_quantity as bigint) % 90 as dayssupply from (select *, {_list(PHARMACY_LINES)}[l_partkey % 3 + 1] as prm_line from lines where l_linestatus = 'F')""",
    "case0": """
    select caseadmitid, member_id as o, year(prm_fromdate) * 4 + quarter(prm_fromdate) - 1 as q, min(prm_fromdate) as date_case_earliest, max(prm_todate) as date_case_latest,
      max(case when prm_line like 'I%' then 1 else 0 end) as ip
    from med where prm_line like 'I%' or prm_line like 'O11%' group by 1, 2, 3""",
    "cases": f"""
    select caseadmitid, date_case_earliest, date_case_latest, lpad(cast(k % 40 as varchar), 3, '0') as prm_drg, 'MS30' as prm_drgversion,
      'PQI' || lpad(cast(k % 20 as varchar), 2, '0') as prm_ahrq_pqi, {_list(PREFERENCE_CATEGORIES)}[k % 4 + 1] as prm_pref_sensitive_category,
      case when k % 3 = 0 then 'N' else 'Y' end as prm_pref_sensitive_included_yn, case when k % 5 = 0 then 'N' else 'Y' end as prm_readmit_potential_yn,
      case when nxt is not null then 'Y' else 'N' end as prm_readmit_all_cause_yn, nxt as prm_readmit_all_cause_caseid, {_shares()}
    from (select c.*, cast(c.o as bigint) * 7 + c.q as k, f.caseadmitid as nxt from case0 c left join case0 f on c.o = f.o and c.q = f.q - 1 and f.ip = 1)""",
    "prov": """
    select cast(s_suppkey as varchar) as prv_id, case when s_suppkey % 9 <> 4 then s_name end as prv_name, lpad(cast(s_nationkey as varchar), 2, '0') as prv_specialty,
      case when s_nationkey % 5 = 1 then 'Tier 1' end as prv_net_hier_1 from supplier""",
    "mrline": f"""
    select distinct mr_line, 'Line ' || mr_line as prm_line_desc,
      case left(mr_line, 1) when 'P' then 'Prof' when 'I' then 'Fip' when 'O' then 'Fop' else 'Rx' end as prm_line_desc1,
      case when mr_line like 'I%' then 'Days' when left(mr_line, 3) in ('O14', 'P57', 'P59') then 'Procs' else 'Visits' end as costmodel_util,
      case when mr_line like 'R%' then 'Rx' else 'Medical' end as prm_coverage_type,
      case when mr_line like 'I%' then 'RISKSCR_IP' when mr_line like 'O11%' then 'RISKSCR_ER' when mr_line like 'O%' then 'RISKSCR_OP'
           when mr_line like 'P5%' then 'RISKSCR_OTHER' when mr_line like 'P%' then 'RISKSCR_PHY' else 'RISKSCR_RX' end as riskscr_component
    from (select {_list(MEDICAL_LINES)}[p_partkey % 18 + 1] as mr_line from part union all select {_list(PHARMACY_LINES)}[p_partkey % 3 + 1] from part)""",
    "linkall": """
    select lob, mr_line, case when mr_line = 'P59b' then 'X99' else left(mr_line, 3) end as mcrm_line from mrline, (values ('Medicare'), ('Commercial')) v(lob)""",
    "link": "select mr_line, mcrm_line from linkall where upper(lob) = 'MEDICARE'",
    "mcrm": """
    select distinct lob, mcrm_line, 'Level 1 ' || left(mcrm_line, 1) as mcrm_line_desc_l1, 'Level 2 ' || left(mcrm_line, 2) as mcrm_line_desc_l2,
      'Level 3 ' || mcrm_line as mcrm_line_desc_l3, 'Level 4 ' || mcrm_line as mcrm_line_desc_l4, 'Level 5 ' || mcrm_line as mcrm_line_desc_l5,
      'Level 6 ' || mcrm_line as mcrm_line_desc_l6 from linkall""",
    "bench": """
    select lob, mcrm_line, lw as loosely_well, case when mcrm_line like 'I%' then n * f end as admits_per1k, case when mcrm_line <> 'R10' then n * 4 * f end as util_per1k,
      case when mcrm_line like 'I%' then 'Days' else 'Visits' end as util_type
    from (select lob, mcrm_line, lw, f, cast(ascii(substr(mcrm_line, 3, 1)) as double) as n from mcrm, (values ('Loosely', 1.0::double), ('Well', 0.5::double)) v(lw, f))""",
    "calib": """
    select mcrm_line, lo, hi, f as factor_util, f * 2 as factor_cost from (select distinct mcrm_line from link),
      (values (0.0::double, 1.24::double, 0.75::double), (1.25::double, 1.49::double, 1.25::double), (1.5::double, 1.74::double, 1.5::double)) v(lo, hi, f)""",
    "score0": "select c_custkey, cast(1.0 as double) + (c_custkey % 100) / cast(100.0 as double) as s from customer where c_custkey % 13 <> 0",
    "comp": """
    select cast(c_custkey as varchar) as member_id, time_period as time_slice, model_name, s as riskscr_tot, s * 0.5::double as riskscr_rx, s * 0.25::double as riskscr_med,
      s * 1.5::double as riskscr_ip, s * 0.75::double as riskscr_op, s * 1.25::double as riskscr_phy, s * 2.0::double as riskscr_er, s * 3.0::double as riskscr_other
    from (select c_custkey, model_name, case when model_name = 'DXCONLAG0' then s * 2 else s end as s from score0, (values ('DXPROLAG0'), ('DXCONLAG0')) v(model_name) where c_custkey % 2 = 1), win""",
    "comp_fit": """
    select comp.* from comp join win on time_slice = time_period and upper(substr(model_name, 3, 3)) = upper(left(riskscr_period_type, 3))""",
    "hcc": f"""
    select cast(c_custkey as varchar) as hicno, time_period as time_slice, case when (c_custkey + month(inc_start)) % 8 = 0 then 7.0::double else 12.0::double end as riskscr_mm,
      s as score_community, s / 2 as score_new_enrollee, case when c_custkey % 2 = 0 then '2' else '1' end as sex, case when c_custkey % 3 = 0 then 1 else 0 end as origds,
      case when c_custkey % 5 = 0 then 1 else 0 end as mcaid, case when c_custkey % 7 < 3 then 1 else 0 end as disabl, {_hcc_flags()},
      case when c_custkey % 4 = 1 then 1 else 0 end as ne_female_65
    from score0, win""",
    "beneexc": """
    select cast(c_custkey as varchar) as hicno, case ['BD','EC','PL','ZZ'][c_custkey % 4 + 1] when 'BD' then 'Beneficiary Declined' when 'EC' then 'Excluded by CMS'
      when 'PL' then 'Participant List Change' else 'ZZ' end as beneexcreason from customer where c_custkey % 25 < 2""",
    # ---- shared intermediates
    "pm": """
    select time_period, med.* from med join win on incurred between inc_start and inc_end and paiddate <= paid_thru""",
    "prx": """
    select time_period, rx.* from rx join win on incurred between inc_start and inc_end and paiddate <= paid_thru""",
    "roster": """
    select e.member_id, time_period, elig_status_1, mem_prv_id_align, prv_name_align, risk_score_type as riskscr_1_type
    from elig e join win on inc_end between date_start and date_end left join member m on e.member_id = m.member_id where upper(assignment_indicator) = 'Y'""",
    "mm": """
    select member_id, time_period, sum(case when cover_medical = 'Y' then n else 0 end) as memmos_medical, sum(case when cover_rx = 'Y' then n else 0 end) as memmos_rx from (
      select member_id, time_period, cover_medical, cover_rx, cast(datediff('month', greatest(date_start, inc_start), least(date_end, inc_end)) + 1 as double) as n
      from elig join win on date_start <= inc_end and date_end >= inc_start) group by 1, 2""",
    "mem_all": """
    select r.*, m.dob, m.gender, m.mem_name,
      case when dob > inc_end then 0 else cast(datediff('year', dob, inc_end) - case when strftime(inc_end, '%m%d') < strftime(dob, '%m%d') then 1 else 0 end as integer) end as age,
      coalesce(memmos_medical, 0) as memmos,
      case when riskscr_1_type = 'CMS HCC Risk Score' then case when riskscr_mm is null or riskscr_mm <= 11 then score_new_enrollee else score_community end
           when riskscr_1_type = 'Component Risk Score' then riskscr_tot end as riskscr_1,
      case when riskscr_1_type = 'CMS HCC Risk Score' then riskscr_mm when riskscr_1_type = 'Component Risk Score' then coalesce(memmos_medical, 0) end as riskscr_memmos
    from roster r left join member m using (member_id) left join win using (time_period) left join mm on r.member_id = mm.member_id and r.time_period = mm.time_period
      left join hcc on hcc.hicno = r.member_id and hcc.time_slice = r.time_period left join comp_fit c on c.member_id = r.member_id and c.time_slice = r.time_period""",
    "mem": "select * from mem_all where memmos <> 0",
    "firstline": "select mcrm_line, min(mr_line) as mr_line from link group by 1",
    "linecomp": "select f.mcrm_line, case when f.mcrm_line = 'X99' then 'RISKSCR_OTHER' else riskscr_component end as comp from firstline f join mrline m on f.mr_line = m.mr_line",
    "rsm": """
    select m.time_period, m.elig_status_1, l.mcrm_line, m.memmos,
      case when riskscr_1_type = 'CMS HCC Risk Score' then coalesce(factor_util, riskscr_1) when riskscr_1_type = 'Component Risk Score' then cs else riskscr_1 end as u,
      case when riskscr_1_type = 'CMS HCC Risk Score' then coalesce(factor_cost, riskscr_1) when riskscr_1_type = 'Component Risk Score' then cs else riskscr_1 end as c
    from (select m.*, l.mcrm_line, case comp when 'RISKSCR_IP' then riskscr_ip when 'RISKSCR_ER' then riskscr_er when 'RISKSCR_OP' then riskscr_op
            when 'RISKSCR_PHY' then riskscr_phy when 'RISKSCR_RX' then riskscr_rx else riskscr_other end as cs
          from mem m cross join linecomp l left join comp_fit s on m.member_id = s.member_id and m.time_period = s.time_slice) m
      join linecomp l using (mcrm_line) left join calib on calib.mcrm_line = l.mcrm_line and round(riskscr_1, 2) between lo and hi""",
    "rs": """
    select time_period, elig_status_1, mcrm_line, sum(u * memmos) / sum(case when u is not null then memmos end) as riskscr_1_util_avg,
      sum(c * memmos) / sum(case when c is not null then memmos end) as riskscr_1_cost_avg, sum(case when u is not null then memmos end) as memmos_sum
    from rsm group by 1, 2, 3""",
    "dec": """
    select m.member_id, m.time_period, endoflife_numer_yn_chemolt14days, endoflife_denom_yn_chemolt14days, endoflife_numer_yn_hospicelt3day, endoflife_denom_yn_hospicelt3day,
      endoflife_numer_yn_hospicenever, endoflife_denom_yn_hospicenever,
      case when latest_hospice_date_discharge is null then 0 when abs(death_date_excluded - latest_hospice_date_discharge) < 3
           then latest_hospice_date_discharge - latest_hospice_date_admit + 1 else 0 end as final_hospice_days,
      coalesce(sum(prm_costs), 0) as costs_final_30_days,
      case when max(case when c.member_id is null then 0 when lower(prm_line) = 'i31' then 0 when prm_line not like 'I%' then 0 when dischargestatus = '20' then 1 else 0 end) = 1 then 'Y' else 'N' end as deceased_hospital_yn
    from mem m join win w using (time_period) join excl on m.member_id = member_id_excluded and death_date_excluded between inc_start and inc_end
      left join med c on c.member_id = m.member_id and c.incurred between w.inc_start - 90 and w.inc_end and c.paiddate <= w.paid_thru and death_date_excluded - c.prm_todate between 0 and 30
    group by all""",
    "mc": """
    select m.time_period, elig_status_1, case when d.member_id is not null then 'Y' else 'N' end as deceased_yn, coalesce(deceased_hospital_yn, 'N') as deceased_hospital_yn,
      coalesce(endoflife_numer_yn_chemolt14days, 'N') as endoflife_numer_yn_chemolt14days, coalesce(endoflife_denom_yn_chemolt14days, 'N') as endoflife_denom_yn_chemolt14days,
      coalesce(endoflife_numer_yn_hospicelt3day, 'N') as endoflife_numer_yn_hospicelt3day, coalesce(endoflife_denom_yn_hospicelt3day, 'N') as endoflife_denom_yn_hospicelt3day,
      coalesce(endoflife_numer_yn_hospicenever, 'N') as endoflife_numer_yn_hospicenever, coalesce(endoflife_denom_yn_hospicenever, 'N') as endoflife_denom_yn_hospicenever,
      cast(coalesce(final_hospice_days, 0) as bigint) as final_hospice_days, riskscr_1_type as risk_score_type, sum(coalesce(costs_final_30_days, 0)) as costs_final_30_days_sum,
      sum(memmos) as riskscr_wgt, sum(riskscr_1 * memmos) / sum(memmos) as riskscr_avg, count(*) as memcnt,
      sum(case when riskscr_memmos > 11 then memmos else 0 end) / sum(memmos) as riskscr_cred, sum(age * memmos) / sum(memmos) as age_avg
    from mem m left join dec d on m.member_id = d.member_id and m.time_period = d.time_period group by all""",
    "lim": """
    select p.*, elig_status_1, memmos, mcrm_line from (
      select time_period, member_id, prm_line, coalesce(prv_net_aco_yn, 'N') as prv_net_aco_yn, prv_net_aco_yn as raw_net, providerid, hcpcs, 'Medical' as prm_coverage_type,
        sum(prm_admits) as discharges, sum(prm_util) as prm_util, sum(prm_costs) as prm_costs, sum(allowed) as allowed, sum(paid) as paid, count(*) as claim_lines from pm group by all
      union all
      select time_period, member_id, prm_line, coalesce(prv_net_aco_yn, 'N'), prv_net_aco_yn, providerid, null, 'Rx', sum(prm_admits), sum(prm_util), sum(prm_costs), sum(allowed), sum(paid), count(*)
      from prx group by all) p
    join mem using (member_id, time_period) left join link on prm_line = mr_line""",
    "cu": """
    select 'Sample Client' as name_client, time_period, prm_line, mcrm_line, elig_status_1, prv_net_aco_yn, case when prm_line like 'I%' then sum(discharges) else 0 end as prm_discharges,
      case when prm_line like 'I%' then sum(prm_util) else 0 end as prm_days, sum(prm_util) as prm_util, sum(prm_costs) as prm_costs, sum(allowed) as prm_allowed, sum(paid) as prm_paid, prm_coverage_type
    from lim group by time_period, prm_line, mcrm_line, elig_status_1, prv_net_aco_yn, prm_coverage_type""",
    "ba": """
    select m.*, coalesce(prm_costs, 0) as prm_costs_sum_all_services, coalesce(disch, 0) as discharges_sum_all_services from (
      select time_period, elig_status_1, sum(memmos) as memmos_sum, sum(memmos * riskscr_1) as memmos_sum_riskadj, sum(memmos * riskscr_1) / sum(memmos) as riskscr_1_avg from mem group by 1, 2) m
    left join (select time_period, elig_status_1, sum(prm_costs) as prm_costs, sum(prm_discharges) as disch from cu group by 1, 2) using (time_period, elig_status_1)""",
    "ipc": """
    select a.*, c.* exclude (caseadmitid) from (
      select time_period, prm_line, caseadmitid, member_id, dischargestatus, providerid, prm_util_type, sum(prm_admits) as discharges, sum(prm_util) as prm_util, sum(prm_costs) as prm_costs
      from pm where upper(prm_line) like 'I%' and lower(prm_line) <> 'i31' group by all) a left join cases c using (caseadmitid)""",
    "ipp": """
    select time_period, elig_status_1, coalesce(providerid, 'Unknown') as prv_id_inpatient, dischargestatus as discharge_status_code,
      case dischargestatus when '01' then 'Discharged to Home' when '62' then 'Discharged to IRF' when '03' then 'Discharged to SNF' when '06' then 'Discharged to Home Health Care'
        when '20' then 'Died' else 'Other' end as discharge_status_desc,
      prm_drg as drg_inpatient, prm_drgversion as drg_version_inpatient, case when lower(prm_line) <> 'i31' then 'Y' else 'N' end as acute_yn,
      case when lower(prm_line) like 'i11%' then 'Medical' when lower(prm_line) like 'i12%' then 'Surgical' else 'None' end as medical_surgical,
      case when prm_ahrq_pqi in ('PQI01','PQI03','PQI05','PQI07','PQI08','PQI10','PQI11','PQI12','PQI13','PQI14','PQI15','PQI16') then 'Y' else 'N' end as inpatient_pqi_yn,
      prm_ahrq_pqi, case when dischargestatus = '03' then 'Y' else 'N' end as inpatient_discharge_to_snf_yn,
      case when upper(prm_pref_sensitive_included_yn) = 'Y' and upper(prm_pref_sensitive_category) <> 'NOT PSA' then 'Y' else 'N' end as preference_sensitive_yn,
      prm_pref_sensitive_category, prm_readmit_potential_yn as inpatient_readmit_potential_yn, prm_readmit_all_cause_yn as inpatient_readmit_yn, cast(prm_util as bigint) as los_inpatient, mcrm_line, prm_line,
      sum(discharges) as cnt_discharges_inpatient, sum(prm_util) as sum_days_inpatient, sum(prm_costs) as sum_costs_inpatient
    from ipc join mem using (member_id, time_period) left join link on prm_line = mr_line group by all""",
    "ipd": """
    select time_period, elig_status_1, prv_id_inpatient, discharge_status_code, discharge_status_desc, drg_inpatient, drg_version_inpatient, acute_yn, medical_surgical, inpatient_pqi_yn,
      prm_ahrq_pqi, inpatient_discharge_to_snf_yn, preference_sensitive_yn, prm_pref_sensitive_category, inpatient_readmit_potential_yn, inpatient_readmit_yn, los_inpatient,
      sum(cnt_discharges_inpatient) as cnt_discharges_inpatient, sum(sum_days_inpatient) as sum_days_inpatient, sum(sum_costs_inpatient) as sum_costs_inpatient
    from ipp group by all""",
    "opc": """
    select time_period, elig_status_1, prm_line, sum(prm_util) as prm_util from pm join mem using (member_id, time_period)
    where lower(prm_line) like 'o%' or lower(prm_line) in ('p32c', 'p32d') or lower(prm_line) like 'p57%' or lower(prm_line) like 'p59%' or lower(prm_line) like 'p33%' group by all""",
    "opl": """
    select mr_line, costmodel_util, case when lower(mr_line) in ('o14a','o14b','o14c') then 'high_tech_imaging' when lower(mr_line) = 'o10' then 'observation_stays'
        when lower(mr_line) like 'p57%' then 'hi_tec_img_fop' when lower(mr_line) like 'p59%' then 'hi_tec_img_office' when lower(mr_line) like 'p33%' then 'urgent_care_prof'
        when lower(mr_line) like 'p32%' then 'office_visits' end as metric_id,
      case when lower(mr_line) in ('o14a','o14b','o14c') then 'High Tech Imaging Utilization' when lower(mr_line) = 'o10' then 'Observation Stays Utilization'
        when lower(mr_line) like 'p57%' then 'FOP High Tech Imaging Procedure Utilization' when lower(mr_line) like 'p59%' then 'Office High Tech Imaging Procedure Utilization'
        when lower(mr_line) like 'p33%' then 'Office Urgent Care Visits' when lower(mr_line) like 'p32%' then 'Office Visits' end as metric_name from mrline""",
    "opu": """
    select time_period, elig_status_1, metric_id, metric_name, sum(u) as raw, sum(u / riskscr_1_util_avg) as adj from (
      select time_period, elig_status_1, metric_id, metric_name, mcrm_line, sum(prm_util) as u from opc join opl on prm_line = opl.mr_line left join link on prm_line = link.mr_line
      where metric_id is not null group by all) left join rs using (time_period, elig_status_1, mcrm_line) group by all""",
    "ipopen": """
    select distinct member_id, prm_line, caseadmitid, date_case_earliest, date_case_latest, prm_readmit_all_cause_yn, prm_readmit_all_cause_caseid
    from med left join cases using (caseadmitid) where prm_line like 'I%' and incurred >= date '1999-01-01'""",
    "fail0": """
    select distinct i.member_id, i.date_case_latest as s, r.date_case_earliest as e from ipopen i left join ipopen r on i.member_id = r.member_id and i.prm_readmit_all_cause_caseid = r.caseadmitid
    where lower(i.prm_line) <> 'i31' and i.prm_readmit_all_cause_yn = 'Y'""",
    "snfre": """
    select distinct member_id, caseadmitid from ipopen where lower(prm_line) = 'i31'
      and exists (select 1 from fail0 f where f.member_id = ipopen.member_id and f.s <= f.e and ipopen.date_case_latest between f.s and f.e)""",
    "snfd": """
    select a.time_period, m.elig_status_1, coalesce(a.providerid, 'Unknown') as prv_id_snf, case when r.member_id is null then 'N' else 'Y' end as snf_readmit_yn, cast(a.prm_util as bigint) as los_snf,
      sum(a.discharges) as cnt_discharges_snf, sum(a.prm_util) as sum_days_snf, sum(a.prm_costs) as sum_costs_snf, sum(a.discharges / riskscr_1_util_avg) as d_adj,
      sum(a.prm_util / riskscr_1_util_avg) as u_adj, sum(cast(a.prm_costs as double) / riskscr_1_cost_avg) as c_adj
    from (select time_period, providerid, member_id, prm_line, caseadmitid, sum(prm_admits) as discharges, sum(prm_util) as prm_util, sum(prm_costs) as prm_costs from pm where lower(prm_line) = 'i31' group by all) a
      join mem m on a.member_id = m.member_id and a.time_period = m.time_period left join snfre r on a.member_id = r.member_id and a.caseadmitid = r.caseadmitid
      left join link on a.prm_line = mr_line left join rs on rs.time_period = a.time_period and rs.elig_status_1 = m.elig_status_1 and rs.mcrm_line = link.mcrm_line group by all""",
    "prof": """
    select p.*, m.elig_status_1, mcrm_line from (
      select time_period, providerid, member_id, prm_line, facilitycaseid, sum(prm_costs) as prm_costs from pm where lower(prm_line) like 'p%' group by all) p
    join (select distinct time_period, member_id, caseadmitid from pm where lower(prm_line) = 'i31') s on p.facilitycaseid = s.caseadmitid and p.member_id = s.member_id and p.time_period = s.time_period
    join mrline l on p.prm_line = l.mr_line and (upper(prm_line_desc1) = 'PROF' or lower(l.mr_line) in ('p84', 'p85'))
    join mem m on p.member_id = m.member_id and p.time_period = m.time_period left join link on p.prm_line = link.mr_line""",
    "profd": """
    select p.time_period, p.elig_status_1, coalesce(providerid, 'Unknown') as prv_id_snf, sum(prm_costs) as sum_costs_prof_snf, sum(cast(prm_costs as double) / riskscr_1_cost_avg) as c_adj
    from prof p left join rs on rs.time_period = p.time_period and rs.elig_status_1 = p.elig_status_1 and rs.mcrm_line = p.mcrm_line group by all""",
    "edc": """
    select a.*, m.elig_status_1, riskscr_1_util_avg, c.* exclude (caseadmitid) from (
      select time_period, member_id, caseadmitid, prm_line, sum(prm_util) as prm_util from pm where lower(prm_line) like 'o11%' group by all) a
    join mem m on a.member_id = m.member_id and a.time_period = m.time_period left join cases c using (caseadmitid) left join link on prm_line = mr_line
    left join rs on rs.time_period = a.time_period and rs.elig_status_1 = m.elig_status_1 and rs.mcrm_line = link.mcrm_line""",
    "assigned": """
    select coalesce(crnt_hic_num, e.member_id) as member_id, time_period from elig e join win on inc_end between date_start and date_end
      left join xref on e.member_id = prvs_hic_num where upper(assignment_indicator) = 'Y' and e.member_id not like '%3'""",
    "nearest": """
    select time_period, inc_end, date_latestpaid from (select time_period, inc_end, date_latestpaid, row_number() over (partition by time_period
      order by abs(date_latestpaid - inc_end), date_latestpaid desc) as rn from win, (select distinct date_latestpaid from rawstack)) where rn = 1""",
    "feed": """
    select s.member_id, e.elig_status_1, n.time_period, max(case when death is not null then 1 else 0 end) as died_in_period from (
      select coalesce(crnt_hic_num, bene_hic_num) as member_id, date_latestpaid, max(bene_death_dt) as death from rawstack left join xref on bene_hic_num = prvs_hic_num group by 1, 2) s
    join nearest n using (date_latestpaid) left join elig e on s.member_id = e.member_id and n.inc_end between e.date_start and e.date_end group by 1, 2, 3""",
}
_WORD = re.compile(r"[A-Za-z_0-9]+")


def with_ctes(sql: str, ctes: dict[str, str] | None = None) -> str:
    """Prefix a statement with the definitions it uses, in dependency order."""
    ctes = CTE if ctes is None else ctes
    order: list[str] = []

    def need(text: str) -> None:
        for word in dict.fromkeys(_WORD.findall(text)):
            if word in ctes and word not in order:
                need(ctes[word])
                if word not in order:
                    order.append(word)

    need(sql)
    if not order:
        return sql.strip()
    return "WITH " + ",\n".join(f"{n} AS ({ctes[n].strip()})" for n in order) + "\n" + sql.strip()


# rows of a member in a window, by the column that names the window
BY_MEMBER = {
    "mem": "time_period", "pm": "time_period", "prx": "time_period", "mm": "time_period", "dec": "time_period", "assigned": "time_period",
    "feed": "time_period", "comp_fit": "time_slice",
}


def grouped_ctes(closure: str) -> dict[str, str]:
    """Definitions in which every row of a member in a window stands once per group of the member, the group before the window's label.

    ``closure`` selects "group" and member_id. What the plain rows are made of is kept under names of its own."""
    plain: dict[str, str] = {}

    def copy(name: str) -> None:
        if name not in plain:
            plain[name] = ""
            for word in set(_WORD.findall(CTE[name])):
                if word in CTE:
                    copy(word)
            plain[name] = _WORD.sub(lambda m: f"{m[0]}_plain" if m[0] in CTE else m[0], CTE[name])

    for n in BY_MEMBER:
        copy(n)
    out = {**CTE, **{f"{n}_plain": text for n, text in plain.items()}, "of_group": closure}
    for n, label in BY_MEMBER.items():
        out[n] = f"""select b.* replace ("group" || chr(31) || b.{label} as {label}) from {n}_plain b join of_group g on g.member_id = b.member_id"""
    return out
