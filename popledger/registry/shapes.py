"""Single operators over the whole test tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from popledger import checks
from popledger.functions import dates as D, numbers as N, text as X
from popledger.functions.nulls import default_columns, le_missing, null_safe_join, safe_ratio, sum_present
from popledger.oracle.base import CTE
from popledger.operators import aggregate as A, intervals as I, joins as J, ordering as O, reshape as R
from popledger.operators.claims import agg_claims, annualised, bucket_label, claims_in_windows
from popledger.plans import cost_model, exclusions, fixes, inpatient, mart, outpatient, roster, snf
from popledger.plans.roster import EOL_FLAGS
from popledger.registry.base import money, query, ratio, whole
from popledger.sources.readers import optional_table, read_parquet
from popledger.sources.star import StarModel
from popledger.sources.schema import MartSchema, conform, key_violations, value_violations

C = F.col



def _day(c: str):
    return C(c).cast("date")


# -- scans -------------------------------------------------------------------------------


@query("io_scan", "select o_orderkey as order_id, o_custkey as member_id, o_totalprice from orders where o_orderstatus = 'F' and o_totalprice > 100000")
def _(r):
    return read_parquet(
        r.m.spark, f"{r.m.path}/orders.parquet", columns=["o_orderkey", "o_custkey", "o_totalprice"],
        rename={"o_orderkey": "order_id", "o_custkey": "member_id"}, where="o_orderstatus = 'F' and o_totalprice > 100000",
    )


@query("io_optional_source", "select n_regionkey, count(*) as n from nation group by 1")
def _(r):
    nation = r.m.table("nation")
    absent = optional_table(r.m.spark, None, nation.schema)
    return R.stack([nation, absent]).groupBy("n_regionkey").agg(A.freq().alias("n"))


# -- projections and filters ------------------------------------------------------------------


@query("p_prefix_filter", "select p_partkey, p_type, p_brand from part where upper(p_type) like 'S%' and upper(p_brand) not like 'BRAND#1%'")
def _(r):
    return r.m.table("part").where(X.starts_ci("p_type", "s") & ~X.starts_ci("p_brand", "brand#1")).select("p_partkey", "p_type", "p_brand")


@query("p_in_list", "select o_orderkey, o_orderpriority from orders where o_orderpriority in ('1-URGENT', '2-HIGH') and o_orderstatus not in ('P')")
def _(r):
    return r.m.table("orders").where(C("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~C("o_orderstatus").isin("P")).select("o_orderkey", "o_orderpriority")


@query("p_between", "select l_returnflag, count(*) as n from lineitem where l_shipdate between timestamp '1999-01-01' and timestamp '1999-12-31' and l_quantity between 10 and 20 group by 1")
def _(r):
    rows = r.m.table("lineitem").where(
        C("l_shipdate").between(F.expr("timestamp_ntz'1999-01-01'"), F.expr("timestamp_ntz'1999-12-31'")) & C("l_quantity").between(10, 20)
    )
    return rows.groupBy("l_returnflag").agg(A.freq().alias("n"))


@query("p_semi_filter", "select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_orderdate >= timestamp '2000-07-01' and o_orderdate < timestamp '2001-07-01')")
def _(r):
    recent = r.m.table("orders").where("o_orderdate >= timestamp_ntz'2000-07-01' and o_orderdate < timestamp_ntz'2001-07-01'").select(C("o_custkey").alias("c_custkey"))
    return r.m.table("customer").join(recent, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("p_latest_period", "select o_orderkey, o_custkey from orders where date_trunc('month', o_orderdate) = (select max(date_trunc('month', o_orderdate)) from orders)")
def _(r):
    return O.latest(r.m.table("orders").withColumn("_m", D.month_begin(_day("o_orderdate"))), "_m").select("o_orderkey", "o_custkey")


@query("p_regex", "select p_partkey, p_name from part where regexp_matches(p_name, '^(red|blue).*(bolt|ring)', 'i')")
def _(r):
    return r.m.table("part").where(C("p_name").rlike("(?i)^(red|blue).*(bolt|ring)")).select("p_partkey", "p_name")


@query(
    "p_case_forms",
    """select c_custkey, case when c_acctbal < 0 then 'owing' when c_acctbal < 5000 then 'low' else 'high' end as searched,
      case c_mktsegment when 'BUILDING' then 'B' when 'MACHINERY' then 'M' else 'other' end as simple,
      case when c_mktsegment = 'BUILDING' then case when c_acctbal < 0 then 'B-' else 'B+' end else 'none' end as nested from customer""",
)
def _(r):
    bal, seg = C("c_acctbal"), C("c_mktsegment")
    return r.m.table("customer").select(
        "c_custkey",
        F.when(bal < 0, "owing").when(bal < 5000, "low").otherwise("high").alias("searched"),
        F.when(seg == "BUILDING", "B").when(seg == "MACHINERY", "M").otherwise("other").alias("simple"),
        F.when(seg == "BUILDING", F.when(bal < 0, "B-").otherwise("B+")).otherwise("none").alias("nested"),
    )


@query(
    "p_coalesce_many",
    "select coalesce(hcpcs, 'XXXXX') as hcpcs, coalesce(prv_net_aco_yn, 'N') as prv_net_aco_yn, coalesce(providerid, 'Unknown') as providerid, count(*) as n from med group by 1, 2, 3",
)
def _(r):
    filled = default_columns(r.outclaims.select("hcpcs", "prv_net_aco_yn", "providerid"), {"hcpcs": "XXXXX", "prv_net_aco_yn": "N", "providerid": "Unknown"})
    return filled.groupBy("hcpcs", "prv_net_aco_yn", "providerid").agg(A.freq().alias("n"))


@query("p_one_to_many", "select claimid, linenum, prm_line, prm_fromdate, time_period, count(*) as n from pm group by all")
def _(r):
    placed = claims_in_windows(r.outclaims.select("claimid", "linenum", "prm_line", "prm_fromdate", "prm_todate", "paiddate"), r.m.windows)
    return placed.groupBy("claimid", "linenum", "prm_line", "prm_fromdate", "time_period").agg(A.freq().alias("n"))


@query(
    "p_three_way_split",
    """select case when prm_line = 'I31' and prm_fromdate >= date '2000-02-01' then 'snf' when prm_line like 'I%' and prm_line <> 'I31' and prm_fromdate >= date '2000-01-01' then 'ip' else 'rest' end as part,
      prm_line, count(*) as n from med group by 1, 2""",
)
def _(r):
    parts = fixes.split_by_setting(r.outclaims.select("prm_line", "prm_fromdate"), date(2000, 1, 1), date(2000, 2, 1))
    return R.stack([p.groupBy("prm_line").agg(A.freq().alias("n")).withColumn("part", F.lit(n)) for n, p in zip(["snf", "ip", "rest"], parts)])


@query(
    "p_row_pair",
    f"""select l_suppkey, 'qty' as id, {ratio('sum(l_quantity)')} as v from lineitem group by 1
      union all select l_suppkey, 'qty_riskadj', {ratio('sum(l_quantity) / nullif(l_suppkey % 4, 0)')} from lineitem group by 1""",
)
def _(r):
    sums = r.m.table("lineitem").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("q"))
    pair = F.array(
        F.struct(F.lit("qty").alias("id"), C("q").alias("v")),
        F.struct(F.concat_ws("_", F.lit("qty"), F.lit("riskadj")).alias("id"), safe_ratio("q", C("l_suppkey") % 4).alias("v")),
    )
    return sums.select("l_suppkey", F.explode(pair).alias("m")).select("l_suppkey", "m.id", "m.v")


@query("p_list_explode", "select w as word, count(*) as n from (select unnest(string_split(p_name, ' ')) as w from part) group by 1")
def _(r):
    return r.m.table("part").select(F.explode(F.split("p_name", " ")).alias("word")).groupBy("word").agg(A.freq().alias("n"))


@query("p_conditional_update", "select o_orderkey, case when o_orderdate >= timestamp '2000-10-01' and o_orderstatus = 'P' then 'F' else o_orderstatus end as o_orderstatus from orders")
def _(r):
    late = (C("o_orderdate") >= F.expr("timestamp_ntz'2000-10-01'")) & (C("o_orderstatus") == "P")
    return r.m.table("orders").withColumn("o_orderstatus", F.when(late, "F").otherwise(C("o_orderstatus"))).select("o_orderkey", "o_orderstatus")


@query("p_null_order", "select c_custkey, riskscr_mm is null or riskscr_mm <= 11 as short from customer left join (select hicno, min(riskscr_mm) as riskscr_mm from hcc group by 1) on hicno = cast(c_custkey as varchar)")
def _(r):
    months = r.m.hcc_results.groupBy(C("hicno").alias("_h")).agg(F.min("riskscr_mm").alias("_mm"))
    return r.m.table("customer").join(months, C("c_custkey").cast("string") == C("_h"), "left").select("c_custkey", le_missing("_mm", 11).alias("short"))


@query(
    "p_conform",
    f"""select name_client, member_id, time_period, {money('t')} as total_cost from (select 'Sample Client' as name_client, member_id, time_period, sum(paid) as t from lim group by all)""",
)
def _(r):
    declared = conform(r.member_costs, r.schema, "member_costs", {"total_cost": "Total Cost"})
    return declared.withColumn("total_cost", C("total_cost").cast("decimal(24,4)"))


# -- joins ---------------------------------------------------------------------------------------


@query("j_inner", f"select m.elig_status_1, p.time_period, {money('sum(prm_costs)')} as prm_costs, count(*) as n from pm p join mem m on p.member_id = m.member_id and p.time_period = m.time_period group by 1, 2")
def _(r):
    spend = agg_claims(r.outclaims, r.m.windows, ["elig_status_1"], measures={"prm_costs": "prm_costs"}, roster=r.members)
    return spend.withColumnRenamed("claim_lines", "n")


@query(
    "j_left_chain",
    f"""select r_name, p_type, c_mktsegment, count(*) as n, {money('sum(cast(l_extendedprice as decimal(18,4)))')} as price from lineitem left join orders on l_orderkey = o_orderkey left join customer on o_custkey = c_custkey
      left join part on l_partkey = p_partkey left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey group by 1, 2, 3""",
)
def _(r):
    t = r.m.table
    geo = t("nation").join(t("region"), C("n_regionkey") == C("r_regionkey"), "left").select("n_nationkey", "r_name")
    lines = t("lineitem").select("l_orderkey", "l_partkey", N.money("l_extendedprice").alias("price"))
    return (
        lines.join(t("orders").select("o_orderkey", "o_custkey"), C("l_orderkey") == C("o_orderkey"), "left")
        .join(t("customer").select("c_custkey", "c_mktsegment", "c_nationkey"), C("o_custkey") == C("c_custkey"), "left")
        .join(t("part").select("p_partkey", "p_type"), C("l_partkey") == C("p_partkey"), "left")
        .join(geo, C("c_nationkey") == C("n_nationkey"), "left")
        .groupBy("r_name", "p_type", "c_mktsegment").agg(A.freq().alias("n"), F.sum("price").alias("price"))
    )


@query("j_flag", "select member_id, case when member_id in (select member_id from med) then 'Y' else 'N' end as has_claims from member")
def _(r):
    return J.with_flag(r.m.member.select("member_id"), r.outclaims, ["member_id"], "has_claims")


@query("j_right", "select t.member_id, t.elig_month, s.elig_status from mstatus s right join mtime t on s.hicno = t.member_id and s.date_elig_start + 14 = t.elig_month")
def _(r):
    s = r.m.monthly_elig_status.select(C("hicno").alias("member_id"), F.date_add("date_elig_start", 14).alias("elig_month"), "elig_status")
    return s.join(r.m.member_time.select("member_id", "elig_month"), ["member_id", "elig_month"], "right")


@query("j_point_in_span", "select time_period, count(*) as n, count(distinct o_custkey) as members from orders join win on cast(o_orderdate as date) between inc_start and inc_end group by 1")
def _(r):
    placed = I.in_windows(r.m.table("orders").select("o_custkey", _day("o_orderdate").alias("d")), r.m.windows, C("d").between(C("inc_start"), C("inc_end")))
    return placed.groupBy("time_period").agg(A.freq().alias("n"), F.countDistinct("o_custkey").alias("members"))


@query("j_in_span_by_member", "select m.member_id, m.prm_fromdate, e.date_start, count(*) as n from med m join elig e on m.member_id = e.member_id and m.prm_fromdate between e.date_start and e.date_end group by all")
def _(r):
    hits = I.point_in_span(r.outclaims.select("member_id", "prm_fromdate"), "prm_fromdate", r.eligibility.select("member_id", "date_start", "date_end"), "date_start", "date_end", ["member_id"])
    return hits.groupBy("member_id", "prm_fromdate", "date_start").agg(A.freq().alias("n"))


@query("j_band", "select l.member_id, count(*) as n from med l join orders o on l.member_id = cast(o.o_custkey as varchar) and l.prm_fromdate - cast(o.o_orderdate as date) between 0 and 30 group by 1")
def _(r):
    orders = r.m.table("orders").select(C("o_custkey").cast("string").alias("member_id"), _day("o_orderdate").alias("ordered"))
    return I.band_join(r.outclaims.select("member_id", "prm_fromdate"), orders, ["member_id"], "prm_fromdate", "ordered", 0, 30).groupBy("member_id").agg(A.freq().alias("n"))


@query("j_nearest", "select time_period, inc_end, date_latestpaid from nearest")
def _(r):
    return I.nearest_day(r.m.windows.select("time_period", "inc_end"), "inc_end", r.m.member_raw_stack, "date_latestpaid").select("time_period", "inc_end", "date_latestpaid")


@query("j_cross", "select time_period, elig_status_1, mcrm_line from (select distinct time_period, elig_status_1 from mem) cross join (select distinct mcrm_line from link)")
def _(r):
    lines = r.m.link_mr_mcrm_line.where(X.same_ci("lob", r.s.lob)).select("mcrm_line").distinct()
    return r.members.select("time_period", "elig_status_1").distinct().crossJoin(F.broadcast(lines))


@query(
    "j_full_mismatch",
    f"""select k, {money('a')} as a, {money('b')} as b from (select o_custkey as k, sum(cast(o_totalprice as decimal(18,4))) as a from orders group by 1)
      full join (select c_custkey as k, cast(c_acctbal as decimal(18,4)) as b from customer) using (k) where a is distinct from b""",
)
def _(r):
    a = r.m.table("orders").groupBy(C("o_custkey").alias("k")).agg(F.sum(N.money("o_totalprice")).alias("a"))
    b = r.m.table("customer").select(C("c_custkey").alias("k"), N.money("c_acctbal").cast("decimal(28,4)").alias("b"))
    return J.full_mismatch(a, b, ["k"], [("a", "b")])


@query("j_merge_flags", "select k, case when a then 'Y' else 'N' end as in_customer, case when b then 'Y' else 'N' end as in_orders from (select coalesce(c_custkey, o_custkey) as k, c_custkey is not null as a, o_custkey is not null as b from customer full join (select distinct o_custkey from orders) on c_custkey = o_custkey)")
def _(r):
    a = r.m.table("customer").select(C("c_custkey").alias("k"))
    b = r.m.table("orders").select(C("o_custkey").alias("k"))
    return J.merge_flags(a, b, ["k"], ("in_customer", "in_orders"))


@query("j_self", "select i.caseadmitid, i.date_case_latest, x.caseadmitid as readmit_case, x.date_case_earliest as readmit_day from cases i left join cases x on i.prm_readmit_all_cause_caseid = x.caseadmitid")
def _(r):
    i = r.cases.select("caseadmitid", "date_case_latest", C("prm_readmit_all_cause_caseid").alias("_c"))
    x = r.cases.select(C("caseadmitid").alias("readmit_case"), C("date_case_earliest").alias("readmit_day"))
    return i.join(x, C("_c") == C("readmit_case"), "left").drop("_c")


@query("j_lookup", "select l_orderkey, l_linenumber, l_partkey, p_brand, count(*) as n from lineitem left join part on l_partkey = p_partkey group by all")
def _(r):
    ref = r.m.table("part").select(C("p_partkey").alias("l_partkey"), "p_brand")
    lines = r.m.table("lineitem").groupBy("l_orderkey", "l_linenumber", "l_partkey").agg(A.freq().alias("n"))
    return J.strict_lookup(lines, ref, ["l_partkey"])


@query("j_expression", "select s.hicno, t.elig_month, s.elig_status from mstatus s join mtime t on s.hicno = t.member_id and s.date_elig_start + 14 = t.elig_month")
def _(r):
    s, t = r.m.monthly_elig_status, r.m.member_time.select("member_id", "elig_month")
    return s.join(t, (s.hicno == t.member_id) & (F.date_add(s.date_elig_start, 14) == t.elig_month)).select("hicno", "elig_month", "elig_status")


@query("j_substring_key", f"select member_id, time_slice, model_name, {ratio('riskscr_tot')} as riskscr_tot from comp_fit")
def _(r):
    return roster.scores_for_period_type(r.m.component_scores, r.m.windows).select("member_id", "time_slice", "model_name", "riskscr_tot")


@query("j_crosswalk", "select coalesce(crnt_hic_num, bene_hic_num) as member_id, count(*) as n from rawstack left join xref on bene_hic_num = prvs_hic_num group by 1")
def _(r):
    raw = r.m.member_raw_stack.select(C("bene_hic_num").alias("member_id"))
    return J.crosswalk(raw, "member_id", r.m.bene_xref, "prvs_hic_num", "crnt_hic_num").groupBy("member_id").agg(A.freq().alias("n"))


@query("j_three_key", f"select p.time_period, p.prm_line, count(*) as n, {money('sum(prm_costs)')} as prm_costs from prof p group by 1, 2")
def _(r):
    lines = snf.snf_professional_claims(r.medical, r.m.mr_line_info)
    return lines.groupBy("time_period", "prm_line").agg(A.freq().alias("n"), F.sum("prm_costs").alias("prm_costs"))


@query("j_fanout_guard", "select (select count(*) from lineitem) as rows_before, (select count(*) from lineitem left join supplier on l_suppkey = s_suppkey) as rows_after, 'N' as fanned_out")
def _(r):
    lines = r.m.table("lineitem").select("l_suppkey")
    return J.fanout_guard(lines, lines.join(r.m.table("supplier").select("s_suppkey"), C("l_suppkey") == C("s_suppkey"), "left"))


# -- aggregates ---------------------------------------------------------------------------------------


@query("a_group_sum", f"select l_returnflag, l_linestatus, {whole('sum(l_linenumber)')} as l_linenumber, {ratio('sum(l_quantity)')} as l_quantity, {whole('sum(l_suppkey)')} as l_suppkey from lineitem group by 1, 2")
def _(r):
    lines = r.m.table("lineitem").select("l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_suppkey")
    return lines.groupBy("l_returnflag", "l_linestatus").agg(*[F.sum(c).alias(c) for c in A.numeric_columns(lines)])


@query("a_count_freq", "select providerid, hcpcs, count(*) as n from med group by 1, 2")
def _(r):
    return r.outclaims.groupBy("providerid", "hcpcs").agg(A.freq().alias("n"))


@query("a_distinct", "select l_suppkey, count(distinct l_orderkey) as orders, count(distinct l_partkey) as parts from lineitem group by 1")
def _(r):
    return r.m.table("lineitem").groupBy("l_suppkey").agg(F.countDistinct("l_orderkey").alias("orders"), F.countDistinct("l_partkey").alias("parts"))


@query("a_distinct_rows", "select distinct p_brand, p_type from part")
def _(r):
    return r.m.table("part").select("p_brand", "p_type").distinct()


@query("a_min_max", "select o_custkey, min(cast(o_orderdate as date)) as first_day, max(cast(o_orderdate as date)) as last_day from orders group by 1")
def _(r):
    return r.m.table("orders").groupBy("o_custkey").agg(F.min(_day("o_orderdate")).alias("first_day"), F.max(_day("o_orderdate")).alias("last_day"))


@query("a_rate", f"select l_linestatus, {ratio('avg(case when l_returnflag = chr(82) then 1.0 else 0.0 end)')} as rate from lineitem group by 1")
def _(r):
    return r.m.table("lineitem").groupBy("l_linestatus").agg(A.share_of_rows(C("l_returnflag") == "R").alias("rate"))


@query("a_conditional_sum", f"select l_suppkey, {ratio('sum(case when l_returnflag = chr(82) then l_quantity else 0 end)')} as returned, {ratio('sum(case when l_discount > 0.05 then l_quantity else 0 end)')} as discounted from lineitem group by 1")
def _(r):
    return r.m.table("lineitem").groupBy("l_suppkey").agg(
        A.sum_where(C("l_returnflag") == "R", "l_quantity").alias("returned"), A.sum_where(C("l_discount") > 0.05, "l_quantity").alias("discounted")
    )


@query("a_safe_ratio", f"select l_orderkey, {ratio('sum(l_quantity) / nullif(sum(case when l_returnflag = chr(82) then 1 else 0 end), 0)')} as per_return from lineitem group by 1")
def _(r):
    return r.m.table("lineitem").groupBy("l_orderkey").agg(safe_ratio(F.sum("l_quantity"), A.sum_where(C("l_returnflag") == "R", F.lit(1))).alias("per_return"))


@query("a_weighted_mean_skip_null", f"select elig_status_1, time_period, {ratio('sum(riskscr_1 * memmos) / sum(case when riskscr_1 is not null then memmos end)')} as score from mem group by 1, 2")
def _(r):
    return r.members.groupBy("elig_status_1", "time_period").agg(A.weighted_mean_present("riskscr_1", "memmos").alias("score"))


@query("a_weighted_mean_all", f"select elig_status_1, time_period, {ratio('sum(riskscr_1 * memmos) / sum(memmos)')} as score from mem group by 1, 2")
def _(r):
    return r.members.groupBy("elig_status_1", "time_period").agg(A.weighted_mean_all("riskscr_1", "memmos").alias("score"))


@query("a_sum_of_ratio", f"select l_suppkey, {ratio('sum(l_quantity / nullif(l_linenumber, 0))')} as adjusted from lineitem group by 1")
def _(r):
    return r.m.table("lineitem").groupBy("l_suppkey").agg(A.sum_of_ratio("l_quantity", "l_linenumber").alias("adjusted"))


@query("a_any_flag", "select o_custkey, case when max(case when o_orderpriority = '1-URGENT' then 1 else 0 end) = 1 then 'Y' else 'N' end as any_urgent from orders group by 1")
def _(r):
    return r.m.table("orders").groupBy("o_custkey").agg(A.any_row(C("o_orderpriority") == "1-URGENT").alias("any_urgent"))


@query("a_having", f"select l_partkey, {ratio('sum(l_quantity)')} as q, count(*) as n from lineitem group by 1 having sum(l_quantity) > 900 and count(*) > 20")
def _(r):
    return r.m.table("lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("q"), A.freq().alias("n")).where("q > 900 and n > 20")


@query("a_two_stage", "select b as bucket, count(*) as members from (select o_custkey, case when sum(o_totalprice) <= 1000000 then 'small' when sum(o_totalprice) <= 3000000 then 'medium' else 'large' end as b from orders group by 1) group by 1")
def _(r):
    per = r.m.table("orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("t"))
    return per.groupBy(bucket_label("t", [(1000000, "small"), (3000000, "medium")], "large").alias("bucket")).agg(A.freq().alias("members"))


@query("a_reroll", f"select l_returnflag, {ratio('sum(l_quantity)')} as q, count(*) as n from lineitem group by 1")
def _(r):
    fine = r.m.table("lineitem").groupBy("l_returnflag", "l_linestatus", "l_suppkey").agg(F.sum("l_quantity").alias("q"), A.freq().alias("n"))
    return fine.groupBy("l_returnflag").agg(F.sum("q").alias("q"), F.sum("n").alias("n"))


@query("a_grand_total", f"select count(*) as n, {money('sum(cast(l_extendedprice as decimal(18,4)))')} as price from lineitem")
def _(r):
    return r.m.table("lineitem").agg(A.freq().alias("n"), F.sum(N.money("l_extendedprice")).alias("price"))


@query("a_remerge", f"select distinct o_custkey, o_orderstatus, o_orderpriority, {money('sum(cast(o_totalprice as decimal(18,4))) over (partition by o_custkey)')} as total from orders")
def _(r):
    rows = r.m.table("orders").select("o_custkey", "o_orderstatus", "o_orderpriority", N.money("o_totalprice").alias("p"))
    return A.remerge_distinct(rows, ["o_custkey"], ["o_orderstatus", "o_orderpriority"], {"total": "p"})


@query("a_max_of_distinct", "select max(n) as max_util_types from (select metric_id, count(distinct costmodel_util) as n from opl where metric_id is not null group by 1)")
def _(r):
    return outpatient.util_types_per_metric(outpatient.line_metrics(r.m.mr_line_info))


@query("a_group_share", f"select l_suppkey, l_returnflag, {ratio('sum(l_quantity) / sum(sum(l_quantity)) over (partition by l_suppkey)')} as share from lineitem group by 1, 2")
def _(r):
    base = r.m.table("lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.sum("l_quantity").alias("q"))
    return A.with_group_total(base, ["l_suppkey"], "q", "total").select("l_suppkey", "l_returnflag", safe_ratio("q", "total").alias("share"))


@query("a_annualise", f"select member_id, time_period, {ratio('cast(sum(prm_costs) as double) / max(memmos) * 12')} as yearly from lim group by 1, 2")
def _(r):
    return r.member_spend.select("member_id", "time_period", annualised("prm_costs", "memmos").alias("yearly"))


# -- windows, order, set operations ---------------------------------------------------------------------


@query("w_first", "select o_custkey, o_orderkey, d from (select o_custkey, o_orderkey, cast(o_orderdate as date) as d, row_number() over (partition by o_custkey order by cast(o_orderdate as date), o_orderkey) as rn from orders) where rn = 1")
def _(r):
    return O.first_per_group(r.m.table("orders").select("o_custkey", "o_orderkey", _day("o_orderdate").alias("d")), ["o_custkey"], ["d", "o_orderkey"])


@query("w_last", "select o_custkey, o_orderkey, d from (select o_custkey, o_orderkey, cast(o_orderdate as date) as d, row_number() over (partition by o_custkey order by cast(o_orderdate as date) desc, o_orderkey desc) as rn from orders) where rn = 1")
def _(r):
    return O.last_per_group(r.m.table("orders").select("o_custkey", "o_orderkey", _day("o_orderdate").alias("d")), ["o_custkey"], ["d", "o_orderkey"])


@query("w_counter", "select o_orderpriority, o_orderkey, row_number() over (partition by o_orderpriority order by substr(md5(cast(o_orderkey as varchar)), 1, 3), o_orderkey) as n from orders")
def _(r):
    return O.number_in_group(r.m.table("orders").select("o_orderpriority", "o_orderkey"), "o_orderpriority", "o_orderkey", "n")


@query(
    "w_carry_forward",
    f"""select member_id, elig_month, coalesce(last_value(elig_status ignore nulls) over (partition by member_id order by elig_month desc rows unbounded preceding), elig_status_1) as elig_status, {ratio('memmos')} as memmos
      from (select t.member_id, t.elig_month, t.memmos, t.elig_status_1, s.elig_status from mtime t left join mstatus s on s.hicno = t.member_id and s.date_elig_start + 14 = t.elig_month)""",
)
def _(r):
    return cost_model.monthly_status(r.m.member_time, r.m.monthly_elig_status)


@query(
    "w_merge_spans",
    """select member_id, min(date_start) as date_start, max(date_end) as date_end from (select *, sum(opens) over (partition by member_id order by date_start, date_end rows unbounded preceding) as island from (
      select *, case when date_start > max(date_end) over (partition by member_id order by date_start, date_end rows between unbounded preceding and 1 preceding) + 1 then 1 else 0 end as opens from (select distinct * from ospans))) group by member_id, island""",
)
def _(r):
    return I.merge_spans(r.m.order_spans, ["member_id"], "date_start", "date_end", touching_days=1)


@query("o_sorted", f"select p_brand, p_type, count(*) as n, {ratio('sum(p_retailprice)')} as price from part group by 1, 2 order by n desc, p_brand, p_type")
def _(r):
    g = r.m.table("part").groupBy("p_brand", "p_type").agg(A.freq().alias("n"), F.sum("p_retailprice").alias("price"))
    return O.sorted_output(g, C("n").desc(), C("p_brand"), C("p_type"))


@query("o_latest", "select max(time_period) as time_period from mem")
def _(r):
    return r.members.agg(F.max("time_period").alias("time_period"))


@query("u_union", "select o_custkey as k from orders union select c_custkey from customer")
def _(r):
    return r.m.table("orders").select(C("o_custkey").alias("k")).unionByName(r.m.table("customer").select(C("c_custkey").alias("k"))).distinct()


@query("u_union_all", "select n_name as name, n_regionkey, cast(null as double) as bal from nation union all select s_name, null, round(s_acctbal, 6) from supplier union all select c_name, null, round(c_acctbal, 6) from customer")
def _(r):
    t = r.m.table
    return R.stack([
        t("nation").select(C("n_name").alias("name"), "n_regionkey"),
        t("supplier").select(C("s_name").alias("name"), C("s_acctbal").alias("bal")),
        t("customer").select(C("c_name").alias("name"), C("c_acctbal").alias("bal")),
    ])


@query(
    "u_symmetric_difference",
    """select k from ((select o_custkey as k from orders where o_orderstatus = 'F' except select o_custkey from orders where o_orderstatus = 'O')
      union all (select o_custkey as k from orders where o_orderstatus = 'O' except select o_custkey from orders where o_orderstatus = 'F'))""",
)
def _(r):
    side = lambda s: r.m.table("orders").where(C("o_orderstatus") == s).select(C("o_custkey").alias("k"))
    return R.symmetric_difference(side("F"), side("O"))


@query("u_difference", "select p_partkey as k from part except select l_partkey from lineitem where l_returnflag = 'R' and l_shipdate >= timestamp '2000-01-01'")
def _(r):
    returned = r.m.table("lineitem").where("l_returnflag = 'R' and l_shipdate >= timestamp_ntz'2000-01-01'").select(C("l_partkey").alias("k"))
    return r.m.table("part").select(C("p_partkey").alias("k")).subtract(returned)


CTE["snap"] = "select distinct 'P.V' || (o_custkey % 3) || '.D' || strftime(o_orderdate, '%y%m%d') || '.csv' as name, strftime(o_orderdate, '%y%m%d') as stamp, o_orderstatus as s from orders"


@query("snapshot_diff", "select name, stamp from ((select name, stamp from snap where s = 'F' except select name, stamp from snap where s = 'O') union all (select name, stamp from snap where s = 'O' except select name, stamp from snap where s = 'F'))")
def _(r):
    from popledger.sources.readers import snapshots_by_stamp

    name = F.concat(F.lit("P.V"), (C("o_custkey") % 3).cast("string"), F.lit(".D"), F.date_format("o_orderdate", "yyMMdd"), F.lit(".csv"))
    files = r.m.table("orders").select(name.alias("name"), "o_orderstatus")
    received = snapshots_by_stamp(files.where("o_orderstatus = 'F'"))
    present = snapshots_by_stamp(files.where("o_orderstatus = 'O'"))
    return R.symmetric_difference(received, present)


# -- reshape ---------------------------------------------------------------------------------------------


@query("r_unpivot", f"select l_suppkey, 'qty' as metric_id, 'Quantity' as metric_name, {ratio('sum(l_quantity)')} as metric_value from lineitem group by 1 union all select l_suppkey, 'lines', 'Lines', {ratio('count(*)')} from lineitem group by 1")
def _(r):
    wide = r.m.table("lineitem").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("qty"), A.freq().alias("lines"))
    return R.metrics_long(wide, ["l_suppkey"], {"qty": "Quantity", "lines": "Lines"})


@query("r_unpivot_prefix", f"select member_id, time_period, 'Medical' as kind, {ratio('memmos_medical')} as months from mm union all select member_id, time_period, 'Rx', {ratio('memmos_rx')} from mm")
def _(r):
    from popledger.operators.claims import agg_memmos

    return R.unpivot_prefix(agg_memmos(r.eligibility, r.m.windows, ["member_id"]), ["member_id", "time_period"], "memmos", "kind", "months")


@query("r_pivot", "select l_suppkey, " + ", ".join(f"sum(case when l_returnflag = '{f}' then 1 end) as \"{f}\"" for f in "ANR") + " from lineitem group by 1")
def _(r):
    long = r.m.table("lineitem").groupBy("l_suppkey", "l_returnflag").agg(A.freq().alias("n"))
    return R.pivot_ids(long, ["l_suppkey"], "l_returnflag", "n", list("ANR"))


@query("r_sparse_long", "select hicno, time_slice, f as flag from (" + " union all ".join(f"select hicno, time_slice, 'hcc{j}' as f from hcc where hcc{j} = 1" for j in StarModel.HCCS) + ")")
def _(r):
    return R.flags_set(r.m.hcc_results, ["hicno", "time_slice"], [f"hcc{j}" for j in StarModel.HCCS], "flag")


@query("r_one_row", f"select 'lines' as name, {ratio('count(*)')} as value from lineitem union all select 'qty', {ratio('sum(l_quantity)')} from lineitem union all select 'max_part', {ratio('max(l_partkey)')} from lineitem")
def _(r):
    one = r.m.table("lineitem").agg(A.freq().alias("lines"), F.sum("l_quantity").alias("qty"), F.max("l_partkey").alias("max_part"))
    return R.row_to_pairs(one, "name", "value")


@query("r_first_slot", "select s_suppkey, case when s_nationkey % 4 = 0 then s_name when s_suppkey % 3 = 0 then cast(s_nationkey as varchar) end as slot from supplier")
def _(r):
    wide = r.m.table("supplier").select(
        "s_suppkey", F.when(C("s_nationkey") % 4 == 0, "06").otherwise("01").alias("t1"), F.when(C("s_suppkey") % 3 == 0, "06").otherwise("01").alias("t2"),
        C("s_name").alias("i1"), C("s_nationkey").cast("string").alias("i2"),
    )
    return wide.select("s_suppkey", R.first_slot(["t1", "t2"], ["i1", "i2"], "06").alias("slot"))


@query("r_rename_rule", "select a.s_suppkey as key, a.s_name as name from supplier a")
def _(r):
    return R.strip_to_last(r.m.table("supplier").select(C("s_suppkey").alias("s_supp_key"), "s_name"))


# -- scalar functions ----------------------------------------------------------------------------------------


@query(
    "f_text",
    """select p_partkey, upper(p_name) as up, lower(p_type) as low, upper(left(p_type, 1)) || lower(substr(p_type, 2)) as proper, trim('  ' || p_name || ' ') as trimmed, p_type || '_' || p_brand as joined,
      split_part(p_name, ' ', -1) as last_word, split_part(p_name, ' ', 1) as first_word, substr(p_brand, 7) as brand_no, substr(p_type, 1, 3) as head, instr(p_name, 'ring') as at, length(p_name) as len,
      regexp_replace(p_brand, '[^A-Za-z]', '', 'g') as letters, regexp_matches(p_name, '\\bring\\b', 'i') as has_ring, '"' || p_type || '"' as quoted, len(string_split(p_name, ' ')) as words,
      regexp_matches(p_brand, '^[A-Za-z_][A-Za-z0-9_]{0,31}$') as legal, cast(p_size as varchar) as size_text, upper(left(p_type, 1)) || lower(substr(p_type, 2)) as tidy, '20' || p_size as stamp from part""",
)
def _(r):
    n, t, b = C("p_name"), C("p_type"), C("p_brand")
    return r.m.table("part").select(
        "p_partkey", F.upper(n).alias("up"), F.lower(t).alias("low"), F.initcap(t).alias("proper"), F.trim(F.concat(F.lit("  "), n, F.lit(" "))).alias("trimmed"),
        F.concat_ws("_", t, b).alias("joined"), X.word_at(n, -1).alias("last_word"), X.word_at(n, 1).alias("first_word"),
        F.expr("substring(p_brand, 7)").alias("brand_no"), F.substring(t, 1, 3).alias("head"), F.instr(n, "ring").alias("at"), F.length(n).alias("len"),
        X.letters_only(b).alias("letters"), X.has_phrase(n, "ring").alias("has_ring"), X.quoted(t).alias("quoted"), X.word_count(n, " ").alias("words"),
        X.is_identifier(b).alias("legal"), C("p_size").cast("string").alias("size_text"),
        X.tidy_name(F.concat(F.lit(" "), t, F.lit(" ,"))).alias("tidy"),
        X.date_stamp(F.concat(F.lit("/in/P.A1.D20"), C("p_size").cast("string"), F.lit(".txt"))).alias("stamp"),
    )


@query(
    "f_dates",
    """select o_orderkey, cast(date_trunc('month', d) as date) as month_start, last_day(cast(d - interval 2 month as date)) as month_end, year(d) as y, month(d) as m, year(d) || 'Q' || quarter(d) as label,
      d - 90 as back, date '2001-12-31' - d as days, d <= date '9999-12-31' as open_ended, case when date '1996-02-29' > d then 0 else datediff('year', date '1996-02-29', d) - case when d < last_day(make_date(year(d), 2, 1)) then 1 else 0 end end as age
      from (select o_orderkey, cast(o_orderdate as date) as d from orders)""",
)
def _(r):
    d = _day("o_orderdate")
    return r.m.table("orders").select(
        "o_orderkey", D.month_begin(d).alias("month_start"), D.month_end(d, -2).alias("month_end"), F.year(d).alias("y"), F.month(d).alias("m"),
        D.quarter_label(d).alias("label"), F.date_sub(d, 90).alias("back"), D.days_apart(F.lit(date(2001, 12, 31)), d).alias("days"),
        (d <= F.lit(D.OPEN_END)).alias("open_ended"), _leap_age(d).alias("age"),
    )


def _leap_age(d):
    return D.age_at(F.lit(date(1996, 2, 29)), d)


@query(
    "f_math",
    f"""select c_custkey, round(abs(c_acctbal), 6) as a, cast(sign(c_acctbal) as double) as s, floor(c_acctbal)::bigint as fl, ceil(c_acctbal)::bigint as ce, c_custkey % 7 as md, greatest(c_nationkey, c_custkey) as big,
      {ratio('1 / (1 + exp(-c_acctbal / 10000))')} as logi, {ratio('abs(c_acctbal - c_custkey) / nullif(abs(c_acctbal) + abs(c_custkey), 0)')} as smape, cast(round(c_custkey / 5.0) * 5 as double) as to5 from customer""",
)
def _(r):
    b, k = C("c_acctbal"), C("c_custkey")
    return r.m.table("customer").select(
        "c_custkey", F.abs(b).alias("a"), F.sign(b).alias("s"), F.floor(b).alias("fl"), F.ceil(b).alias("ce"), (k % 7).alias("md"), F.greatest(C("c_nationkey").cast("bigint"), k).alias("big"),
        N.logistic(b / 10000).alias("logi"), N.smape(b, k).alias("smape"), N.round_to(k, 5).alias("to5"),
    )


@query(
    "f_nulls",
    f"""select hicno, time_slice, coalesce(t, 'none') as t, {ratio('case when a is null and b is null then null else coalesce(a, 0) + coalesce(b, 0) end')} as total, {ratio('a / nullif(b, 0)')} as q from (
      select hicno, time_slice, nullif(trim(case when origds = 1 then ' ' else sex end), '') as t, case when mcaid = 1 then null else score_community end as a, case when disabl = 1 then null when origds = 1 then 0 else score_new_enrollee end as b from hcc)""",
)
def _(r):
    from popledger.functions.nulls import coalesce_text

    a = F.when(C("mcaid") != 1, C("score_community"))
    b = F.when(C("disabl") == 1, None).when(C("origds") == 1, 0.0).otherwise(C("score_new_enrollee"))
    return r.m.hcc_results.select(
        "hicno", "time_slice", coalesce_text(F.when(C("origds") == 1, " ").otherwise(C("sex")), "none").alias("t"),
        sum_present(a, b).alias("total"), safe_ratio(a, b).alias("q"),
    )


# -- checks ------------------------------------------------------------------------------------------------------


@query("key_violations", "select l_orderkey, l_linenumber, count(*) as rows from lineitem group by 1, 2 having count(*) > 1")
def _(r):
    return checks.duplicate_keys(r.m.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("null_violations", "select claimid, linenum, count(*) as n from med where providerid is null group by 1, 2")
def _(r):
    return checks.nulls_in(r.outclaims, "providerid").groupBy("claimid", "linenum").agg(A.freq().alias("n"))


@query("v_populated", "select 'rows_of_2005' as name_table, count(*) as rows from lineitem where l_shipdate >= timestamp '2005-01-01' having count(*) = 0")
def _(r):
    return checks.populated(r.m.table("lineitem").where("l_shipdate >= timestamp_ntz'2005-01-01'"), "rows_of_2005")


@query(
    "v_populated_months",
    """with m as (select unnest(generate_series(date '1995-01-01', date '2002-06-01', interval 1 month)) as month),
    n as (select date_trunc('month', l_shipdate) as month, count(*) as n from lineitem group by 1)
    select 'lines_' || strftime(m.month, '%Y_%m') as name_table, cast(0 as bigint) as rows from m left join n on m.month = n.month where n.n is null""",
)
def _(r):
    """Months from the first history to half a year past the run without a single line."""
    months = r.m.spark.range(1).select(F.explode(F.expr("sequence(date'1995-01-01', date'2002-06-01', interval 1 month)")).alias("month"))
    return checks.unpopulated_parts(months, r.m.table("lineitem").select(F.trunc(_day("l_shipdate"), "month").alias("month")), "month").select(
        F.concat(F.lit("lines_"), F.date_format("month", "yyyy_MM")).alias("name_table"), "rows"
    )


@query(
    "p_reset",
    """select s_suppkey, 'name' as field, s_name as name, cast(null as bigint) as nation, cast(null as double) as balance from supplier
    union all select s_suppkey, 'nation', null, s_nationkey, null from supplier union all select s_suppkey, 'balance', null, null, s_acctbal from supplier""",
)
def _(r):
    """One output per field; the others are missing again in each."""
    wide = r.m.table("supplier").select("s_suppkey", C("s_name").alias("name"), C("s_nationkey").cast("bigint").alias("nation"), C("s_acctbal").alias("balance"))
    return R.one_field_rows(wide, ["s_suppkey"], ["name", "nation", "balance"], "field")


@query("v_threshold", f"select {ratio('avg(case when memmos = 0 then 1.0 else 0.0 end)')} as value from mem_all where time_period = (select max(time_period) from mem_all) having avg(case when memmos = 0 then 1.0 else 0.0 end) < 0.01")
def _(r):
    newest = O.latest(r.members_all.select("time_period", "memmos"), "time_period")
    return checks.outside(newest, A.share_of_rows(C("memmos") == 0), low=0.01)


@query("v_smape", f"select {ratio('a')} as total_a, {ratio('b')} as total_b, {ratio('round(abs(a - b) / (abs(a) + abs(b)), 4)')} as smape from (select cast(sum(prm_costs) as double) as a from cu), (select cast(sum(prm_costs_sum_all_services) as double) as b from ba)")
def _(r):
    return checks.total_smape(r.cost_util, "prm_costs", r.basic_aggs_elig_status, "prm_costs_sum_all_services")


@query(
    "full_outer_reconcile",
    f"""select time_period, elig_status_1, {ratio('a')} as a_prm_costs, {ratio('b')} as b_paid from (select time_period, elig_status_1, round(cast(sum(prm_costs) as double), 2) as a from cu group by 1, 2)
      full join (select time_period, elig_status_1, round(cast(sum(paid) as double), 2) as b from lim where prm_coverage_type = 'Rx' group by 1, 2) using (time_period, elig_status_1) where a is distinct from b""",
)
def _(r):
    rx = agg_claims(r.outpharmacy, r.m.windows, ["elig_status_1"], measures={"paid": "paid"}, roster=r.members)
    return checks.rounded_totals_differ(r.cost_util, rx, ["time_period", "elig_status_1"], [("prm_costs", "paid", 2)])


@query(
    "category_coverage",
    "select coalesce(e.c, o.c) as metric_category, case when e.c is null then 'N' else 'Y' end as in_expected, case when o.c is null then 'N' else 'Y' end as in_observed from (select unnest(string_split('inpatient~discharge_status~snf~er~outpatient~end_of_life~basic', '~')) as c) e full join (select distinct lower(c) as c from (select 'Basic' as c from ba union select 'Inpatient' from ipp union select 'unlisted' from mem)) o on e.c = o.c where e.c is null or o.c is null",
)
def _(r):
    other = r.members.select(F.lit("unlisted").alias("metric_category")).distinct()
    observed = R.stack([r.metrics_basic.select("metric_category"), r.metrics_inpatient.select("metric_category"), other])
    return checks.category_coverage(observed, r.schema)


@query(
    "v_schema_values",
    """select 'memmos' as name_table, 'prm_coverage_type' as name_field, 'too long' as rule, count(*) as rows from mm join mem using (member_id, time_period) where length(elig_status_1) > 8 having count(*) > 0
      union all select 'memmos', 'prm_coverage_type', 'not allowed', count(*) from mm join mem using (member_id, time_period)
      union all select 'memmos', 'elig_status_1', 'null', count(*) from mm join mem using (member_id, time_period) where riskscr_1 is null""",
)
def _(r):
    # a month table with wrong coverage types and some missing statuses
    wrong = r.members.select(
        F.lit(r.s.client).alias("name_client"), "time_period", F.when(C("riskscr_1").isNotNull(), C("elig_status_1")).alias("elig_status_1"),
        C("elig_status_1").alias("prm_coverage_type"), C("memmos").alias("prm_memmos"),
    )
    return value_violations(conform(wrong, r.schema, "memmos"), r.schema, "memmos")


@query("v_metric_ids", "select distinct p_brand as metric_id from part where not regexp_matches(p_brand, '^[A-Za-z_][A-Za-z0-9_]{0,31}$')")
def _(r):
    return checks.bad_metric_ids(r.m.table("part").select(C("p_brand").alias("metric_id")))


@query("v_unit_types", "select max(n) as max_util_types from (select metric_id, count(distinct costmodel_util) as n from opl where metric_id is not null group by 1)")
def _(r):
    return outpatient.util_types_per_metric(outpatient.line_metrics(r.m.mr_line_info))


@query("v_days_only", f"select {whole('sum(case when upper(prm_util_type) <> chr(68) || chr(65) || chr(89) || chr(83) then 1 else 0 end)')} as rows_other_unit from ipc")
def _(r):
    return checks.unit_types(r.inpatient_claims)


@query("v_label_problems", "select min(p_brand) as meta_field, p_type as meta_field_label, 'duplicate' as problem from part group by p_type having count(*) > 1")
def _(r):
    fields = r.m.table("part").select(C("p_brand").alias("meta_field"), C("p_type").alias("meta_field_label"))
    return checks.label_problems(fields)


# -- mart -----------------------------------------------------------------------------------------------------------


@query("meta_field_use", "select 'p_brand' as meta_field, count(distinct p_brand) as n from part union all select 'p_type', count(distinct p_type) from part")
def _(r):
    return r.m.table("part").agg(F.countDistinct("p_brand").alias("p_brand"), F.countDistinct("p_type").alias("p_type")).unpivot([], ["p_brand", "p_type"], "meta_field", "n")
