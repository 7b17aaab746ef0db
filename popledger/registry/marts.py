"""Queries over the stored mart: its manifest, dictionary and rules, and the checks between its tables.

A check of a correct mart finds nothing, which tells little. So each check here reads one side with faults planted in it: rows named by a
fault table derived from the input get another value, and the check must return exactly what the faults explain."""

from __future__ import annotations

from pyspark.sql import functions as F

from popledger import checks
from popledger.operators.reshape import stack
from popledger.oracle.base import CTE
from popledger.plans import mart
from popledger.plans.roster import EOL_FLAGS
from popledger.registry import results
from popledger.registry.base import ORACLES, mart_query, money, ratio, whole
from popledger.sources.schema import MartSchema, clear_labels, key_violations, labels_of, rule_results
from popledger.sources.writers import checksum

C = F.col
KEYS = ["time_period", "elig_status_1"]

# -- fault tables: members, and one member status -------------------------------------------------

FAULTY = "(select cast(c_custkey as varchar) from customer where c_custkey % 10 = 7)"
FAULTY_STATUS = "case when elig_status_1 like 'B%' then 1 else 0 end"


def faulty_members(r):
    return r.m.table("customer").where("c_custkey % 10 = 7").select(C("c_custkey").cast("string").alias("member_id"))


def faulty_status(r):
    return r.m.table("customer").where("c_mktsegment like 'B%'").select(C("c_mktsegment").alias("elig_status_1")).distinct()


# -- the declared tables in SQL ---------------------------------------------------------------------

TABLE_QUERIES = {
    "time_windows": "time_windows", "memcnt": "memcnt", "cost_util": "cost_util", "memmos": "memmos", "ref_prm_line": "ref_lines",
    "claims_distribution": "claims_distribution", "office_admin_drug": "office_drug", "member_elig": "member_elig", "member_costs": "member_costs",
    "cost_util_benchmark": "benchmarks", "details_inpatient": "inpatient_details", "details_snf": "snf_details",
    "details_snf_professional": "professional_link", "metrics_key_value": "metrics_key_value",
}
# The settings of a test run as metadata rows: name, string, date, integer.
PROJECT_ROWS = [
    ("paid_thru", None, "2001-10-31", None), ("credible_start", None, "1999-01-01", None), ("history_cutoff", None, "1999-01-01", None),
    ("runout_months", None, None, 2), ("lob", "MEDICARE", None, None),
]
# Labels of the test run.
FIELD_LABELS = {"elig_status_1": "Beneficiary Status", "metric_id": "Metric Identifier", "metric_name": "Metric Description"}


def _text(v) -> str:
    return "null" if v is None else f"'{v}'" if isinstance(v, str) else str(v)


def table_sql() -> dict[str, str]:
    """Every declared table as SQL."""
    out = {t: f"select * from ({ORACLES[q]})" for t, q in TABLE_QUERIES.items()}
    schema = MartSchema.declared()
    fields = sorted({c for t in schema.tables for c in schema.columns(t)})
    out["meta_field"] = "select 'Sample Client' as name_client, f as meta_field, l as meta_field_label, replace(f, '_', ' ') as meta_field_comment from (values " + ", ".join(
        f"('{f}', {_text(FIELD_LABELS.get(f))})" for f in fields) + ") v(f, l)"
    out["meta_project"] = (
        "select 'Sample Client' as name_client, n as meta_project, s as meta_project_string, cast(d as date) as meta_project_date, i as meta_project_integer, 'Run setting ' || n as meta_project_notes from (values "
        + ", ".join(f"({', '.join(_text(v) for v in row)})" for row in PROJECT_ROWS) + ") v(n, s, d, i)"
    )
    return out


TABLE_SQL = table_sql()
_ROWS = " union all ".join(f"select '{t}' as name_table, count(*) as rows from ({s})" for t, s in TABLE_SQL.items())

# -- manifest, dictionary, metadata --------------------------------------------------------------------


@mart_query("mart_tables", _ROWS)
def _(r, s):
    """Rows of every declared table, as the writer counted them."""
    return s.table("manifest").select("name_table", "rows")


@mart_query("mart_manifest", f"select name_table, rows, true as agrees from ({_ROWS})")
def _(r, s):
    """The counts and checksums taken while writing, against the tables as they are read."""
    again = stack([checksum(df, n) for n, df in s.tables().items()]).withColumnsRenamed({"rows": "rows_read", "checksum": "checksum_read"})
    agrees = C("rows").eqNullSafe(C("rows_read")) & C("checksum").eqNullSafe(C("checksum_read"))
    return s.table("manifest").join(again, "name_table", "full").select("name_table", "rows", agrees.alias("agrees"))


def _null_sql() -> str:
    schema = MartSchema.declared()
    return " union all ".join(
        f"select '{t}' as name_table, name_field, nulls from (unpivot (select "
        + ", ".join(f'count(*) filter ("{c}" is null) as "{c}"' for c in schema.columns(t))
        + f" from ({s})) on columns(*) into name name_field value nulls) where nulls > 0"
        for t, s in TABLE_SQL.items()
    )


@mart_query("mart_nulls", _null_sql())
def _(r, s):
    """Fields with missing values, as the writer counted them."""
    return s.table("manifest_fields").where("nulls > 0").select("name_table", "name_field", "nulls")


def _dictionary_sql() -> str:
    schema, parts = MartSchema.declared(), []
    for t, s in TABLE_SQL.items():
        cols = schema.columns(t)
        value = lambda c: f'round(cast("{c}" as double), 2)' if schema.fields[c].type == "float" else f'"{c}"'
        counts = ", ".join(f'count("{c}") as p{i}, count(distinct {value(c)}) as d{i}' for i, c in enumerate(cols))
        rows = ", ".join(
            f"{{'position': {i + 1}, 'f': '{c}', 't': '{schema.fields[c].type}', 's': {_text(schema.fields[c].size)}, "
            f"'k': '{'Y' if c in schema.keys(t) else 'N'}', 'l': {_text(FIELD_LABELS.get(c))}, 'p': p{i}, 'd': d{i}}}"
            for i, c in enumerate(cols)
        )
        parts.append(
            f"select '{t}' as name_table, cast(x.position as bigint) as position, x.f as name_field, x.t as data_type, cast(x.s as bigint) as data_size, x.k as key_table, "
            f"cast(x.l as varchar) as label, x.p as values_present, x.d as values_distinct from (select unnest([{rows}]) as x from (select {counts} from ({s})))"
        )
    return " union all ".join(parts)


_DICTIONARY = _dictionary_sql()


@mart_query("data_dictionary", _DICTIONARY)
def _(r, s):
    """First sheet: every field of every table."""
    return s.dictionary()


@mart_query(
    "dictionary_fields",
    f"""select name_field, data_type, data_size, max(label) as label, min(position) as first_position, count(*) as tables, {whole('sum(values_present)')} as values_present
    from ({_DICTIONARY}) group by all""",
)
def _(r, s):
    """Second sheet: each field once."""
    return mart.dictionary_fields(s.dictionary())


@mart_query(
    "meta_field",
    f"""select name_client, meta_field, meta_field_label, meta_field_comment, tables, values_present from ({TABLE_SQL['meta_field']})
    left join (select name_field as meta_field, count(*) as tables, {whole('sum(values_present)')} as values_present from ({_DICTIONARY}) group by 1) using (meta_field)""",
)
def _(r, s):
    """Field metadata beside the tables that deliver the field and the values they hold."""
    return mart.field_use(s.table("meta_field"), s.dictionary())


@mart_query(
    "meta_project",
    f"""select name_client, meta_project, meta_project_string, meta_project_date, {whole('meta_project_integer')} as meta_project_integer, meta_project_notes, w.n as windows
    from ({TABLE_SQL['meta_project']}), (select count(*) as n from ({TABLE_SQL['time_windows']}) where paid_thru <= date '2001-10-31') w""",
)
def _(r, s):
    """Run settings, and the windows of the mart that lie within its paid-through day."""
    settings, windows = s.table("meta_project"), s.table("time_windows")
    paid = settings.where("meta_project = 'paid_thru'").select(C("meta_project_date").alias("_paid"))
    within = windows.join(paid, C("paid_thru") <= C("_paid")).agg(F.count(F.lit(1)).alias("windows"))
    return settings.join(within)


@mart_query(
    "p_labels",
    " union all ".join(
        f"select '{t}' as name_table, '{f}' as name_field, '{label}' as label, cast(null as varchar) as cleared, (select count(*) from ({s})) as rows"
        for t, s in TABLE_SQL.items() for f, label in FIELD_LABELS.items() if f in MartSchema.declared().columns(t)
    ),
)
def _(r, s):
    """Labels that the stored tables carry, before and after they are cleared."""
    found = []
    for t, df in s.tables().items():
        bare = labels_of(clear_labels(df))
        found += [(t, f, label, bare.get(f)) for f, label in labels_of(df).items()]
    labels = r.m.spark.createDataFrame(found, "name_table string, name_field string, label string, cleared string")
    return labels.join(s.table("manifest").select("name_table", "rows"), "name_table")


# -- declared rules ------------------------------------------------------------------------------------


_MEMCNT_KEY = ", ".join(f'"{c}"' for c in MartSchema.declared().keys("memcnt"))
# planted violations, then those the tables have by themselves: members scored by hand, statuses that are missing
_VIOLATIONS = f"""
    select 'member_costs' as name_table, count(*) as extra, count(*) as violations from ({TABLE_SQL['member_costs']}) where member_id in {FAULTY}
    union all select 'memmos', 0, count(*) + count(distinct (time_period, elig_status_1)) from ({TABLE_SQL['memmos']}) where elig_status_1 like 'B%'
    union all select 'member_elig', 0, count(*) from ({TABLE_SQL['member_elig']}) where member_id in {FAULTY}
    union all select 'memcnt', 0, count(*) filter (risk_score_type not in ('CMS HCC Risk Score', 'Component Risk Score')) + count(*) filter (riskscr_avg is null)
      + count(*) - count(distinct ({_MEMCNT_KEY})) from ({TABLE_SQL['memcnt']})
    union all select 'metrics_key_value', 0, count(*) filter (elig_status_1 is null) from ({TABLE_SQL['metrics_key_value']})"""


@mart_query(
    "mart_rules",
    f"""select t.name_table, cast(t.rows + coalesce(f.extra, 0) as bigint) as checked, cast(coalesce(f.violations, 0) as bigint) as violations
    from ({_ROWS}) t left join ({_VIOLATIONS}) f using (name_table)""",
)
def _(r, s):
    """Every declared rule of all tables: doubled keys, a value that is not allowed and another client are planted."""
    tables = s.tables()
    doubled = tables["member_costs"].join(faulty_members(r), "member_id", "left_semi")
    tables["member_costs"] = tables["member_costs"].unionByName(doubled)
    tables["memmos"] = checks.with_fault(tables["memmos"], faulty_status(r), ["elig_status_1"], {"prm_coverage_type": F.lit("Other")})
    tables["member_elig"] = checks.with_fault(tables["member_elig"], faulty_members(r), ["member_id"], {"name_client": F.lit("Other Client")})
    found = stack([rule_results(df, s.schema, n, s.s.client) for n, df in tables.items()])
    return found.groupBy("name_table").agg(F.max("checked").alias("checked"), F.sum("rows").alias("violations"))


@mart_query("v_declared_keys", f"select name_client, member_id, time_period, cast(2 as bigint) as rows from ({TABLE_SQL['member_costs']}) where member_id in {FAULTY}")
def _(r, s):
    """Faulty members' costs are delivered twice."""
    costs = s.table("member_costs")
    return key_violations(costs.unionByName(costs.join(faulty_members(r), "member_id", "left_semi")), s.schema, "member_costs")


@mart_query("v_client_column", f"select distinct 'member_elig' as name_table, 'Other Client' as name_client from ({TABLE_SQL['member_elig']}) where member_id in {FAULTY}")
def _(r, s):
    """All tables; the months of faulty members name another client."""
    tables = s.tables()
    tables["member_elig"] = checks.with_fault(tables["member_elig"], faulty_members(r), ["member_id"], {"name_client": F.lit("Other Client")})
    return checks.client_names(tables, s.s.client)


# -- checks between tables --------------------------------------------------------------------------------


@mart_query("v_count_equals", f"select (select count(*) from mem where member_id not in {FAULTY}) as rows_a, (select count(*) from mem_all) as rows_b where rows_a <> rows_b")
def _(r, s):
    """Faulty members are missing from the roster."""
    return checks.count_mismatch(r.members.join(faulty_members(r), "member_id", "left_anti"), r.members_all)


@mart_query("v_months_reconcile", f"""select member_id, time_period, a as a_memmos, b as b_elig_months from (select member_id, time_period, round(sum(memmos + case when member_id in {FAULTY} then 1 else 0 end), 2) as a from mem group by 1, 2)
      full join (select member_id, time_period, round(sum(t.memmos), 2) as b from mtime t join win on elig_month between inc_start and inc_end join mem using (member_id, time_period) group by 1, 2) using (member_id, time_period)
      where a is distinct from b""")
def _(r, s):
    """Faulty members have a month too many in the roster."""
    members = r.members.select("member_id", "time_period", "memmos")
    return checks.months_differ(checks.with_fault(members, faulty_members(r), ["member_id"], {"memmos": C("memmos") + 1}), s.table("member_elig"))


@mart_query("v_member_costs_reconcile", f"""select time_period, {money('a')} as a_total_cost, {money('b')} as b_prm_paid from (select time_period, cast(sum(paid) as double) + 100 * count(distinct case when member_id in {FAULTY} then member_id end) as a from lim group by 1)
      full join (select time_period, cast(sum(prm_paid) as double) as b from cu group by 1) using (time_period) where round(a, 2) is distinct from round(b, 2)""")
def _(r, s):
    """Faulty members cost a hundred more in the member table."""
    costs = checks.with_fault(s.table("member_costs"), faulty_members(r), ["member_id"], {"total_cost": C("total_cost") + 100})
    return checks.member_costs_differ(costs, s.table("cost_util"))


def faulty_metrics(r, s):
    """Metrics in which the values of one status are one too high."""
    return checks.with_fault(s.table("metrics_key_value"), faulty_status(r), ["elig_status_1"], {"metric_value": C("metric_value") + 1})


@mart_query("v_metric_rederived", f"""select 'prm_costs_sum_all_services' as metric_id, time_period, elig_status_1, a as check_value, b as metric_value from (select time_period, elig_status_1, round(cast(sum(prm_costs) as double)) as a from cu group by 1, 2)
      join (select time_period, elig_status_1, round(cast(prm_costs_sum_all_services as double) + {FAULTY_STATUS}) as b from ba) using (time_period, elig_status_1) where a is distinct from b
      union all select 'discharges_sum_all_services', time_period, elig_status_1, a, b from (select time_period, elig_status_1, round(cast(sum(prm_discharges) as double)) as a from cu where prm_coverage_type = 'Medical' group by 1, 2)
      join (select time_period, elig_status_1, round(cast(discharges_sum_all_services as double) + {FAULTY_STATUS}) as b from ba) using (time_period, elig_status_1) where a is distinct from b
      union all select 'pct_office_visits_pcp', time_period, elig_status_1, round(a, 6), round(b + {FAULTY_STATUS}, 6) from (select time_period, elig_status_1, sum(case when prm_line = 'P32c' then prm_util else 0 end) / sum(prm_util) as a from cu where prm_line like 'P32%' group by 1, 2)
      join (select time_period, elig_status_1, sum(case when prm_line = 'P32c' then prm_util else 0 end) / sum(prm_util) as b from opc where prm_line like 'P32%' group by 1, 2) using (time_period, elig_status_1) where round(a, 6) is distinct from round(b + {FAULTY_STATUS}, 6)""")
def _(r, s):
    costs, metrics = s.table("cost_util"), faulty_metrics(r, s)
    return stack([
        checks.metric_differs(costs, metrics, "prm_costs_sum_all_services", "prm_costs", coverage=None),
        checks.metric_differs(costs, metrics, "discharges_sum_all_services", "prm_discharges"),
        checks.office_visits_differ(costs, metrics),
    ])


PREFIX_SQL = "\nunion all\n".join(
    f"select time_period, elig_status_1, '{m}' as metric_id, {ratio(f'sum({c})')} as check_value, {ratio(f'sum({c})')} as metric_value from cu where prm_coverage_type = 'Medical' and lower(prm_line) like '{p.lower()}%'"
    + (f" and lower(prm_line) not in ({', '.join(repr(x.lower()) for x in out)})" if out else "")
    + f" and (time_period, elig_status_1) in (select time_period, elig_status_1 from {src}) group by 1, 2"
    for (m, c, p, out), src in zip(checks.PREFIX_RULES, ["ipm"] * 4 + ["opu"] * 4 + ["snfm", "edc"])
)


@mart_query("v_prefix_metrics", PREFIX_SQL)
def _(r, s):
    return checks.all_prefix_metrics(s.table("cost_util"), s.table("metrics_key_value"))


@mart_query("v_memmos_reconcile", f"select a as memmos_check, b as memmos_metric from (select sum(mm.memmos_medical) as a from mm join mem using (member_id, time_period)), (select sum(memmos_sum + {FAULTY_STATUS}) as b from ba) where round(a) is distinct from round(b)")
def _(r, s):
    return checks.memmos_differ(s.table("memmos"), faulty_metrics(r, s))


@mart_query("v_discharges_agree", f"""select a as cost_model_discharges, b as ip_disch from (select cast(sum(prm_discharges) as double) as a from cu where upper(prm_line) <> 'I31'),
      (select sum(metric_value + {FAULTY_STATUS}) as b from ({results._DS_SQL})) where a is distinct from b""")
def _(r, s):
    return checks.discharges_differ(s.table("cost_util"), faulty_metrics(r, s).where("metric_category = 'discharge_status'"))


@mart_query("v_living_flags", "select time_period, elig_status_1, deceased_yn from mc where deceased_yn = 'N' and elig_status_1 like 'B%'")
def _(r, s):
    """Living members of one status have hospice days."""
    counts = checks.with_fault(s.table("memcnt"), faulty_status(r), ["elig_status_1"], {"final_hospice_days": F.lit(3).cast("bigint")})
    return checks.living_with_death_data(counts, EOL_FLAGS).select("time_period", "elig_status_1", "deceased_yn")


def faulty_stays(s, changes):
    """Inpatient details in which the stays that ended with death are changed."""
    details = s.table("details_inpatient")
    dead = details.where("discharge_status_desc = 'Died'").select("discharge_status_code").distinct()
    return checks.with_fault(details, dead, ["discharge_status_code"], changes)


@mart_query("v_non_acute", "select time_period, prv_id_inpatient from ipd where discharge_status_code = '20'")
def _(r, s):
    return checks.non_acute_rows(faulty_stays(s, {"acute_yn": F.lit("N")})).select("time_period", "prv_id_inpatient")


CTE["ipd_faulty"] = "select * replace (sum_costs_inpatient + case when discharge_status_code = '20' then 1 else 0 end as sum_costs_inpatient) from ipd"
CTE["snfd_faulty"] = "select * replace (sum_days_snf + case when prv_id_snf = 'Unknown' then 1 else 0 end as sum_days_snf) from snfd"
DETAILS_SQL = " union all ".join(
    f"""select time_period, elig_status_1, '{rule}' as rule from (select time_period, elig_status_1, sum({d}) as d, sum({u}) as u, round(cast(sum({c}) as double), 2) as c from {src} where {w1} group by 1, 2) a
      full join (select time_period, elig_status_1, sum(prm_discharges) as d2, sum(prm_days) as u2, round(cast(sum(prm_costs) as double), 2) as c2 from cu where {w2} group by 1, 2) b using (time_period, elig_status_1)
      where d is distinct from d2 or u is distinct from u2 or c is distinct from c2"""
    for rule, src, d, u, c, w1, w2 in [
        ("acute_yn=Y", "ipd_faulty", "cnt_discharges_inpatient", "sum_days_inpatient", "sum_costs_inpatient", "acute_yn = 'Y'", "prm_line like 'I%' and prm_line <> 'I31'"),
        ("medical_surgical=Medical", "ipd_faulty", "cnt_discharges_inpatient", "sum_days_inpatient", "sum_costs_inpatient", "medical_surgical = 'Medical'", "prm_line like 'I11%'"),
        ("medical_surgical=Surgical", "ipd_faulty", "cnt_discharges_inpatient", "sum_days_inpatient", "sum_costs_inpatient", "medical_surgical = 'Surgical'", "prm_line like 'I12%'"),
        ("medical_surgical=None", "ipd_faulty", "cnt_discharges_inpatient", "sum_days_inpatient", "sum_costs_inpatient", "medical_surgical = 'None'", "prm_line like 'I%' and upper(prm_line) not in ('I31', 'I11A', 'I11B', 'I11C', 'I12')"),
        ("snf", "snfd_faulty", "cnt_discharges_snf", "sum_days_snf", "sum_costs_snf", "true", "prm_line = 'I31'"),
    ]
)


@mart_query("v_details_reconcile", DETAILS_SQL)
def _(r, s):
    """Costs of stays that ended with death are one too high, and so are the days of nursing stays without a provider."""
    costs = s.table("cost_util")
    stays = faulty_stays(s, {"sum_costs_inpatient": C("sum_costs_inpatient") + 1})
    frames = [
        checks.details_differ(stays, costs, f, v, p, out).select(*KEYS, F.lit(f"{f}={v}").alias("rule"))
        for f, v, p, out in checks.DETAIL_RULES
    ]
    nursing = s.table("details_snf")
    unknown = nursing.where("prv_id_snf = 'Unknown'").select("prv_id_snf").distinct()
    days = checks.with_fault(nursing, unknown, ["prv_id_snf"], {"sum_days_snf": C("sum_days_snf") + 1})
    return stack([*frames, checks.snf_details_differ(days, costs).select(*KEYS, F.lit("snf").alias("rule"))])
