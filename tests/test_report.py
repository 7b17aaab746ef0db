"""A whole report: written, checked against itself, and against DuckDB."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from popledger import checks
from popledger.plans import case_mix, roster
from popledger.sources.schema import schema_violations

duckdb = pytest.importorskip("duckdb")

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
@pytest.fixture(scope="module")
def stored(report, tmp_path_factory):
    return report.write(str(tmp_path_factory.mktemp("mart")))


def test_every_declared_table_is_written_as_declared(stored):
    for name in stored.schema.tables:
        assert schema_violations(stored.table(name), stored.schema, name) == []


def test_tables_reconcile(stored):
    failed = {n: df.take(3) for n, df in stored.reconciliations().items() if not df.isEmpty()}
    assert failed == {}


def test_declared_keys_are_unique(stored):
    for name in ["cost_util", "memmos", "claims_distribution", "office_admin_drug", "member_costs", "member_elig", "metrics_key_value", "time_windows"]:
        assert checks.duplicate_keys(stored.table(name), stored.schema.keys(name)).isEmpty(), name


def test_dictionary_counts_values_by_field_number(spark, report):
    """Cells travel as numbers, not as the names of their table and field, and the counts are those of the tables."""
    from popledger.plans import mart

    ddl = lambda t: ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in report.schema.struct(t).fields)
    costs = [("C", "a", "w", 1.001), ("C", "b", None, 1.004), ("C", None, "w", None), (None, "a", "v", -2.0)]
    tables = {"member_costs": spark.createDataFrame([dict(zip(("name_client", "member_id", "time_period", "total_cost"), r)) for r in costs], ddl("member_costs")),
              "memmos": spark.createDataFrame([{"name_client": "C", "prm_coverage_type": "Rx"}], ddl("memmos"))}
    found = mart.data_dictionary(tables, report.schema)
    counts = {(r.name_table, r.name_field): (r.values_present, r.values_distinct) for r in found.collect()}
    for t, df in tables.items():
        for c in df.columns:
            have = [round(v, 2) if isinstance(v, float) else v for v in (r[c] for r in df.collect()) if v is not None]
            assert counts[t, c] == (len(have), len(set(have))), (t, c)
    dealt = [x for x in found._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning" in x]
    assert dealt and not any("name_table" in x or "name_field" in x for x in dealt), dealt


def test_what_metrics_share_with_tables_is_stored_once(spark, model, tmp_path):
    """Results that are tables of the mart and the source of metrics, or that a metric reads on both sides, come from their own files."""
    from popledger.plans.report import Report

    staged = Report(model, folder=str(tmp_path / "stages"))
    for name, file in [("details_inpatient", "details_inpatient-"), ("details_snf_professional", "details_snf_professional-"), ("feed", "feed-"), ("assigned", "assigned-")]:
        files = getattr(staged, name).inputFiles()
        assert files and all(f"/{file}" in f for f in files), name
    plain = Report(model)
    for name in ("metrics_cclf_assign", "metrics_snf_professional", "metrics_discharge_status", "metrics_claims_percentages"):
        got, want = getattr(staged, name), getattr(plain, name)
        rows = lambda df: sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*want.columns).fillna("-").collect())
        assert rows(got) == rows(want) != [], name


def test_enforce_raises_or_warns(spark):
    rows = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(checks.CheckFailed):
        checks.enforce(checks.duplicate_keys(rows, ["k"]), "twice")
    assert checks.enforce(checks.duplicate_keys(rows, ["k"]), "twice", notify_only=True) is False
    assert checks.enforce(checks.nulls_in(rows, "k"), "no nulls") is True


def test_roster_in_one_pass_equals_the_plain_one(report):
    plain = roster.member_roster(report.eligibility, report.m.member, report.m.windows)
    cols = ["member_id", "time_period", "elig_status_1", "riskscr_1_type"]
    fast = roster.roster_with_months(report.eligibility, report.m.member, report.m.windows)
    assert Counter(plain.select(*cols).collect()) == Counter(fast.select(*cols).collect())


def test_adjusted_shares_add_up(report):
    counts = case_mix.case_counts(report.details_inpatient)
    normal = case_mix.normalised(case_mix.fit_shares(case_mix.fit_cells(counts, report._keep, rounds=2)), case_mix.raw_shares(counts))
    sums = normal.groupBy("time_period", "prv_id_inpatient").agg(F.sum("mu_normalized").alias("s"))
    assert sums.where("abs(s - 1) > 1e-9").isEmpty() and sums.count() > 0
    assert case_mix.distortion(normal).where("mu_comp_normalized not between 0 and 1").isEmpty()


def test_case_mix_separates_providers_from_case_types(spark, report):
    """A provider with hard cases only is not taken for a bad one, and the fit finds effects that were planted."""
    import math

    logistic = lambda x: 1 / (1 + math.exp(-x))
    providers, drgs = [-1.0, -0.5, 0.0, 0.5, 1.0], [-1.2, -0.4, 0.4, 1.2]
    rows = []
    for p, u in enumerate(providers):
        for t, v in enumerate(drgs):
            n = 4000 if (p + t) % 2 else 400
            died = round(n * logistic(-0.3 + u + v))
            rows += [("w", f"P{p}", "Died", f"D{t}", died), ("w", f"P{p}", "Home", f"D{t}", n - died)]
    counts = spark.createDataFrame(rows, "time_period string, prv_id_inpatient string, discharge_status_desc string, drg string, discharges_sum bigint")
    fitted = case_mix.fit_shares(case_mix.fit_cells(counts, report._keep, rounds=14)).where("discharge_status_desc = 'Died'").collect()
    found = {r.prv_id_inpatient: math.log(r.mu / (1 - r.mu)) for r in fitted}
    for p, u in enumerate(providers):
        assert abs(found[f"P{p}"] - (-0.3 + u)) < 0.1, (p, found)
    assert all(r.converged for r in fitted)


@pytest.fixture(scope="module")
def con(small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{small}/{t}.parquet'")
    return c


def names():
    from popledger.registry import ORACLES

    return sorted(ORACLES)


@pytest.mark.parametrize("name", names())
def test_query_equals_duckdb(spark, small, con, name):
    from popledger.registry import ORACLES, QUERIES

    df = QUERIES[name](spark, small)
    cols = sorted(df.columns)
    got = Counter(tuple(r) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    result = con.execute(ORACLES[name])
    order = [d[0] for d in result.description]
    assert sorted(order) == cols
    assert got == Counter(tuple(row[order.index(c)] for c in cols) for row in result.fetchall())
