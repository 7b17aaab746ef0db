"""Small frames for the rules that differ from plain SQL."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from popledger.functions import dates as D, numbers as N, text as X
from popledger.functions.nulls import blank_to_null, coalesce_text, le_missing, null_safe_join, safe_ratio, sum_present
from popledger.operators import aggregate as A
from popledger.operators.claims import bucket_label
from popledger.plans.cost_model import COST_BUCKET_BEYOND, COST_BUCKETS
from popledger.plans.fixes import sign_fix, version_fix
from popledger.plans.roster import members_all
from popledger.settings import ReportSettings


def values(df, *cols):
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=str)


def test_missing_number_is_below_every_number(spark):
    df = spark.createDataFrame([(None,), (11.0,), (12.0,)], "x double").select("x", le_missing("x", 11).alias("low"))
    assert values(df, "x", "low") == [(11.0, True), (12.0, False), (None, True)]


def test_cost_buckets_at_their_bounds(spark):
    rows = [(None,), (-1.0,), (500.0,), (500.01,), (200000.0,), (200000.01,)]
    df = spark.createDataFrame(rows, "c double").select("c", bucket_label("c", COST_BUCKETS, COST_BUCKET_BEYOND).alias("b"))
    got = {r.c: r.b for r in df.collect()}
    assert got == {None: "0-500", -1.0: "0-500", 500.0: "0-500", 500.01: "501-1000", 200000.0: "100001-200000", 200000.01: "200000+"}


def test_ratio_without_answer_is_missing(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (1.0, 4.0)], "a double, b double").select(safe_ratio("a", "b").alias("q"))
    assert sorted([r.q for r in df.collect()], key=str) == [0.25, None, None]


def test_weighted_means_differ_on_missing_scores(spark):
    df = spark.createDataFrame([(2.0, 3.0), (None, 1.0)], "x double, w double")
    row = df.agg(A.weighted_mean_present("x", "w").alias("present"), A.weighted_mean_all("x", "w").alias("all")).first()
    assert (row.present, row.all) == (2.0, 1.5)


def test_blank_text_is_missing(spark):
    df = spark.createDataFrame([("  ",), (" a ",), (None,)], "t string")
    got = [tuple(r) for r in df.select(blank_to_null("t"), coalesce_text("t", "XX")).collect()]
    assert got == [(None, "XX"), ("a", "a"), (None, "XX")]


def test_missing_keys_match_each_other(spark):
    a = spark.createDataFrame([(1, None), (2, "x")], "id int, k string")
    b = spark.createDataFrame([(None, 9.0)], "k string, v double")
    assert values(null_safe_join(a, b, ["k"]), "id", "v") == [(1, 9.0), (2, None)]


def test_ages(spark):
    rows = [(date(2002, 1, 1), 0), (date(1960, 6, 30), 41), (date(1960, 7, 1), 40), (date(1940, 2, 29), 61), (None, None)]
    df = spark.createDataFrame(rows, "dob date, want int").withColumn("day", F.lit(date(2001, 6, 30)))
    for r in df.select("want", D.age_at("dob", "day").alias("age")).collect():
        assert r.age == r.want


def test_rounding_sums_and_names(spark):
    row = spark.range(1).select(
        N.round_to(F.lit(2.5), 1).alias("up"), N.round_to(F.lit(-2.5), 1).alias("down"), sum_present(F.lit(None).cast("double"), F.lit(2.0)).alias("one"),
        sum_present(F.lit(None).cast("double")).alias("none"), X.tidy_name(F.lit("  MERCY   HOSPITAL, ")).alias("name"),
        X.date_stamp(F.lit("/in/P.A1234.ACO.CCLF8.D160101.T1.D160215.txt")).alias("stamp"),
        X.is_identifier(F.lit("2bad")).alias("bad"), X.word_at(F.lit("a b"), 5).alias("gone"),
    ).first()
    assert (row.up, row.down, row.one, row.none) == (3.0, -3.0, 2.0, None)
    assert (row.name, row.stamp, row.bad, row.gone) == ("Mercy Hospital", "160215", False, None)


def test_new_enrollee_score_up_to_eleven_months_or_without_scores(spark):
    s = ReportSettings()
    people = spark.createDataFrame(
        [(m, "P", date(2001, 6, 30), 12.0, "A", "x", "y", s.hcc_label, date(1950, 1, 1), "F", m) for m in ("a", "b", "c")],
        "member_id string, time_period string, inc_end date, memmos double, elig_status_1 string, mem_prv_id_align string, prv_name_align string, "
        "riskscr_1_type string, dob date, gender string, mem_name string",
    )
    hcc = spark.createDataFrame(
        [("a", "P", 1.0, 0.5, 11.0), ("b", "P", 1.0, 0.5, 12.0)],
        "hicno string, time_slice string, score_community double, score_new_enrollee double, riskscr_mm double",
    )
    windows = spark.createDataFrame([("P", "Concurrent")], "time_period string, riskscr_period_type string")
    comp = spark.createDataFrame([], "member_id string, time_slice string, model_name string, riskscr_tot double")
    got = values(members_all(people, windows, hcc, comp, s), "member_id", "riskscr_1")
    assert got == [("a", 0.5), ("b", 1.0), ("c", None)]


def test_sign_correction(spark):
    day = date(2016, 3, 1)
    rows = [
        ("small", "I11a", day, 5, 1.99, -1), ("big", "I11a", day, 5, 2.00, -1), ("minus", "I31", day, 4, -5.0, -1),
        ("zero", "I12", day, 3, 50.0, 0), ("fine", "I12", day, 3, 50.0, 1), ("other", "O11", day, 3, 1.0, -1),
        ("early", "I31", date(2016, 1, 15), 4, -5.0, -1),
    ]
    claims = spark.createDataFrame(rows, "caseadmitid string, prm_line string, prm_fromdate date, prm_util int, prm_costs double, prm_admits int")
    got = {r.caseadmitid: (r.prm_util, r.prm_costs, r.prm_admits) for r in sign_fix(claims).collect()}
    assert got == {
        "small": (0, 0.0, 0), "big": (-5, 2.0, -1), "minus": (-4, -5.0, -1), "zero": (0, 50.0, 0), "fine": (3, 50.0, 1),
        "other": (3, 1.0, -1), "early": (4, -5.0, -1),
    }


def test_version_switch(spark):
    df = spark.createDataFrame([(date(2015, 9, 30), "09"), (date(2015, 10, 1), "09"), (date(2016, 1, 1), "10")], "prm_fromdate date, icdversion string")
    assert sorted(r.icdversion for r in version_fix(df).collect()) == ["09", "10", "10"]


def test_group_sums_remerged_on_distinct_rows(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("a", "y", 3), ("b", "x", 4)], "k string, c string, v int")
    assert values(A.remerge_distinct(df, ["k"], ["c"], {"s": "v"}), "k", "c", "s") == [("a", "x", 6), ("a", "y", 6), ("b", "x", 4)]


@pytest.mark.parametrize("bad", ["x"])
def test_unknown_basis_is_refused(bad):
    from popledger.operators.claims import incurred_day

    with pytest.raises(ValueError):
        incurred_day(bad)


def test_a_round_of_the_case_mix_moves_no_cells(spark):
    from popledger.plans import case_mix

    rows = [("w", f"P{p}", s, f"D{d}", p + d + 1) for p in range(4) for d in range(3) for s in ("Died", "Home")]
    counts = spark.createDataFrame(rows, "time_period string, prv_id_inpatient string, discharge_status_desc string, drg string, discharges_sum bigint")
    frames = {}
    cells = case_mix.cell_rows(counts).localCheckpoint()
    done, state = case_mix.fit_round(cells, case_mix.first_state(cells).localCheckpoint(), lambda df, name: frames.setdefault(name, df), "r")
    assert done.count() == 8 and state.count() == 2 and state.select(F.size("v")).distinct().collect() == [(3,)]
    for name in ("r", "r_intercepts", "r_levels"):
        plan = frames[name]._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(prv_id_inpatient" not in plan and not any("prv_id_inpatient" in x for x in plan.split("\n") if "Exchange hash" in x), plan


def test_a_mart_table_is_written_when_it_is_asked_for(model, tmp_path):
    from popledger.plans.report import Report

    folder = f"file://{tmp_path}/mart"
    stored = Report(model, folder=f"file://{tmp_path}/stages").store(folder)
    assert stored.table("meta_project").count() == 5 and stored.table("time_windows").count() > 0
    assert sorted(p.name for p in (tmp_path / "mart").iterdir()) == ["meta_project", "time_windows"] and not (tmp_path / "stages").exists()
    before = {p.name for p in (tmp_path / "mart" / "time_windows").iterdir()}
    assert stored.table("time_windows").count() and {p.name for p in (tmp_path / "mart" / "time_windows").iterdir()} == before


def test_months_are_dealt_by_member_and_month_before_they_are_summed(model):
    from popledger.plans import supplemental

    plan = supplemental.memmos_elig(model.member_time, model.member)._jdf.queryExecution().executedPlan().toString()
    dealt, summed = plan.index("Exchange hashpartitioning(member_id"), plan.index("HashAggregate(keys=[member_id")
    line = next(x for x in plan.split("\n") if "Exchange hashpartitioning(member_id" in x and "elig_month" in x)
    assert "REPARTITION" in line and plan.index(line) < plan.index("Generate explode") and summed < plan.index(line), (dealt, plan)


def test_months_meet_their_status_within_the_member(spark):
    """Months that are dealt by member are not dealt by month to meet the reported statuses; a missing status and a member without any stay."""
    from popledger.plans.cost_model import member_elig, monthly_status

    day = lambda m: date(2001, m, 15)
    months = spark.createDataFrame(
        [("a", day(m), 1.0, "own", "Y") for m in (1, 2, 3, 4)] + [("b", day(1), 1.0, "mine", "Y"), ("c", day(1), 1.0, "out", "Y")],
        "member_id string, elig_month date, memmos double, elig_status_1 string, cover_medical string",
    )
    reported = spark.createDataFrame(
        [("a", date(2001, 2, 1), "x"), ("a", date(2001, 3, 1), None), ("a", date(2001, 9, 1), "y"), ("z", date(2001, 1, 1), "x")],
        "hicno string, date_elig_start date, elig_status string",
    )
    windows = spark.createDataFrame([("w1", date(2001, 1, 1), date(2001, 2, 28)), ("w2", date(2001, 2, 1), date(2001, 4, 30))], "time_period string, inc_start date, inc_end date")
    members = spark.createDataFrame([("a", "w1"), ("a", "w2"), ("b", "w1")], "member_id string, time_period string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        monthly = monthly_status(months, reported)
        assert values(monthly, "member_id", "elig_month", "elig_status") == sorted(
            [("a", day(4), "own"), ("a", day(3), "own"), ("a", day(2), "x"), ("a", day(1), "x"), ("b", day(1), "mine"), ("c", day(1), "out")], key=str)
        placed = member_elig(monthly, windows, members, "C")
        assert values(placed, "member_id", "time_period", "elig_status_1", "elig_months") == [
            ("a", "w1", "x", 2.0), ("a", "w2", "own", 2.0), ("a", "w2", "x", 1.0), ("b", "w1", "mine", 1.0)]
        plan = monthly_status(months.repartition("member_id"), reported)._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in plan.split("\n") if "Exchange hashpartitioning" in x and "elig_month" in x], plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_months_before_all_windows_are_cut(spark, small, tmp_path):
    """Statuses are carried to earlier months only, so months before the first window are left out and the others come out as before."""
    from popledger.plans.cost_model import monthly_status
    from popledger.plans.report import Report
    from popledger.sources.star import StarModel

    day = lambda m: date(2001, m, 15)
    months = spark.createDataFrame(
        [("a", day(m), 1.0, "own", "Y") for m in (1, 2, 3, 4, 5)] + [("b", day(1), 1.0, "mine", "Y")],
        "member_id string, elig_month date, memmos double, elig_status_1 string, cover_medical string",
    )
    reported = spark.createDataFrame([("a", date(2001, 1, 1), "v"), ("a", date(2001, 4, 1), "x")], "hicno string, date_elig_start date, elig_status string")
    whole = monthly_status(months, reported)
    assert values(monthly_status(months, reported, date(2001, 3, 1)), "member_id", "elig_month", "elig_status") == values(
        whole.where("elig_month >= '2001-03-01'"), "member_id", "elig_month", "elig_status")
    plain, staged = Report(StarModel(spark, small)), Report(StarModel(spark, small), folder=str(tmp_path / "stages"), only=["eligibility", "members"])
    got, want = staged.member_elig, plain.member_elig
    assert values(got, *want.columns) == values(want, *want.columns)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "elig_month" in plan and "date_end#" in plan and "1999-01-01" in plan.split("elig_months")[-1]
    spans = [x for x in plan.split("\n") if "Filter" in x and "(date_end#" in x and ">= 1999-01-01" in x]
    assert spans, plan


def test_claims_of_the_dead_are_cut_before_lines_meet_orders(spark, small):
    """Claims of a few members are the same rows, and their orders are picked below the join of lines and orders."""
    from popledger.plans.report import Report
    from popledger.sources.star import StarModel

    model = StarModel(spark, small)
    who = model.member.where("member_id like '%7'").select("member_id")
    for name in ("outclaims", "outpharmacy"):
        want = getattr(model, name).join(who, "member_id", "left_semi")
        got = getattr(model.of_members(who), name).select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) != []
    plan = Report(model).decedents._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    at = next(i for i, x in enumerate(plan) if "Join Inner" in x and "l_orderkey" in x)
    assert [x for x in plan[at + 1 :] if "LeftSemi" in x and "cast(o_custkey" in x and depth(x) > depth(plan[at])], plan


def test_a_staged_report_merges_spans_once(spark, small, tmp_path):
    """Member months and assignment spans derive from the stored eligibility: neither reads the orders again."""
    from popledger.plans.report import Report
    from popledger.sources.star import StarModel

    plain, staged = Report(StarModel(spark, small)), Report(StarModel(spark, small), folder=str(tmp_path / "stages"), only=["eligibility"])
    for name in ("member_time", "client_member_time"):
        got, want = getattr(staged, name), getattr(plain, name)
        assert not [f for f in got.inputFiles() if "orders.parquet" in f], name
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect())), name


def test_stored_claims_are_summed_once(spark):
    """A roll-up that is summed again takes the stored rows as they are, by group and by member; the sums are the same."""
    from popledger.plans.cost_model import MEASURE_NAMES, member_spend
    from popledger.plans.groups import GroupLattice
    from popledger.plans.lattice import ClaimLattice

    dims = ["member_id", "elig_status_1", "memmos", "prm_line"]
    kinds = "member_id string, elig_status_1 string, memmos double, prm_line string, time_period string, " + ", ".join(f"{m} bigint" for m in [*MEASURE_NAMES, "claim_lines"])
    rows = spark.createDataFrame(
        [("a", "s", 2.0, "I11", "w", 1, 1, 1, 1, 1, 1), ("a", "s", 2.0, "P32", "w", 2, 2, 2, 2, 2, 2), ("b", None, 3.0, "P32", "w", 4, 4, None, 4, 4, 4)], kinds)
    lattice = ClaimLattice.__new__(ClaimLattice)
    lattice.dims, lattice.keep, lattice._stored = dims, lambda df, name: df, [(frozenset(dims), rows)]
    sums = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [")

    closure = spark.createDataFrame([("a", "g"), ("a", "h"), ("b", "g")], "member_id string, group string")
    by_group = GroupLattice(lattice, closure).at(["elig_status_1"], ["prm_costs", "paid"])
    assert values(by_group, "time_period", "elig_status_1", "prm_costs", "paid", "claim_lines") == sorted(
        [("g\x1fw", "s", 3, 3, 3), ("h\x1fw", "s", 3, 3, 3), ("g\x1fw", None, None, 4, 4)], key=str)
    assert sums(by_group) == 1
    spend = member_spend(lattice, lattice)
    assert values(spend, "member_id", "elig_status_1", "prm_costs", "paid", "claim_lines") == [("a", "s", 6, 6, 6), ("b", "Unknown", 0, 8, 8)]
    assert sums(spend) == 1
