"""Operators against brute force on small random data, including one very large key."""

import random
from collections import defaultdict
from datetime import date, timedelta

import pytest

from popledger.operators import intervals as I, joins as J, ordering as O, reshape as R

BASE = date(2000, 1, 1)


def random_spans(seed, n=300, hot=100):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if i < hot else f"k{rng.randint(0, 20)}"
        s = BASE + timedelta(days=rng.randint(0, 700))
        out.append((key, s, s + timedelta(days=rng.randint(0, 40))))
    return out


def days(spans):
    got = defaultdict(set)
    for k, s, e in spans:
        for i in range((e - s).days + 1):
            got[k].add(s + timedelta(days=i))
    return got


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merged_spans_keep_the_days_and_do_not_overlap(spark, seed):
    spans = random_spans(seed)
    df = spark.createDataFrame(spans, "k string, s date, e date")
    merged = [tuple(r) for r in I.merge_spans(df, ["k"], "s", "e").collect()]
    assert days(merged) == days(spans)
    by_key = defaultdict(list)
    for k, s, e in merged:
        by_key[k].append((s, e))
    for rows in by_key.values():
        rows.sort()
        assert all(a[1] < b[0] for a, b in zip(rows, rows[1:]))


def test_merge_edges(spark):
    d = lambda n: BASE + timedelta(days=n)
    rows = [("touch", d(0), d(5)), ("touch", d(5), d(9)), ("nest", d(0), d(9)), ("nest", d(2), d(3)), ("equal", d(0), d(1)), ("equal", d(0), d(1)),
            ("gap", d(0), d(1)), ("gap", d(2), d(3)), ("bad", d(5), d(1))]
    df = spark.createDataFrame(rows, "k string, s date, e date")
    strict = sorted(tuple(r) for r in I.merge_spans(df, ["k"], "s", "e").collect())
    assert strict == [("equal", d(0), d(1)), ("gap", d(0), d(1)), ("gap", d(2), d(3)), ("nest", d(0), d(9)), ("touch", d(0), d(9))]
    joined = sorted(tuple(r) for r in I.merge_spans(df, ["k"], "s", "e", touching_days=1).collect())
    assert ("gap", d(0), d(3)) in joined and len(joined) == 4


def test_point_in_span_matches_all_pairs(spark):
    rng = random.Random(5)
    spans = random_spans(7) + [("hot", BASE, date(9999, 12, 31))]
    points = [("hot" if rng.random() < 0.4 else f"k{rng.randint(0, 20)}", BASE + timedelta(days=rng.randint(0, 700))) for _ in range(200)]
    want = sorted((k, p, s) for k, p in points for k2, s, e in spans if k == k2 and s <= p <= e)
    pdf = spark.createDataFrame(points, "k string, p date")
    sdf = spark.createDataFrame(spans, "k string, s date, e date")
    got = I.point_in_span(pdf, "p", sdf, "s", "e", ["k"], horizon=(BASE, BASE + timedelta(days=700)))
    assert sorted((r.k, r.p, r.s) for r in got.collect()) == want
    semi = I.point_in_span(pdf, "p", sdf, "s", "e", ["k"], horizon=(BASE, BASE + timedelta(days=700)), how="left_semi")
    hits = {(k, p) for k, p, _ in want}
    assert sorted((r.k, r.p) for r in semi.collect()) == sorted((k, p) for k, p in points if (k, p) in hits)


@pytest.mark.parametrize("low,high", [(0, 30), (-3, 3), (5, 5)])
def test_band_join_matches_all_pairs(spark, low, high):
    rng = random.Random(low + high)
    make = lambda n: [(rng.choice("abc"), BASE + timedelta(days=rng.randint(0, 300)), i) for i in range(n)]
    left, right = make(80), make(120)
    want = sorted((i, j) for k, x, i in left for k2, y, j in right if k == k2 and low <= (x - y).days <= high)
    a = spark.createDataFrame(left, "k string, x date, i int")
    b = spark.createDataFrame(right, "k string, y date, j int")
    assert sorted((r.i, r.j) for r in I.band_join(a, b, ["k"], "x", "y", low, high).collect()) == want


def test_nearest_day_prefers_the_later_of_two(spark):
    days_ = [BASE + timedelta(days=n) for n in (0, 10, 30)]
    targets = [("tie", BASE + timedelta(days=5)), ("on", BASE + timedelta(days=10)), ("after", BASE + timedelta(days=99)), ("before", BASE - timedelta(days=9))]
    got = I.nearest_day(spark.createDataFrame(targets, "n string, t date"), "t", spark.createDataFrame([(d,) for d in days_], "d date"), "d")
    assert {r.n: r.d for r in got.collect()} == {"tie": days_[1], "on": days_[1], "after": days_[2], "before": days_[0]}


def test_carry_forward_from_later_months(spark):
    rows = [("a", 3, None, "seed3"), ("a", 2, "X", "seed2"), ("a", 1, None, "seed1"), ("b", 1, None, "only")]
    df = spark.createDataFrame(rows, "k string, m int, v string, s string")
    from pyspark.sql import functions as F

    got = {(r.k, r.m): r.out for r in I.carry_forward(df, ["k"], [F.col("m").desc()], "v", "s", "out").collect()}
    assert got == {("a", 3): "seed3", ("a", 2): "X", ("a", 1): "X", ("b", 1): "only"}


def test_numbers_in_a_large_group_are_complete(spark):
    df = spark.range(5000).selectExpr("if(id < 4000, 'hot', 'cold') as g", "cast(id as string) as item")
    got = defaultdict(list)
    for r in O.number_in_group(df, "g", "item", "n", digits=2).collect():
        got[r.g].append(r.n)
    assert sorted(got["hot"]) == list(range(1, 4001)) and sorted(got["cold"]) == list(range(1, 1001))


def test_first_and_last_per_group(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "k string, o int, v string")
    assert sorted(tuple(r) for r in O.first_per_group(df, ["k"], ["o"]).collect()) == [("a", 1, "y"), ("b", 5, "z")]
    assert sorted(tuple(r) for r in O.last_per_group(df, ["k"], ["o"]).collect()) == [("a", 2, "x"), ("b", 5, "z")]


def test_id_closure_and_crosswalk(spark):
    xref = spark.createDataFrame([("old1", "new1"), ("old1", "new1"), ("old2", "new2")], "p string, c string")
    ids = spark.createDataFrame([("old1",), ("new2",), ("plain",)], "member_id string")
    assert sorted(r[0] for r in J.id_closure(ids, "member_id", xref, "p", "c").collect()) == ["new1", "new2", "old1", "old2", "plain"]
    assert sorted(r[0] for r in J.crosswalk(ids, "member_id", xref, "p", "c").collect()) == ["new1", "new2", "plain"]


def test_lookup_refuses_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    assert J.strict_lookup(df, spark.createDataFrame([(1, "a")], "k int, v string"), ["k"]).count() == 2
    with pytest.raises(Exception, match="duplicate lookup key"):
        J.strict_lookup(df, spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string"), ["k"]).collect()


def test_unpivot_keeps_labels(spark):
    df = spark.createDataFrame([("p", 1, 2.5)], "t string, n long, x double")
    got = sorted(tuple(r) for r in R.metrics_long(df, ["t"], {"n": "Number", "x": "Value"}).collect())
    assert got == [("p", "n", "Number", 1.0), ("p", "x", "Value", 2.5)]


@pytest.mark.parametrize("basis", ["discharge", "incurred"])
@pytest.mark.parametrize("stated", [False, True])
def test_claims_at_the_edges_of_windows(spark, basis, stated):
    """The cut by the windows' days loses no line that a window holds."""
    from pyspark.sql import functions as F

    from popledger.operators import claims as C

    rng = random.Random(8)
    d = lambda n: BASE + timedelta(days=n)
    rows = []
    for i in range(600):
        first = rng.choice([*range(-12, 15), *range(85, 130), *range(170, 200)])
        stay = rng.randint(0, 9)
        rows.append((f"m{i % 7}", rng.choice(["I11a", "i31", "P32c", "O10"]), d(first), d(first + stay), d(first + rng.randint(0, 120)), 1))
    claims = spark.createDataFrame(rows, "member_id string, prm_line string, prm_fromdate date, prm_todate date, paiddate date, prm_util bigint")
    if stated:
        meta = {C.DAYS_AFTER: {"prm_fromdate": [0, 9]}}
        paid = {C.DAYS_AFTER: {"prm_fromdate": [0, 120]}}
        claims = claims.withColumns({"prm_todate": F.col("prm_todate").alias("prm_todate", metadata=meta), "paiddate": F.col("paiddate").alias("paiddate", metadata=paid)})
        claims = claims.select("member_id", "prm_line", "prm_fromdate", F.col("prm_todate").alias("prm_todate", metadata=meta), F.col("paiddate").alias("paiddate", metadata=paid), "prm_util")
    spans = [("a", d(0), d(90), d(130)), ("b", d(60), d(180), d(200))]
    windows = spark.createDataFrame(spans, "time_period string, inc_start date, inc_end date, paid_thru date")
    want = defaultdict(lambda: [0, 0])
    for m, line, first, last, paid_on, util in rows:
        day = last if basis == "discharge" and line[0] in "Ii" else first
        for w, s, e, thru in spans:
            if s <= day <= e and paid_on <= thru:
                want[w, m][0] += util
                want[w, m][1] += 1
    got = C.agg_claims(claims, windows, ["member_id"], basis=basis, measures={"prm_util": "prm_util"}).collect()
    assert {(r.time_period, r.member_id): [r.prm_util, r.claim_lines] for r in got} == want
    assert C.agg_claims(claims, windows.limit(0), ["member_id"], basis=basis, measures={}).isEmpty()


def test_day_bounds_reach_the_scan(model, capsys):
    from popledger.operators.claims import agg_claims

    agg_claims(model.outclaims, model.windows, ["prm_line"]).explain("formatted")
    text = capsys.readouterr().out
    assert "GreaterThanOrEqual(l_shipdate,1998-12-25" in text and "LessThan(l_shipdate,2001-07-01" in text


def test_a_span_has_few_blocks_and_they_make_it_up(spark):
    from pyspark.sql import functions as F

    rng = random.Random(3)
    far = date(9999, 12, 31)
    spans = [(BASE, far), (date(1900, 1, 1), far), (date(1, 1, 1), far), (BASE, BASE), (date(1999, 12, 31), date(2000, 1, 1))]
    for _ in range(60):
        s = date(rng.randint(1, 9998), rng.randint(1, 12), rng.randint(1, 28))
        spans.append((s, min(far, s + timedelta(days=rng.choice([3, 400, 30_000, 900_000])) if s.year < 7000 else far)))
    month = lambda d: d.year * 12 + d.month - 1
    rows = spark.createDataFrame(spans, "s date, e date")
    got = rows.select("s", "e", I.blocks_of(I.month_number(F.col("s")).cast("bigint"), I.month_number(F.col("e")).cast("bigint")).alias("b")).collect()
    for r in got:
        held = [m for x in r.b for m in range(x.block * 4**x.level, (x.block + 1) * 4**x.level)] if len(r.b) < 60 else []
        assert sorted(held) == list(range(month(r.s), month(r.e) + 1))
        assert len(r.b) < (40 if r.e == far else 60)


def test_point_in_span_keeps_or_drops_whole_rows(spark):
    d = lambda n: BASE + timedelta(days=n)
    points = spark.createDataFrame([("a", d(3), 1), ("a", d(3), 2), ("a", d(50), 3), ("b", d(3), 4), ("a", None, 5)], "k string, at date, n int")
    spans = spark.createDataFrame([("a", d(0), d(5)), ("a", d(2), date(9999, 12, 31)), ("b", d(9), d(1))], "k string, s date, e date")
    semi = I.point_in_span(points, "at", spans, "s", "e", ["k"], how="left_semi")
    anti = I.point_in_span(points, "at", spans, "s", "e", ["k"], how="left_anti")
    assert sorted(r.n for r in semi.collect()) == [1, 2, 3] and semi.columns == points.columns
    assert sorted(r.n for r in anti.collect()) == [4, 5]
    assert sorted(r.n for r in I.point_in_span(points, "at", spans, "s", "e", ["k"]).collect()) == [1, 1, 2, 2, 3]
