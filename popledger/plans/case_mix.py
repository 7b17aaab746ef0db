"""Case-mix adjusted discharge shares per provider.

Counts, raw shares, normalisation and the distortion check are plain aggregates. The fit is, for every window and discharge status, a
binomial model with an intercept and normal effects of the reporting level and of the case type. It is solved in rounds: the
intercept, the level effects, the case-type effects and the two variances follow in turn, each from sums over the cells. A round is
the same few group-bys for all windows and statuses at once; effects stay in tables, never on the driver, and every round is written
before the next begins.

The cells of a window, status and reporting level, one per case type, stand in one row, so a level's effect is computed in its row.
What holds for a whole window and status (intercept, variances, the effects of the case types) is a small table: windows times
statuses times case types, whatever the number of levels and claims. It is broadcast, so that no round moves the cells: they are
shuffled once, when the rows are made.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from popledger.functions.nulls import safe_ratio

LEVEL = "prv_id_inpatient"
BLOCK = ["time_period", "discharge_status_desc"]
#: Bounds of the variances: case types must not take up all of it, the reporting level takes a little at least.
MAX_TYPE_VARIANCE = 4.2
MIN_LEVEL_VARIANCE = 0.1


def case_counts(details: DataFrame, level: str = LEVEL) -> DataFrame:
    """Discharges by window, reporting level, status and case type; positive counts only."""
    drg = F.concat_ws("_", "drg_inpatient", "drg_version_inpatient")
    return (
        details.groupBy("time_period", level, "discharge_status_desc", drg.alias("drg"))
        .agg(F.sum("cnt_discharges_inpatient").alias("discharges_sum"))
        .where("discharges_sum > 0")
    )


def raw_shares(counts: DataFrame, level: str = LEVEL) -> DataFrame:
    """Share of each status in the discharges of a window and reporting level."""
    by_status = counts.groupBy("time_period", level, "discharge_status_desc").agg(F.sum("discharges_sum").alias("report_dischstatus_raw_cnt"))
    totals = by_status.groupBy("time_period", level).agg(F.sum("report_dischstatus_raw_cnt").alias("report_level_raw_cnt"))
    return by_status.join(totals, ["time_period", level]).withColumn(
        "mu_raw", safe_ratio("report_dischstatus_raw_cnt", "report_level_raw_cnt")
    )


def one_vs_rest(counts: DataFrame, level: str = LEVEL) -> DataFrame:
    """For every status: successes and trials by window, reporting level and case type."""
    cells = counts.groupBy("time_period", level, "drg").agg(F.sum("discharges_sum").alias("trials"))
    statuses = counts.select("time_period", "discharge_status_desc").distinct()
    hits = counts.groupBy("time_period", level, "drg", "discharge_status_desc").agg(F.sum("discharges_sum").alias("successes"))
    return (
        cells.join(statuses, "time_period")
        .join(hits, ["time_period", level, "drg", "discharge_status_desc"], "left")
        .fillna({"successes": 0})
    )


def newton(gradient: Column, curvature: Column) -> Column:
    """One Newton step, of length 1 at most."""
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), gradient / curvature))


def cell_rows(counts: DataFrame, level: str = LEVEL) -> DataFrame:
    """One row per window, status and reporting level: its cells and its effect ``u``, zero at first."""
    cells = F.collect_list(F.struct("drg", F.col("trials").cast("double").alias("trials"), F.col("successes").cast("double").alias("successes")))
    return one_vs_rest(counts, level).groupBy(*BLOCK, level).agg(cells.alias("cells")).withColumn("u", F.lit(0.0))


def first_state(rows: DataFrame) -> DataFrame:
    """Per window and status: intercept ``b``, variances, the largest step of the last round, case-type effects ``v`` (none yet)."""
    start = {"b": 0.0, "var_level": 1.0, "var_drg": 1.0, "largest": 0.0}
    return rows.select(*BLOCK).distinct().withColumns({**{k: F.lit(x) for k, x in start.items()}, "v": F.create_map().cast("map<string,double>")})


def _gap_and_weight(cell: Column, b: Column, u: Column, v: Column) -> tuple[Column, Column]:
    """Successes of a cell beyond the expected ones, and their variance."""
    chance = 1 / (1 + F.exp(-(b + u + F.coalesce(F.try_element_at(v, cell["drg"]), F.lit(0.0)))))
    return cell["successes"] - cell["trials"] * chance, cell["trials"] * chance * (1 - chance)


def _in_rows(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Rows beside their state, with the sums over their cells."""
    placed = rows.join(F.broadcast(state), BLOCK)
    term = lambda c: F.struct(*[x.alias(n) for n, x in zip(("gap", "weight"), _gap_and_weight(c, F.col("b"), F.col("u"), F.col("v")))])
    total = F.aggregate(
        F.transform("cells", term), F.struct(F.lit(0.0).alias("gap"), F.lit(0.0).alias("weight")),
        lambda t, c: F.struct((t["gap"] + c["gap"]).alias("gap"), (t["weight"] + c["weight"]).alias("weight")),
    )
    return placed.withColumn("_t", total).withColumns({"_gap": F.col("_t.gap"), "_weight": F.col("_t.weight")}).drop("_t")


def _spread(own: DataFrame) -> DataFrame:
    """Per block the mean of the new effects, their mean square about it with their uncertainty, and the largest step."""
    return own.groupBy(*BLOCK).agg(
        F.avg("new").alias("mid"), F.avg(F.col("new") * F.col("new") + 1 / F.col("information")).alias("square"), F.max(F.abs("step")).alias("step")
    ).withColumn("spread", F.col("square") - F.col("mid") * F.col("mid"))


def fit_round(rows: DataFrame, state: DataFrame, keep: Callable[[DataFrame, str], DataFrame], name: str) -> tuple[DataFrame, DataFrame]:
    """Rows and state after one round."""
    # intercepts
    steps = _in_rows(rows, state).groupBy(*BLOCK).agg(newton(F.sum("_gap"), F.sum("_weight")).alias("step"))
    moved = {"b": F.col("b") + F.col("step"), "largest": F.abs("step")}
    state = keep(state.join(steps, BLOCK).withColumns(moved).drop("step").coalesce(1), f"{name}_intercepts")

    def effects(df: DataFrame, old: str, gap: Column, weight: Column, variance: Column) -> DataFrame:
        held = 1 / variance
        own = df.withColumns({"step": newton(gap - F.col(old) * held, weight + held), "information": weight + held})
        return own.withColumn("new", F.col(old) + F.col("step"))

    def settled(state: DataFrame, spread: DataFrame, variance: str, bound: Column) -> DataFrame:
        # what the effects have in common is the intercept's, which no variance holds back
        new = {variance: bound, "largest": F.greatest("largest", "step"), "b": F.col("b") + F.col("mid")}
        return state.join(spread, BLOCK).withColumns(new).drop("spread", "square", "step")

    # levels: each in its row
    own = effects(_in_rows(rows, state), "u", F.col("_gap"), F.col("_weight"), F.col("var_level"))
    state = keep(settled(state, _spread(own), "var_level", F.greatest("spread", F.lit(MIN_LEVEL_VARIANCE))).coalesce(1), f"{name}_levels")
    rows = own.select(*BLOCK, *[c for c in rows.columns if c not in (*BLOCK, "u")], F.col("new").alias("u")).join(F.broadcast(state.select(*BLOCK, "mid")), BLOCK)
    rows = keep(rows.withColumn("u", F.col("u") - F.col("mid")).drop("mid"), name)
    state = state.drop("mid")

    # case types: sums over the rows' cells, combined in each task
    each = rows.select(*BLOCK, "u", F.explode("cells").alias("cell")).join(F.broadcast(state), BLOCK)
    gap, weight = _gap_and_weight(F.col("cell"), F.col("b"), F.col("u"), F.col("v"))
    sums = each.groupBy(*BLOCK, F.col("cell.drg").alias("drg")).agg(F.sum(gap).alias("_gap"), F.sum(weight).alias("_weight")).join(F.broadcast(state), BLOCK)
    sums = sums.withColumn("old", F.coalesce(F.try_element_at("v", "drg"), F.lit(0.0)))
    own = keep(effects(sums, "old", F.col("_gap"), F.col("_weight"), F.col("var_drg")).select(*BLOCK, "drg", "new", "step", "information"), f"{name}_types")
    after = settled(state.drop("v"), _spread(own), "var_drg", F.least("spread", F.lit(MAX_TYPE_VARIANCE)))
    types = own.join(after.select(*BLOCK, "mid"), BLOCK).groupBy(*BLOCK).agg(F.map_from_entries(F.collect_list(F.struct("drg", F.col("new") - F.col("mid")))).alias("v"))
    return rows, keep(after.drop("mid").join(types, BLOCK).coalesce(1), f"{name}_state")


def fit_cells(counts: DataFrame, keep: Callable[[DataFrame, str], DataFrame], level: str = LEVEL, rounds: int = 12) -> DataFrame:
    """Rows of cells with the effects after ``rounds`` rounds. ``keep`` writes a table and reads it back."""
    rows = keep(cell_rows(counts, level), "case_mix_cells")
    state = keep(first_state(rows).coalesce(1), "case_mix_start")
    for i in range(rounds):
        rows, state = fit_round(rows, state, keep, f"case_mix_round_{i}")
    return rows.join(F.broadcast(state), BLOCK)


def fit_shares(cells: DataFrame, level: str = LEVEL, tolerance: float = 0.05) -> DataFrame:
    """Adjusted probability of each status per window and reporting level, before normalisation: intercept and level effect, without
    case types. ``largest_step`` is the block's largest step in the last round, ``converged`` whether it is within ``tolerance``."""
    return cells.select(
        "time_period", level, "discharge_status_desc", (1 / (1 + F.exp(-(F.col("b") + F.col("u"))))).alias("mu"), "var_level", "var_drg",
        F.col("largest").alias("largest_step"), (F.col("largest") <= tolerance).alias("converged"),
    )


def normalised(fitted: DataFrame, raw: DataFrame, level: str = LEVEL) -> DataFrame:
    """Adjusted shares that add up to one per window and reporting level, next to the raw ones."""
    totals = fitted.groupBy("time_period", level).agg(F.sum("mu").alias("report_level_slop_total"))
    sizes = raw.select("time_period", level, "report_level_raw_cnt").distinct()
    shares = raw.select("time_period", level, "discharge_status_desc", "report_dischstatus_raw_cnt", "mu_raw")
    return (
        fitted.join(totals, ["time_period", level])
        .join(sizes, ["time_period", level], "left")
        .join(shares, ["time_period", level, "discharge_status_desc"], "left")
        .fillna({"report_dischstatus_raw_cnt": 0, "mu_raw": 0.0})
        .withColumn("mu_normalized", safe_ratio("mu", "report_level_slop_total"))
    )


def distortion(normal: DataFrame) -> DataFrame:
    """Composite share per window and status under each of the three estimates, and the variances of the fit."""
    w = F.col("report_level_raw_cnt")
    mean = lambda c: safe_ratio(F.sum(F.col(c) * w), F.sum(w))
    return normal.groupBy("time_period", "discharge_status_desc").agg(
        mean("mu_raw").alias("mu_comp_raw"), mean("mu").alias("mu_comp_slop"), mean("mu_normalized").alias("mu_comp_normalized"),
        F.first("var_drg").alias("cov_drg_estimate"), F.first("var_level").alias("cov_rpt_estimate"),
    )
