"""Reports split by member group, and the group lists themselves."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from popledger.functions.text import same_ci, word_at
from popledger.operators.claims import agg_memmos
from popledger.operators.joins import id_closure
from popledger.operators.ordering import number_in_group
from popledger.operators.reshape import pivot_ids
from popledger.plans import cost_model, exclusions
from popledger.plans.lattice import ClaimLattice
from popledger.plans.report import Report


def group_members(lists: DataFrame, xref: DataFrame) -> DataFrame:
    """Every group's members with their current and previous ids."""
    named = lists.where("member_id <> ''").select("group", "member_id")
    return id_closure(named, "member_id", xref, "prvs_hic_num", "crnt_hic_num", keep=["group"])


def wide_lists_to_long(wide: DataFrame) -> DataFrame:
    """Ragged lists, one column per group, as group/member rows."""
    return wide.unpivot([], wide.columns, "group", "member_id").where("member_id is not null and member_id <> ''")


def restrict(table: DataFrame, closure: DataFrame, group: str, field: str = "member_id") -> DataFrame:
    """Rows of one group's members."""
    ids = closure.where(F.col("group") == group).select(F.col("member_id").alias(field))
    return table.join(ids, field, "left_semi")


def by_group(table: DataFrame, closure: DataFrame, field: str = "member_id") -> DataFrame:
    """All groups at once: the group becomes a column. A member of several groups counts in each."""
    return table.join(closure.withColumnRenamed("member_id", field), field)


def cost_by_group(spend: DataFrame, closure: DataFrame) -> DataFrame:
    """Cost and utilisation by group, window and status in one pass.

    Claims come summed per member, so the join to the groups moves one row per member,
    window and status.
    """
    return by_group(spend, closure).groupBy("group", "time_period", "elig_status_1").agg(
        F.countDistinct("member_id").alias("members"),
        *[F.sum(c).alias(c) for c in ["prm_costs", "prm_util", "discharges"]],
    )


def market_lists(raw: DataFrame, first_word: bool = False, left_out: Sequence[str] = ("MA",)) -> DataFrame:
    """Tidy market of every member; some markets are left out."""
    market = F.initcap(F.trim("market_name_orig"))
    if first_word:
        market = word_at(market, 1)
    tidy = raw.select("hicno", market.alias("market_name"))
    for m in left_out:
        tidy = tidy.where(~same_ci("market_name", m))
    return tidy


def numbered_lists(tidy: DataFrame) -> DataFrame:
    """Members numbered within their market."""
    return number_in_group(tidy, "market_name", "hicno", "count")


def ragged_lists(numbered: DataFrame, markets: Sequence[str] | None = None) -> DataFrame:
    """One column per market, one row per number; short lists end early. Without ``markets``, those of the data: they become
    columns, so they are few."""
    if markets is None:
        markets = sorted(r.market_name for r in numbered.where("market_name is not null").select("market_name").distinct().collect())
    return pivot_ids(numbered, ["count"], "market_name", "hicno", markets)


# -- a report by group, all groups in one run ------------------------------------------------------------
#
# A group's report is the report over the group's members alone. Every result is a sum over members within a window, so the
# group travels in the window's label: a member stands in the windows of each of its groups, and sums, means and risk scores come out per
# group without a rule of their own. Claims are summed per member and window first and meet the groups afterwards, so a claim is
# not repeated for each group, and groups may overlap.

MARK = "\x1f"


def in_group(df: DataFrame, closure: DataFrame, period: str = "time_period") -> DataFrame:
    """Rows of members once for each of their groups, the group before the window's label."""
    joined = df.join(closure.select("member_id", "group"), "member_id")
    return joined.withColumn(period, F.concat_ws(MARK, "group", period)).drop("group")


def split_group(df: DataFrame) -> DataFrame:
    """The group as a column of its own."""
    label = F.split("time_period", MARK)
    return df.withColumns({"group": label[0], "time_period": label[1]})


class GroupLattice:
    """Roll-ups of a claim lattice by group. Stored rows are sums per member already: they meet the groups and are summed once."""

    def __init__(self, members: ClaimLattice, closure: DataFrame):
        self.members, self.closure, self.dims = members, closure, members.dims

    def at(
        self, dims: Sequence[str], measures: Sequence[str] | None = None, where: Column | None = None, needs: Sequence[str] = (), final: bool = True,
    ) -> DataFrame:
        own = list(dict.fromkeys([*dims, "member_id"]))
        rows = in_group(self.members.at(own, measures, where, needs, final=False), self.closure)
        sums = [c for c in rows.columns if c not in {*own, "time_period"}]
        return rows.groupBy("time_period", *dims).agg(*[F.sum(c).alias(c) for c in sums])


class GroupModel:
    """A model whose windows and window-labelled member scores stand once for each group."""

    def __init__(self, model, closure: DataFrame):
        self._model, self._closure = model, closure

    def __getattr__(self, name: str):
        return getattr(self._model, name)

    @cached_property
    def windows(self) -> DataFrame:
        # a few groups times a page of windows
        groups = self._closure.select("group").distinct()
        return self._model.windows.join(groups).withColumn("time_period", F.concat_ws(MARK, "group", "time_period")).drop("group")

    @cached_property
    def component_scores(self) -> DataFrame:
        return in_group(self._model.component_scores, self._closure, "time_slice")


class GroupReport(Report):
    """The report of every group in one run. ``whole`` is the report over all members; its intermediates are shared by the groups."""

    def __init__(self, whole: Report, closure: DataFrame):
        self.whole = whole
        self.closure = whole._keep(closure.select("group", "member_id").distinct(), "groups")
        super().__init__(GroupModel(whole.m, self.closure), folder=whole.folder)

    @cached_property
    def members(self) -> DataFrame:
        return self._keep(in_group(self.whole.members, self.closure), "members_by_group")

    @cached_property
    def medical(self) -> GroupLattice:
        return GroupLattice(self.whole.medical, self.closure)

    @cached_property
    def pharmacy(self) -> GroupLattice | None:
        return None if self.whole.pharmacy is None else GroupLattice(self.whole.pharmacy, self.closure)

    @cached_property
    def cases(self) -> DataFrame:
        return self.whole.cases

    @cached_property
    def eligibility(self) -> DataFrame:
        return self.whole.eligibility

    @cached_property
    def snf_readmissions(self) -> DataFrame:
        return self.whole.snf_readmissions

    @cached_property
    def decedents(self) -> DataFrame:
        return in_group(self.whole.decedents, self.closure)

    @cached_property
    def assigned(self) -> DataFrame:
        return in_group(self.whole.assigned, self.closure)

    @cached_property
    def feed(self) -> DataFrame:
        return in_group(self.whole.feed, self.closure)

    @cached_property
    def memmos(self) -> DataFrame:
        months = agg_memmos(self.eligibility, self.whole.m.windows, ["member_id"])
        return cost_model.memmos_long(in_group(months, self.closure), self.members, self.s.client)

    @cached_property
    def metrics_optoutcount(self) -> DataFrame:
        """Opt-outs among the group's members."""
        excluded = exclusions.bene_exclusion(self.m.bene_exclusion)
        mine = excluded.join(self.closure.select("group", F.col("member_id").alias("hicno")), "hicno")
        declined = F.sum(F.when(exclusions.declined(), 1).otherwise(0)).cast("double")
        counts = mine.groupBy("group").agg(declined.alias("_n"))
        periods = split_group(self.memcnt.select("time_period").distinct().withColumn("_label", F.col("time_period")))
        rows = periods.join(counts, "group", "left").select(F.col("_label").alias("time_period"), F.coalesce("_n", F.lit(0.0)).alias("metric_value"))
        return exclusions.optout_rows(rows, self.s.client)

    def metrics(self) -> DataFrame:
        return split_group(self.metrics_key_value)

    def costs(self) -> DataFrame:
        return split_group(self.cost_util)

    def months(self) -> DataFrame:
        return split_group(self.memmos)
