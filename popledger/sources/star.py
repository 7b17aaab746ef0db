"""The report's input tables, derived from the star-schema test tables.

Every table is a projection, join or aggregate of the given parquet tables, so its size
follows theirs. A site with real claims replaces this module by one that reads its own
tables with the same columns.
"""

from __future__ import annotations

import copy
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from popledger.functions.dates import month_begin, month_end
from popledger.functions.numbers import money
from popledger.operators.claims import DAYS_AFTER
from popledger.operators.intervals import merge_spans
from popledger.operators.joins import reference
from popledger.operators.windows import windows_for
from popledger.settings import ReportSettings

# Service line of a medical claim line by l_partkey % 18, of a pharmacy line by % 3.
MEDICAL_LINES = [
    "I11a", "I11b", "I12", "I13a", "I31", "I11c",
    "O10", "O11a", "O11b", "O14a", "O14b", "O16",
    "P32c", "P32d", "P33", "P57a", "P59b", "P34",
]
PHARMACY_LINES = ["R10a", "R10b", "R10c"]
# An order has lines 1 to 7.
MAX_LINES = 7
# Discharge status by l_linenumber 1..7.
DISCHARGE_CODES = ["01", "62", "03", "06", "20", "65", "01"]
# Discharge codes with their text, by n_nationkey from 1 on; a code may have none.
DISCHARGE_TEXTS = [
    ("01", "Discharged to Home"),
    ("62", "Discharged to IRF"),
    ("03", "Discharged to SNF"),
    ("06", "Discharged to Home Health Care"),
    ("20", "Died"),
]
NYU_SHARES = [
    "prm_nyu_emergent_non_avoidable", "prm_nyu_emergent_avoidable", "prm_nyu_emergent_primary_care",
    "prm_nyu_injury", "prm_nyu_nonemergent", "prm_nyu_unclassified",
]
PREFERENCE_CATEGORIES = ["Not PSA", "Knee Replacement", "Spinal Fusion", "Hysterectomy"]


def _pick(values: list[str], index: Column) -> Column:
    """values[index], as a literal array lookup."""
    return F.get(F.array(*[F.lit(v) for v in values]), index)


def _text(c: str) -> Column:
    return F.col(c).cast("string")


class StarModel:
    """Claims model over ``region nation customer supplier part orders lineitem``."""

    def __init__(self, spark: SparkSession, path: str, settings: ReportSettings | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.settings = settings or ReportSettings()
        self._members: DataFrame | None = None

    def over_spans(self, spans: DataFrame) -> StarModel:
        """The same model with its merged eligibility already at hand, as a report has stored it: member months and assignment spans
        derive from it and merge nothing again."""
        model = copy.copy(self)
        model.eligibility = spans
        return model

    def of_members(self, members: DataFrame) -> StarModel:
        """The same model with the claims of these members (``member_id``) only: their orders are picked before they meet the lines."""
        model = copy.copy(self)
        for name in ("outclaims", "outpharmacy", "cases"):
            model.__dict__.pop(name, None)
        model._members = members.select(F.col("member_id").alias("_of"))
        return model

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    # -- run -----------------------------------------------------------------------

    @cached_property
    def windows(self) -> DataFrame:
        return windows_for(self.spark, self.settings)

    # -- members -------------------------------------------------------------------

    @cached_property
    def member(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.table("customer").select(
            _text("c_custkey").alias("member_id"),
            F.expr("date_add(date'1940-01-01', cast(c_custkey % 20000 as int))").alias("dob"),
            F.when(k % 2 == 0, "F").otherwise("M").alias("gender"),
            F.col("c_name").alias("mem_name"),
            F.when(k % 20 == 19, "Manual")
            .when(k % 2 == 0, self.settings.hcc_label)
            .otherwise(self.settings.component_label)
            .alias("risk_score_type"),
            F.concat(F.lit("Street "), _text("c_nationkey")).alias("mem_address_line_1"),
            F.lit(None).cast("string").alias("mem_address_line_2"),
            F.concat(F.lit("City "), _text("c_nationkey")).alias("mem_city_state"),
            F.lpad(_text("c_nationkey"), 2, "0").alias("mem_state"),
            F.lpad((k % 100000).cast("string"), 5, "0").alias("mem_zip5"),
            (F.lit(2001) - F.year(F.expr("date_add(date'1940-01-01', cast(c_custkey % 20000 as int))"))).alias("age"),
        )

    @cached_property
    def order_spans(self) -> DataFrame:
        """Raw eligibility: from the order's month to the fifth month after it."""
        day = F.col("o_orderdate").cast("date")
        return self.table("orders").select(
            _text("o_custkey").alias("member_id"),
            month_begin(day).alias("date_start"),
            month_end(day, 5).alias("date_end"),
        )

    @cached_property
    def eligibility(self) -> DataFrame:
        """Merged eligibility spans with the attributes that go with a span."""
        spans = merge_spans(self.order_spans, ["member_id"], "date_start", "date_end")
        who = self.table("customer").select(
            _text("c_custkey").alias("member_id"),
            F.col("c_mktsegment").alias("elig_status_1"),
            F.when(F.col("c_custkey") % 11 == 5, "n").otherwise("y").alias("assignment_indicator"),
            F.lit("Y").alias("cover_medical"),
            F.when(F.col("c_custkey") % 3 == 0, "N").otherwise("Y").alias("cover_rx"),
            F.concat(F.lit("P"), _text("c_nationkey")).alias("mem_prv_id_align"),
            F.concat(F.lit("Practice "), _text("c_nationkey")).alias("prv_name_align"),
        )
        return spans.join(who, "member_id")

    @cached_property
    def member_time(self) -> DataFrame:
        """Eligibility by month; ``elig_month`` is the 15th."""
        months = F.sequence("date_start", F.trunc("date_end", "month"), F.expr("interval 1 month"))
        return (
            self.eligibility.withColumn("_m", F.explode(months))
            .withColumn("elig_month", F.date_add("_m", 14))
            .withColumn("memmos", F.lit(1.0))
            .drop("_m", "date_start", "date_end")
        )

    @cached_property
    def monthly_elig_status(self) -> DataFrame:
        """Status reported per month; known for months with a closed order only."""
        day = F.col("o_orderdate").cast("date")
        return (
            self.table("orders").where("o_orderstatus = 'F'")
            .groupBy(_text("o_custkey").alias("hicno"), month_begin(day).alias("date_elig_start"))
            .agg(F.max("o_orderpriority").alias("elig_status"))
        )

    @cached_property
    def bene_xref(self) -> DataFrame:
        """Previous ids are the keys divisible by ten; the current id is one lower. Entries repeat."""
        k = self.table("customer").where("c_custkey % 10 = 0 and c_custkey > 0")
        once = k.select(_text("c_custkey").alias("prvs_hic_num"), (F.col("c_custkey") - 1).cast("string").alias("crnt_hic_num"))
        return once.withColumn("_r", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_r")

    @cached_property
    def client_member_time(self) -> DataFrame:
        """Assignment spans before any restriction to the feed."""
        kept = self.eligibility.where(~F.col("member_id").endswith("3"))
        return kept.select("member_id", "date_start", "date_end", "assignment_indicator")

    @cached_property
    def member_raw_stack(self) -> DataFrame:
        """Periodic feed: a member is in the snapshot of every month with an order."""
        day = F.col("o_orderdate").cast("date")
        deaths = self.deaths.select(F.col("member_id").alias("bene_hic_num"), "death_date")
        return (
            self.table("orders")
            .select(_text("o_custkey").alias("bene_hic_num"), F.last_day(day).alias("date_latestpaid"))
            .join(deaths, "bene_hic_num", "left")
            .select(
                "bene_hic_num",
                "date_latestpaid",
                F.when(F.col("death_date") <= F.col("date_latestpaid"), F.col("death_date")).alias("bene_death_dt"),
            )
        )

    @cached_property
    def deaths(self) -> DataFrame:
        gone = self.table("customer").where("c_acctbal < 0").select("c_custkey")
        return (
            self.table("orders").join(gone, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
            .groupBy("o_custkey").agg(F.max(F.col("o_orderdate").cast("date")).alias("death_date"))
            .select(_text("o_custkey").alias("member_id"), "death_date", F.col("o_custkey").alias("_k"))
        )

    @cached_property
    def decedents(self) -> DataFrame:
        k, death = F.col("_k"), F.col("death_date")

        def yn(test: Column) -> Column:
            return F.when(test, "Y").otherwise("N")

        hospice = k % 3 != 0
        discharge = F.date_sub(death, (k % 5).cast("int"))
        return self.deaths.select(
            F.col("member_id").alias("member_id_excluded"),
            death.alias("death_date_excluded"),
            F.when(hospice, F.date_sub(discharge, (k % 250).cast("int"))).alias("latest_hospice_date_admit"),
            F.when(hospice, discharge).alias("latest_hospice_date_discharge"),
            yn(k % 4 == 0).alias("endoflife_numer_yn_chemolt14days"),
            yn(k % 2 == 0).alias("endoflife_denom_yn_chemolt14days"),
            yn(hospice & (k % 250 < 3)).alias("endoflife_numer_yn_hospicelt3day"),
            yn(hospice).alias("endoflife_denom_yn_hospicelt3day"),
            yn(~hospice).alias("endoflife_numer_yn_hospicenever"),
            yn(k % 7 != 0).alias("endoflife_denom_yn_hospicenever"),
        )

    # -- claims --------------------------------------------------------------------

    def _lines(self) -> DataFrame:
        """All claim lines with their member."""
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        if self._members is not None:
            orders = orders.join(self._members, _text("o_custkey") == F.col("_of"), "left_semi")
        return self.table("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    def _claim_columns(self, prm_line: Column) -> list[Column]:
        k, day = F.col("o_custkey"), F.col("l_shipdate").cast("date")
        provider = F.when(F.col("l_suppkey") % 17 != 3, _text("l_suppkey"))
        inpatient = prm_line.startswith("I")
        return [
            _text("l_orderkey").alias("claimid"),
            _text("l_linenumber").alias("linenum"),
            _text("o_custkey").alias("member_id"),
            prm_line.alias("prm_line"),
            day.alias("prm_fromdate"),
            F.date_add(day, F.col("l_linenumber")).alias("prm_todate", metadata={DAYS_AFTER: {"prm_fromdate": [1, MAX_LINES]}}),
            F.date_add(day, F.col("l_linenumber") * 15).alias("paiddate", metadata={DAYS_AFTER: {"prm_fromdate": [15, 15 * MAX_LINES]}}),
            case_id(k, day).alias("caseadmitid"),
            F.when(prm_line.startswith("P"), case_id(k, day)).alias("facilitycaseid"),
            _pick(DISCHARGE_CODES, F.col("l_linenumber") - 1).alias("dischargestatus"),
            provider.alias("providerid"),
            F.concat(F.lit("C"), (F.col("l_suppkey") % 50).cast("string")).alias("prm_prv_id_ccn"),
            F.when(F.col("l_partkey") % 13 != 0, F.concat(F.lit("J"), F.lpad((F.col("l_partkey") % 97).cast("string"), 4, "0"))).alias("hcpcs"),
            F.when(F.col("l_suppkey") % 5 == 1, "Y").when(F.col("l_suppkey") % 5 != 4, "N").alias("prv_net_aco_yn"),
            money(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("prm_costs"),
            money("l_extendedprice").alias("allowed"),
            money(F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("paid"),
            F.when(inpatient, F.col("l_quantity").cast("bigint") % 30 + 1).otherwise(F.col("l_quantity").cast("bigint")).alias("prm_util"),
            F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("bigint").alias("prm_admits"),
            F.when(inpatient, "Days").otherwise("Visits").alias("prm_util_type"),
            F.when(day >= F.expr("date'2001-01-01'"), "10").otherwise("09").alias("icdversion"),
        ]

    @cached_property
    def outclaims(self) -> DataFrame:
        """Medical claim lines."""
        line = _pick(MEDICAL_LINES, (F.col("l_partkey") % len(MEDICAL_LINES)).cast("int"))
        return self._lines().where("l_linestatus = 'O'").select(*self._claim_columns(line))

    @cached_property
    def outpharmacy(self) -> DataFrame:
        """Pharmacy claim lines."""
        line = _pick(PHARMACY_LINES, (F.col("l_partkey") % len(PHARMACY_LINES)).cast("int"))
        return self._lines().where("l_linestatus = 'F'").select(
            *self._claim_columns(line),
            (F.col("l_quantity").cast("bigint") % 90).alias("dayssupply"),
        )

    @cached_property
    def cases(self) -> DataFrame:
        """Attributes per case: a member's inpatient and emergency lines within a quarter.

        A case is followed by a readmission when the member has inpatient lines in the
        next quarter. A member has one case a quarter, so the next one is found by looking one row ahead.
        """
        lines = self.outclaims.where(F.col("prm_line").startswith("I") | F.col("prm_line").startswith("O11"))
        quarter = F.year("prm_fromdate") * 4 + F.quarter("prm_fromdate") - 1
        case = lines.groupBy("caseadmitid", F.col("member_id").alias("_o"), quarter.alias("_q")).agg(
            F.min("prm_fromdate").alias("date_case_earliest"), F.max("prm_todate").alias("date_case_latest"),
            F.max(F.when(F.col("prm_line").startswith("I"), 1).otherwise(0)).alias("_ip"),
        )
        ahead = F.lead(F.struct("_q", "_ip", "caseadmitid")).over(Window.partitionBy("_o").orderBy("_q"))
        follows = (F.col("_ahead._q") == F.col("_q") + 1) & (F.col("_ahead._ip") == 1)
        joined = case.withColumn("_ahead", ahead).withColumn("_next", F.when(follows, F.col("_ahead.caseadmitid")))
        k = F.col("_o").cast("bigint") * 7 + F.col("_q")
        share = lambda j: F.when(k % 6 == j, 0.75).when((k + 1) % 6 == j, 0.25).otherwise(0.0)
        return joined.select(
            "caseadmitid",
            "date_case_earliest",
            "date_case_latest",
            F.lpad((k % 40).cast("string"), 3, "0").alias("prm_drg"),
            F.lit("MS30").alias("prm_drgversion"),
            F.concat(F.lit("PQI"), F.lpad((k % 20).cast("string"), 2, "0")).alias("prm_ahrq_pqi"),
            _pick(PREFERENCE_CATEGORIES, (k % 4).cast("int")).alias("prm_pref_sensitive_category"),
            F.when(k % 3 == 0, "N").otherwise("Y").alias("prm_pref_sensitive_included_yn"),
            F.when(k % 5 == 0, "N").otherwise("Y").alias("prm_readmit_potential_yn"),
            F.when(F.col("_next").isNotNull(), "Y").otherwise("N").alias("prm_readmit_all_cause_yn"),
            F.col("_next").alias("prm_readmit_all_cause_caseid"),
            *[share(j).alias(name) for j, name in enumerate(NYU_SHARES)],
        )

    @cached_property
    def discharge_crosswalk(self) -> DataFrame:
        """Text of a discharge code: the file of code and text that a site delivers."""
        at = F.col("n_nationkey") - 1
        codes, texts = zip(*DISCHARGE_TEXTS)
        rows = self.table("nation").where(F.col("n_nationkey").between(1, len(DISCHARGE_TEXTS)))
        return rows.select(_pick(list(codes), at).alias("dischargestatus"), _pick(list(texts), at).alias("discharge_status_desc"))

    # -- providers -----------------------------------------------------------------

    @cached_property
    def providers(self) -> DataFrame:
        return self.table("supplier").select(
            _text("s_suppkey").alias("prv_id"),
            F.when(F.col("s_suppkey") % 9 != 4, F.col("s_name")).alias("prv_name"),
            F.lpad(_text("s_nationkey"), 2, "0").alias("prv_specialty"),
            F.when(F.col("s_nationkey") % 5 == 1, "Tier 1").alias("prv_net_hier_1"),
        )

    SLOTS = 48

    @cached_property
    def provider_register(self) -> DataFrame:
        """Register entries with numbered other-identifier slots."""
        k = F.col("s_suppkey")
        return self.table("supplier").select(
            F.upper("s_name").alias("prvdr_org_name"),
            *[F.concat(F.lit("C"), (k % 50 + j % 2).cast("string")).alias(f"other_prvdr_id_{j}") for j in range(1, self.SLOTS + 1)],
            *[F.when((k + j) % 61 == 0, "06").otherwise("05").alias(f"other_prvdr_id_type_cd_{j}") for j in range(1, self.SLOTS + 1)],
        )

    # -- reference tables: one row per service line, found in the part table ---------

    @cached_property
    def mr_line_info(self) -> DataFrame:
        part = self.table("part")
        med = part.groupBy((F.col("p_partkey") % len(MEDICAL_LINES)).cast("int").alias("_i")).agg(F.min("p_size").alias("_s"))
        rx = part.groupBy((F.col("p_partkey") % len(PHARMACY_LINES)).cast("int").alias("_i")).agg(F.min("p_size").alias("_s"))
        lines = med.select(_pick(MEDICAL_LINES, F.col("_i")).alias("mr_line"), "_s").unionByName(
            rx.select(_pick(PHARMACY_LINES, F.col("_i")).alias("mr_line"), "_s")
        )
        head = F.substring("mr_line", 1, 1)
        return lines.select(
            "mr_line",
            F.concat(F.lit("Line "), "mr_line").alias("prm_line_desc"),
            F.when(head == "P", "Prof").when(head == "I", "Fip").when(head == "O", "Fop").otherwise("Rx").alias("prm_line_desc1"),
            F.when(head == "I", "Days").when(F.substring("mr_line", 1, 3).isin("O14", "P57", "P59"), "Procs").otherwise("Visits").alias("costmodel_util"),
            F.when(head == "R", "Rx").otherwise("Medical").alias("prm_coverage_type"),
            F.when(head == "I", "RISKSCR_IP")
            .when(F.col("mr_line").startswith("O11"), "RISKSCR_ER")
            .when(head == "O", "RISKSCR_OP")
            .when(F.col("mr_line").startswith("P5"), "RISKSCR_OTHER")
            .when(head == "P", "RISKSCR_PHY")
            .otherwise("RISKSCR_RX")
            .alias("riskscr_component"),
        )

    @cached_property
    def link_mr_mcrm_line(self) -> DataFrame:
        lob = F.explode(F.array(F.lit("Medicare"), F.lit("Commercial")))
        return self.mr_line_info.select(
            lob.alias("lob"),
            "mr_line",
            F.when(F.col("mr_line") == "P59b", "X99").otherwise(F.substring("mr_line", 1, 3)).alias("mcrm_line"),
        )

    @cached_property
    def ref_mcrm_line(self) -> DataFrame:
        level = lambda n: F.concat(F.lit(f"Level {n} "), F.substring("mcrm_line", 1, min(n, 3)))
        return self.link_mr_mcrm_line.select("lob", "mcrm_line").distinct().select(
            "lob", "mcrm_line", *[level(n).alias(f"mcrm_line_desc_l{n}") for n in range(1, 7)]
        )

    @cached_property
    def benchmarks_hcg(self) -> DataFrame:
        kinds = F.explode(F.array(F.lit("Loosely"), F.lit("Well")))
        base = self.ref_mcrm_line.select("lob", "mcrm_line", kinds.alias("loosely_well"))
        number = F.ascii(F.substring("mcrm_line", 3, 1)).cast("double")
        factor = F.when(F.col("loosely_well") == "Well", 0.5).otherwise(1.0)
        inpatient = F.col("mcrm_line").startswith("I")
        return base.select(
            "lob", "mcrm_line", "loosely_well",
            F.when(inpatient, number * factor).alias("admits_per1k"),
            F.when(F.col("mcrm_line") != "R10", number * 4 * factor).alias("util_per1k"),
            F.when(inpatient, "Days").otherwise("Visits").alias("util_type"),
        )

    @cached_property
    def mcrm_hcc_calibrations(self) -> DataFrame:
        """Factors by score range; scores from 1.75 on have none."""
        ranges = F.explode(F.array(*[
            F.struct(F.lit(lo).alias("lo"), F.lit(hi).alias("hi"), F.lit(f).alias("f"))
            for lo, hi, f in [(0.0, 1.24, 0.75), (1.25, 1.49, 1.25), (1.5, 1.74, 1.5)]
        ]))
        return self.ref_mcrm_line.where("lob = 'Medicare'").select("mcrm_line", ranges.alias("r")).select(
            "mcrm_line",
            F.col("r.lo").alias("hcc_range_bottom"), F.col("r.hi").alias("hcc_range_top"),
            F.col("r.f").alias("factor_util"), (F.col("r.f") * 2).alias("factor_cost"),
        )

    @cached_property
    def prm_ahrq_pqi(self) -> DataFrame:
        codes = self.table("part").select((F.col("p_partkey") % 20).alias("_n")).distinct()
        code = F.concat(F.lit("PQI"), F.lpad(F.col("_n").cast("string"), 2, "0"))
        return codes.select(code.alias("prm_ahrq_pqi"), F.concat(F.lit("Quality indicator "), code).alias("pqi_full_desc"))

    # -- scores --------------------------------------------------------------------

    def _score_base(self) -> DataFrame:
        return self.table("customer").where("c_custkey % 13 != 0").select("c_custkey", ((F.col("c_custkey") % 100) / 100.0 + 1.0).cast("double").alias("_s"))

    @cached_property
    def component_scores(self) -> DataFrame:
        """Component scores per member, window and model."""
        models = F.explode(F.array(F.lit("DXPROLAG0"), F.lit("DXCONLAG0")))
        base = self._score_base().where("c_custkey % 2 = 1").select("c_custkey", "_s", models.alias("model_name"))
        base = base.withColumn("_s", F.when(F.col("model_name") == "DXCONLAG0", F.col("_s") * 2).otherwise(F.col("_s")))
        parts = {"tot": 1.0, "rx": 0.5, "med": 0.25, "ip": 1.5, "op": 0.75, "phy": 1.25, "er": 2.0, "other": 3.0}
        return base.join(reference(self.windows.select(F.col("time_period").alias("time_slice")))).select(
            F.col("c_custkey").cast("string").alias("member_id"), "time_slice", "model_name",
            *[(F.col("_s") * f).alias(f"riskscr_{p}") for p, f in parts.items()],
        )

    HCCS = [2, 6, 8, 9, 10, 11, 12, 17, 18, 19, 34, 46, 47, 54, 55, 82, 83, 84, 85, 110, 111, 134, 135, 136, 137, 176]

    @cached_property
    def hcc_results(self) -> DataFrame:
        """Diagnosis-based scores with the flags behind them, per member and window."""
        k = F.col("c_custkey")
        base = self._score_base().join(reference(self.windows.select(F.col("time_period").alias("time_slice"), F.month("inc_start").alias("_m"))))
        return base.select(
            k.cast("string").alias("hicno"), "time_slice",
            F.when((k + F.col("_m")) % 8 == 0, 7.0).otherwise(12.0).alias("riskscr_mm"),
            F.col("_s").alias("score_community"), (F.col("_s") / 2).alias("score_new_enrollee"),
            F.when(k % 2 == 0, "2").otherwise("1").alias("sex"),
            F.when(k % 3 == 0, 1).otherwise(0).alias("origds"),
            F.when(k % 5 == 0, 1).otherwise(0).alias("mcaid"),
            F.when(k % 7 < 3, 1).otherwise(0).alias("disabl"),
            *[F.when((k + F.col("_m")) % (j % 5 + 2) == 0, 1).otherwise(0).alias(f"hcc{j}") for j in self.HCCS],
            F.when(k % 4 == 1, 1).otherwise(0).alias("ne_female_65"),
        )

    @cached_property
    def coefficient_row(self) -> DataFrame:
        """One row of coefficients: CE_* community, NE_<class>_* new enrollee; values come from the line sizes."""
        names = [f"hcc{j}" for j in self.HCCS] + ["DIABETES_CHF", "CHF_COPD"]
        classes = ["NMCAID_NORIGDIS", "NMCAID_ORIGDIS", "MCAID_NORIGDIS", "MCAID_ORIGDIS"]
        one = self.table("part").agg(F.min("p_size").alias("_s"))
        return one.select(
            *[(F.col("_s") * (i + 1) / 8.0).alias(f"CE_{n}") for i, n in enumerate(names)],
            *[(F.col("_s") * (c + 2) / 4.0).alias(f"NE_{cl}_ne_female_65") for c, cl in enumerate(classes)],
        )

    # -- others --------------------------------------------------------------------

    @cached_property
    def bene_exclusion(self) -> DataFrame:
        """Exclusion file rows: id and reason code."""
        reason = _pick(["BD", "EC", "PL", "ZZ"], (F.col("c_custkey") % 4).cast("int"))
        return self.table("customer").where("c_custkey % 25 < 2").select(_text("c_custkey").alias("hicno"), reason.alias("beneexcreason"))

    @cached_property
    def market_list(self) -> DataFrame:
        """Members with the market they belong to."""
        return self.table("customer").select(_text("c_custkey").alias("hicno"), F.col("c_mktsegment").alias("market_name_orig"))


def case_id(member: Column, day: Column) -> Column:
    """Case of a claim line: member and quarter."""
    return F.concat(member.cast("string"), F.lit("_"), F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))
