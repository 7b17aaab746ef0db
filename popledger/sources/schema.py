"""Declared output tables: fields, keys, and the operators that enforce them."""

from __future__ import annotations

import csv
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from popledger.settings import ReportSettings

# Name, type, size, whether nulls are allowed, allowed values, whether a label is required; in declared order.
FIELDS = [
    ("name_client", "varchar", 256, False, [], False),
    ("time_period", "varchar", 32, False, [], False),
    ("prm_line", "char", 5, False, [], False),
    ("prm_line_desc", "varchar", 128, False, [], False),
    ("mcrm_line", "varchar", 8, False, [], False),
    ("elig_status_1", "varchar", 64, False, [], True),
    ("prv_net_aco_yn", "char", 1, False, ["Y", "N"], False),
    ("prm_util_type", "varchar", 16, False, [], False),
    ("prm_discharges", "integer", None, False, [], False),
    ("prm_days", "integer", None, False, [], False),
    ("prm_util", "integer", None, False, [], False),
    ("prm_memmos", "float", None, False, [], False),
    ("prm_costs", "float", None, False, [], False),
    ("prm_allowed", "float", None, False, [], False),
    ("prm_paid", "float", None, False, [], False),
    ("member_count", "integer", None, False, [], False),
    ("cost_bucket", "varchar", 45, False, [], False),
    ("providerid", "varchar", 40, False, [], False),
    ("provider", "varchar", 128, False, [], False),
    ("claim_count", "integer", None, False, [], False),
    ("specialty", "varchar", 2, False, [], False),
    ("hcpcs", "varchar", 5, True, [], False),
    ("prm_coverage_type", "varchar", 8, False, ["Medical", "Dental", "Vision", "Rx", "Total"], False),
    ("type_benchmark", "varchar", 8, False, ["Loosely", "Well"], False),
    ("riskscr_service_avg_util", "float", None, False, [], False),
    ("riskscr_service_avg_cost", "float", None, False, [], False),
    ("benchmark_discharges_per1k", "float", None, False, [], False),
    ("benchmark_days_per1k", "float", None, False, [], False),
    ("benchmark_util_per1k", "float", None, False, [], False),
    ("deceased_yn", "char", 1, False, ["Y", "N"], False),
    ("deceased_hospital_yn", "char", 1, False, ["Y", "N"], False),
    ("endoflife_numer_yn_chemolt14days", "char", 1, False, ["Y", "N"], False),
    ("endoflife_denom_yn_chemolt14days", "char", 1, False, ["Y", "N"], False),
    ("endoflife_numer_yn_hospicelt3day", "char", 1, False, ["Y", "N"], False),
    ("endoflife_denom_yn_hospicelt3day", "char", 1, False, ["Y", "N"], False),
    ("endoflife_numer_yn_hospicenever", "char", 1, False, ["Y", "N"], False),
    ("endoflife_denom_yn_hospicenever", "char", 1, False, ["Y", "N"], False),
    ("age_avg", "float", None, False, [], False),
    ("final_hospice_days", "integer", None, False, [], False),
    ("costs_final_30_days_sum", "float", None, False, [], False),
    ("risk_score_type", "varchar", 32, False, [], False),
    ("riskscr_avg", "float", None, False, [], False),
    ("memcnt", "integer", None, False, [], False),
    ("riskscr_cred", "float", None, False, [], False),
    ("prv_id_inpatient", "varchar", 40, False, [], False),
    ("discharge_status_code", "char", 2, False, [], False),
    ("discharge_status_desc", "varchar", 256, False, [], False),
    ("drg_inpatient", "char", 3, False, [], False),
    ("drg_version_inpatient", "char", 5, False, [], False),
    ("acute_yn", "char", 1, False, ["Y", "N"], False),
    ("medical_surgical", "char", 8, False, ["Medical", "Surgical", "None"], False),
    ("inpatient_pqi_yn", "char", 1, False, ["Y", "N"], False),
    ("prm_ahrq_pqi", "char", 16, False, [], False),
    ("inpatient_discharge_to_snf_yn", "char", 1, False, ["Y", "N"], False),
    ("inpatient_readmit_potential_yn", "char", 1, False, ["Y", "N"], False),
    ("inpatient_readmit_yn", "char", 1, False, ["Y", "N"], False),
    ("preference_sensitive_yn", "char", 1, False, ["Y", "N"], False),
    ("prm_pref_sensitive_category", "char", 50, False, [], False),
    ("los_inpatient", "integer", None, False, [], False),
    ("cnt_discharges_inpatient", "integer", None, False, [], False),
    ("sum_days_inpatient", "integer", None, False, [], False),
    ("sum_costs_inpatient", "float", None, False, [], False),
    ("prv_id_snf", "varchar", 40, False, [], False),
    ("snf_readmit_yn", "char", 1, False, ["Y", "N"], False),
    ("los_snf", "integer", None, False, [], False),
    ("cnt_discharges_snf", "integer", None, False, [], False),
    ("sum_days_snf", "integer", None, False, [], False),
    ("sum_costs_snf", "float", None, False, [], False),
    ("sum_costs_prof_snf", "float", None, False, [], False),
    ("metric_category", "varchar", 32, False, ["inpatient", "discharge_status", "snf", "er", "outpatient", "end_of_life", "basic"], False),
    ("metric_id", "varchar", 32, False, [], False),
    ("metric_name", "varchar", 256, False, [], False),
    ("metric_value", "float", None, False, [], False),
    ("inc_start", "date", None, False, [], False),
    ("inc_end", "date", None, False, [], False),
    ("paid_thru", "date", None, False, [], False),
    ("inc_start_riskscr_features", "date", None, False, [], False),
    ("inc_end_riskscr_features", "date", None, False, [], False),
    ("riskscr_period_type", "char", 12, False, ["Prospective", "Concurrent"], False),
    ("meta_field", "varchar", 32, False, [], False),
    ("meta_field_label", "varchar", 80, True, [], False),
    ("meta_field_comment", "varchar", 4096, False, [], False),
    ("meta_project", "varchar", 64, False, [], False),
    ("meta_project_string", "varchar", 1024, True, [], False),
    ("meta_project_date", "date", None, True, [], False),
    ("meta_project_integer", "integer", None, True, [], False),
    ("meta_project_notes", "varchar", 256, False, [], False),
    ("mcrm_line_desc_l1", "varchar", 128, False, [], False),
    ("mcrm_line_desc_l2", "varchar", 128, True, [], False),
    ("mcrm_line_desc_l3", "varchar", 128, True, [], False),
    ("mcrm_line_desc_l4", "varchar", 128, True, [], False),
    ("mcrm_line_desc_l5", "varchar", 128, True, [], False),
    ("mcrm_line_desc_l6", "varchar", 128, True, [], False),
    ("riskscr_wgt", "float", None, False, [], False),
    ("member_id", "char", 40, False, [], False),
    ("elig_months", "float", None, False, [], False),
    ("total_cost", "float", None, False, [], False),
]

# Key fields, then the other fields, of each output table.
TABLES = {
    "cost_util": (
        ["name_client", "time_period", "prm_line", "mcrm_line", "elig_status_1", "prv_net_aco_yn"],
        ["prm_discharges", "prm_days", "prm_util", "prm_costs", "prm_allowed", "prm_paid", "prm_coverage_type"],
    ),
    "claims_distribution": (
        ["name_client", "time_period", "elig_status_1", "cost_bucket"],
        ["member_count", "prm_costs"],
    ),
    "office_admin_drug": (
        ["name_client", "time_period", "elig_status_1", "providerid", "hcpcs"],
        ["claim_count", "provider", "specialty", "prm_costs"],
    ),
    "memmos": (
        ["name_client", "time_period", "elig_status_1", "prm_coverage_type"],
        ["prm_memmos"],
    ),
    "ref_prm_line": (
        ["prm_line"],
        ["name_client", "prm_line_desc", "mcrm_line", "mcrm_line_desc_l1", "mcrm_line_desc_l2", "mcrm_line_desc_l3",
         "mcrm_line_desc_l4", "mcrm_line_desc_l5", "mcrm_line_desc_l6", "prm_util_type", "prm_coverage_type"],
    ),
    "cost_util_benchmark": (
        ["name_client", "time_period", "mcrm_line", "elig_status_1", "type_benchmark"],
        ["riskscr_service_avg_util", "riskscr_service_avg_cost", "benchmark_discharges_per1k", "benchmark_days_per1k",
         "benchmark_util_per1k"],
    ),
    "memcnt": (
        ["name_client", "time_period", "elig_status_1", "deceased_yn", "deceased_hospital_yn", "endoflife_numer_yn_chemolt14days",
         "endoflife_denom_yn_chemolt14days", "endoflife_numer_yn_hospicelt3day", "endoflife_denom_yn_hospicelt3day",
         "endoflife_numer_yn_hospicenever", "endoflife_denom_yn_hospicenever", "final_hospice_days"],
        ["age_avg", "costs_final_30_days_sum", "risk_score_type", "riskscr_avg", "riskscr_wgt", "riskscr_cred", "memcnt"],
    ),
    "details_inpatient": (
        ["name_client", "elig_status_1", "time_period", "prv_id_inpatient", "discharge_status_code", "drg_inpatient",
         "drg_version_inpatient", "acute_yn", "medical_surgical", "inpatient_pqi_yn", "prm_ahrq_pqi", "inpatient_discharge_to_snf_yn",
         "preference_sensitive_yn", "prm_pref_sensitive_category", "inpatient_readmit_potential_yn", "inpatient_readmit_yn",
         "los_inpatient"],
        ["discharge_status_desc", "cnt_discharges_inpatient", "sum_days_inpatient", "sum_costs_inpatient"],
    ),
    "details_snf": (
        ["name_client", "time_period", "elig_status_1", "prv_id_snf", "snf_readmit_yn", "los_snf"],
        ["cnt_discharges_snf", "sum_days_snf", "sum_costs_snf"],
    ),
    "details_snf_professional": (
        ["name_client", "time_period", "elig_status_1", "prv_id_snf"],
        ["sum_costs_prof_snf"],
    ),
    "metrics_key_value": (
        ["name_client", "time_period", "elig_status_1", "metric_category", "metric_id"],
        ["metric_name", "metric_value"],
    ),
    "time_windows": (
        ["name_client", "time_period"],
        ["inc_start", "inc_end", "paid_thru", "inc_start_riskscr_features", "inc_end_riskscr_features", "riskscr_period_type"],
    ),
    "meta_field": (
        ["name_client", "meta_field"],
        ["meta_field_label", "meta_field_comment"],
    ),
    "member_costs": (
        ["name_client", "member_id", "time_period"],
        ["total_cost"],
    ),
    "member_elig": (
        ["name_client", "time_period", "member_id", "elig_status_1"],
        ["elig_months"],
    ),
    "meta_project": (
        ["name_client", "meta_project"],
        ["meta_project_string", "meta_project_date", "meta_project_integer", "meta_project_notes"],
    ),
}

SPARK_TYPES = {
    "varchar": T.StringType(), "char": T.StringType(), "integer": T.LongType(), "float": T.DoubleType(), "date": T.DateType(),
}


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    size: int | None
    nullable: bool
    whitelist: tuple[str, ...]
    label_required: bool

    def struct_field(self) -> T.StructField:
        meta = {"max_len": self.size} if self.size else {}
        if self.whitelist:
            meta["allowed"] = "~".join(self.whitelist)
        return T.StructField(self.name, SPARK_TYPES[self.type], self.nullable, meta)


@dataclass(frozen=True)
class MartSchema:
    """Fields and tables of one mart."""

    fields: dict[str, Field]
    tables: dict[str, tuple[list[str], list[str]]]

    @classmethod
    def declared(cls, settings: ReportSettings | None = None) -> "MartSchema":
        settings = settings or ReportSettings()
        fields = {}
        for name, kind, size, nulls, allowed, label in FIELDS:
            if name == "risk_score_type":
                allowed = [settings.hcc_label, settings.component_label]
            fields[name] = Field(name, kind, size, nulls, tuple(allowed), label)
        return cls(fields, {t: (list(keys), list(rest)) for t, (keys, rest) in TABLES.items()})

    @classmethod
    def from_csv(cls, fields_csv: str, tables_csv: str) -> "MartSchema":
        """Read a mart declaration: one CSV of fields, one of table membership and keys."""
        fields = {}
        with open(fields_csv, newline="") as f:
            for r in csv.DictReader(f):
                name = r["name_field"].lower()
                fields[name] = Field(
                    name, r["data_type"].lower(), int(r["data_size"]) if r["data_size"] else None, r["allow_nulls"].upper() == "Y",
                    tuple(filter(None, r["whitelist_nonnull_values"].split("~"))), r["require_label_ifnotallnull"].upper() == "Y",
                )
        tables: dict[str, tuple[list[str], list[str]]] = {}
        with open(tables_csv, newline="") as f:
            for r in csv.DictReader(f):
                keys, rest = tables.setdefault(r["name_table"].lower(), ([], []))
                (keys if r["key_table"].upper() == "Y" else rest).append(r["name_field"].lower())
        return cls(fields, tables)

    def columns(self, table: str) -> list[str]:
        keys, rest = self.tables[table]
        return [*keys, *rest]

    def keys(self, table: str) -> list[str]:
        return self.tables[table][0]

    def struct(self, table: str) -> T.StructType:
        return T.StructType([self.fields[c].struct_field() for c in self.columns(table)])


def conform(df: DataFrame, schema: MartSchema, table: str, labels: dict[str, str] | None = None) -> DataFrame:
    """Declared columns in declared order and type; trailing blanks cut; labels and limits as field metadata."""
    labels = labels or {}
    out = []
    for name in schema.columns(table):
        f = schema.fields[name].struct_field()
        c = F.col(name).cast(f.dataType)
        if isinstance(f.dataType, T.StringType):
            c = F.rtrim(c)
        meta = {**f.metadata, **({"label": labels[name]} if name in labels else {})}
        out.append(c.alias(name, metadata=meta))
    return df.select(*out)


def empty_table(spark, schema: MartSchema, table: str) -> DataFrame:
    """Typed table without rows, for a source that is not supplied."""
    return spark.createDataFrame([], schema.struct(table))


def clear_labels(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).alias(c, metadata={}) for c in df.columns])


def labels_of(df: DataFrame) -> dict[str, str]:
    return {f.name: f.metadata["label"] for f in df.schema.fields if "label" in (f.metadata or {})}


def schema_violations(df: DataFrame, schema: MartSchema, table: str) -> list[str]:
    """Missing or surplus columns and wrong types, found without reading data."""
    want = {f.name: f.dataType for f in schema.struct(table).fields}
    have = {f.name: f.dataType for f in df.schema.fields}
    issues = [f"{table}.{c}: missing" for c in want if c not in have]
    issues += [f"{table}.{c}: not declared" for c in have if c not in want]
    issues += [f"{table}.{c}: {have[c].simpleString()} instead of {want[c].simpleString()}" for c in want if c in have and have[c] != want[c]]
    return issues


def rules_of(schema: MartSchema, table: str, client: str | None = None) -> list[tuple[str, str, Column]]:
    """Field, rule and the test a violating row meets, for every declared rule of a table but the key. ``client``: the only client name."""
    rules: list[tuple[str, str, Column]] = []
    for name in schema.columns(table):
        f, c = schema.fields[name], F.col(name)
        if not f.nullable:
            rules.append((name, "null", c.isNull()))
        if f.size:
            rules.append((name, "too long", F.length(c) > f.size))
        if f.whitelist:
            rules.append((name, "not allowed", c.isNotNull() & ~F.lower(c).isin([w.lower() for w in f.whitelist])))
        if client is not None and name == "name_client":
            rules.append((name, "other client", ~F.upper(c).eqNullSafe(F.lit(client.upper()))))
    return rules


def rule_results(df: DataFrame, schema: MartSchema, table: str, client: str | None = None) -> DataFrame:
    """Violating rows of every declared rule of a table, null, length, allowed values, client and key alike, in one pass and one shuffle.

    Rows are summed per key first, which the key rule needs: a key with n rows has n - 1 too many."""
    rules = rules_of(schema, table, client)
    hit = lambda test: F.sum(F.when(test, 1).otherwise(0))
    per_key = df.groupBy(*schema.keys(table)).agg(F.count(F.lit(1)).alias("_n"), *[hit(test).alias(f"_r{i}") for i, (_, _, test) in enumerate(rules)])
    totals = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("checked"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("_key"),
        *[F.coalesce(F.sum(f"_r{i}"), F.lit(0)).alias(f"r{i}") for i in range(len(rules))],
    )
    named = [(n, kind, F.col(f"r{i}")) for i, (n, kind, _) in enumerate(rules)] + [(",".join(schema.keys(table)), "key", F.col("_key"))]
    rows = F.array(*[F.struct(F.lit(n).alias("name_field"), F.lit(kind).alias("rule"), c.alias("rows")) for n, kind, c in named])
    return totals.select(F.lit(table).alias("name_table"), "checked", F.explode(rows).alias("v")).select("name_table", "checked", "v.*")


def value_violations(df: DataFrame, schema: MartSchema, table: str) -> DataFrame:
    """Rows violating the nulls, length and allowed-value rules counted per rule, all in one pass."""
    found = rule_results(df, schema, table).where("rule <> 'key' and rows > 0")
    return found.select("name_table", "name_field", "rule", "rows")


def key_violations(df: DataFrame, schema: MartSchema, table: str) -> DataFrame:
    return df.groupBy(*schema.keys(table)).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def dictionary(schema: MartSchema, observed: dict[str, dict[str, str]]) -> list[dict]:
    """Field list per table, with the labels found on the delivered tables, in column order."""
    return [
        {
            "name_table": t, "position": i + 1, "name_field": c, "data_type": schema.fields[c].type,
            "data_size": schema.fields[c].size, "key_table": "Y" if c in schema.keys(t) else "N",
            "label": reduce(lambda a, b: a or b, [observed.get(t, {}).get(c)], None),
        }
        for t in schema.tables for i, c in enumerate(schema.columns(t))
    ]
