"""Stack of all metrics, metadata tables, dictionary and manifest."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from popledger.operators.reshape import stack
from popledger.settings import ReportSettings
from popledger.sources.schema import MartSchema, conform, dictionary, labels_of
from popledger.sources.writers import checksum

METRIC_COLUMNS = ["name_client", "time_period", "elig_status_1", "metric_category", "metric_id", "metric_name", "metric_value"]


def pick_tables(tables: dict[str, DataFrame], pattern: str) -> dict[str, DataFrame]:
    """Registered tables whose name matches, ignoring case."""
    return {n: df for n, df in tables.items() if re.search(pattern, n, re.IGNORECASE)}


def metrics_key_value(tables: dict[str, DataFrame]) -> DataFrame:
    """Every metrics table in one."""
    found = pick_tables(tables, r"^metrics_(?!key_value)")
    return stack([df.select(*METRIC_COLUMNS) for df in found.values()])


def assemble(tables: dict[str, DataFrame], schema: MartSchema) -> dict[str, DataFrame]:
    """Declared tables among the given ones, conformed."""
    return {n: conform(tables[n], schema, n) for n in schema.tables if n in tables}


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return stack([df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name_table"), "rows") for n, df in tables.items()])


def manifest(tables: dict[str, DataFrame]) -> DataFrame:
    return stack([checksum(df, n) for n, df in tables.items()])


def meta_field(spark: SparkSession, schema: MartSchema, labels: dict[str, str], comments: dict[str, str], settings: ReportSettings) -> DataFrame:
    """Field id, label and comment. A label that merely repeats the field name is noise and is left out."""
    used = {c for t in schema.tables for c in schema.columns(t)}
    rows = [
        (settings.client, f, labels.get(f) if (labels.get(f) or "").lower() != f else None, comments.get(f, f.replace("_", " ")))
        for f in schema.fields if f in used
    ]
    return spark.createDataFrame(rows, schema.struct("meta_field"))


def field_use(meta: DataFrame, fields: DataFrame) -> DataFrame:
    """Metadata of the fields next to the tables that deliver them and the values found there (``fields``: rows of ``data_dictionary``)."""
    used = fields.groupBy(F.col("name_field").alias("meta_field")).agg(F.count(F.lit(1)).alias("tables"), F.sum("values_present").alias("values_present"))
    return meta.join(used, "meta_field", "left")


def meta_project(spark: SparkSession, schema: MartSchema, settings: ReportSettings) -> DataFrame:
    """Run settings as typed name/value rows: exactly one of string, date and integer is set."""
    values = {
        "paid_thru": settings.paid_thru, "credible_start": settings.credible_start, "history_cutoff": settings.history_cutoff,
        "runout_months": settings.runout_months, "lob": settings.lob, **settings.project,
    }
    rows = [
        (
            settings.client, k,
            v if isinstance(v, str) else None,
            v if isinstance(v, date) else None,
            v if isinstance(v, int) else None,
            f"Run setting {k}",
        )
        for k, v in values.items()
    ]
    return spark.createDataFrame(rows, schema.struct("meta_project"))


def field_values(df: DataFrame, first: int = 0) -> DataFrame:
    """Every value of a table as the number of its field, counted from ``first``, and a digest of two hashes, null for a missing one.
    Fractions count as equal to the cent."""
    def cell(i: int, f: T.StructField) -> Column:
        c = F.round(F.col(f.name), 2) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        return F.struct(F.lit(first + i).alias("field"), F.when(c.isNotNull(), F.xxhash64(c)).alias("a"), F.when(c.isNotNull(), F.hash(c)).alias("b"))

    cells = F.array(*[cell(i, f) for i, f in enumerate(df.schema.fields)])
    return df.select(F.explode(cells).alias("c")).select("c.*")


def data_dictionary(tables: dict[str, DataFrame], schema: MartSchema) -> DataFrame:
    """Fields of all tables with type, size, key flag, label, and what the data shows: values present and distinct values.

    All tables are unpivoted into one stream of (field number, value digest), equal values are combined in each task, and one shuffle
    counts them; the declaration, a page of rows, names the fields and is joined to the counts."""
    numbers: dict[tuple[str, str], int] = {}
    streams = []
    for n, df in tables.items():
        streams.append(field_values(df, len(numbers)))
        numbers.update({(n, c): len(numbers) + i for i, c in enumerate(df.columns)})
    # one row per value and how often it stands, then one per field
    values = stack(streams).groupBy("field", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    counted = values.groupBy("field").agg(
        F.sum(F.when(F.col("a").isNotNull(), F.col("n")).otherwise(0)).alias("values_present"), F.count("a").alias("values_distinct")
    )
    struct = T.StructType([
        T.StructField("name_table", T.StringType()), T.StructField("position", T.LongType()), T.StructField("name_field", T.StringType()),
        T.StructField("data_type", T.StringType()), T.StructField("data_size", T.LongType()), T.StructField("key_table", T.StringType()),
        T.StructField("label", T.StringType()),
    ])
    observed = {n: labels_of(df) for n, df in tables.items()}
    spark = counted.sparkSession
    declared = [r for r in dictionary(schema, observed) if r["name_table"] in tables]
    rows = [(*[r[f.name] for f in struct.fields], numbers.get((r["name_table"], r["name_field"]))) for r in declared]
    fields = spark.createDataFrame(rows, T.StructType([*struct.fields, T.StructField("field", T.IntegerType())]))
    return fields.join(counted, "field", "left").drop("field").fillna(0, ["values_present", "values_distinct"])


def dictionary_fields(full: DataFrame) -> DataFrame:
    """Second sheet: each field once."""
    return full.groupBy("name_field", "data_type", "data_size").agg(
        F.max("label").alias("label"), F.min("position").alias("first_position"), F.count(F.lit(1)).alias("tables"),
        F.sum("values_present").alias("values_present"),
    )


MANIFEST = "name_table string, rows bigint, checksum string"
MANIFEST_FIELDS = "name_table string, position bigint, name_field string, nulls bigint"


def manifest_rows(spark: SparkSession, observed: list[dict]) -> tuple[DataFrame, DataFrame]:
    """What the writer saw, a row per table and a row per field."""
    tables = [(o["name_table"], o["rows"], o["checksum"]) for o in observed]
    fields = [(o["name_table"], i + 1, c, n) for o in observed for i, (c, n) in enumerate(o["nulls"].items())]
    return spark.createDataFrame(tables, MANIFEST), spark.createDataFrame(fields, MANIFEST_FIELDS)


def members_assign(members: DataFrame, client: str) -> DataFrame:
    return members.select(F.lit(client).alias("name_client"), *members.columns)
