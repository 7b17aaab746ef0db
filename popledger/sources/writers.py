"""Outputs: tables, flat files, manifest."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from popledger.sources.schema import MartSchema, conform


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_declared(df: DataFrame, schema: MartSchema, table: str, folder: str) -> str:
    """Conform a result to its declaration and store it under its name."""
    path = f"{folder.rstrip('/')}/{table}"
    write_table(conform(df, schema, table), path)
    return path


def write_observed(df: DataFrame, schema: MartSchema, table: str, folder: str, labels: dict[str, str] | None = None) -> dict:
    """Store a result as declared, and count its rows, their checksum and the nulls of every field on the way: nothing is read again.

    The counts are taken in the last stage, whose tasks Spark counts once each, however often they are tried."""
    rows = conform(df, schema, table, labels)
    seen = Observation(table)
    counts = [F.count(F.lit(1)).alias("rows"), *[c.alias(f"digest_{i}") for i, c in enumerate(digest_sums(rows))]]
    nulls = [F.sum(F.col(c).isNull().cast("bigint")).alias(f"null_{c}") for c in rows.columns]
    write_table(rows.observe(seen, *counts, *nulls), f"{folder.rstrip('/')}/{table}")
    got = seen.get
    return {
        "name_table": table, "rows": got["rows"], "checksum": str(sum((got[f"digest_{i}"] or 0) << i * DIGEST_BITS for i in range(DIGEST_PARTS))),
        "nulls": {c: got[f"null_{c}"] or 0 for c in rows.columns},
    }


def copy_tables(spark: SparkSession, source: str, target: str, tables: list[str]) -> None:
    for t in tables:
        write_table(spark.read.parquet(f"{source.rstrip('/')}/{t}"), f"{target.rstrip('/')}/{t}")


def export_flat(spark: SparkSession, folder: str, target: str, tables: list[str]) -> None:
    """A whole mart as delimited text with a header line, one folder per table."""
    for t in tables:
        export_csv(spark.read.parquet(f"{folder.rstrip('/')}/{t}"), f"{target.rstrip('/')}/{t}")


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def row_text(df: DataFrame) -> Column:
    """Text of a row that differs whenever the row does: every value with its length before it, N for a missing one.

    Fractions are written with nine digits, so that engines agree on them."""
    parts = []
    for f in sorted(df.schema.fields, key=lambda f: f.name):
        c = F.col(f"`{f.name}`")
        value = c.cast("decimal(38,9)").cast("string") if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else c.cast("string")
        parts.append(F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("N")))
    return F.concat(*parts)


def row_digest(df: DataFrame) -> Column:
    """Digest of a row as a whole number: the first 15 hexadecimal digits of the MD5 of its text fit a bigint."""
    return F.conv(F.substring(F.md5(row_text(df)), 1, 15), 16, 10).cast("bigint")


#: A digest has 60 bits and is summed in three parts: sums of whole numbers are quick, and those of 20 bits hold 2**43 rows.
DIGEST_PARTS, DIGEST_BITS = 3, 20


def digest_sums(df: DataFrame) -> list[Column]:
    """Sums of the parts of the row digests, lowest first."""
    digest = row_digest(df)
    return [F.sum(F.shiftright(digest, i * DIGEST_BITS).bitwiseAND(F.lit((1 << DIGEST_BITS) - 1))) for i in range(DIGEST_PARTS)]


def checksum(df: DataFrame, name: str) -> DataFrame:
    """Row count and a sum of row digests, as text, that does not depend on the order of the rows. The decimal total cannot overflow."""
    parts = [c.cast("decimal(38,0)") * F.lit(1 << i * DIGEST_BITS) for i, c in enumerate(digest_sums(df))]
    total = F.coalesce(reduce(lambda a, b: a + b, parts), F.lit(0)).cast("string")
    return df.agg(F.count(F.lit(1)).alias("rows"), total.alias("checksum")).select(F.lit(name).alias("name_table"), "rows", "checksum")


def file_digests(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Digest of every delivered file, for deliveries of ordinary size: a file is read as one value, which Spark limits to 2 GB.
    Tables have ``checksum`` instead, at any size."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("filename"), F.md5("content").alias("md5"))


def staging_folder(spark: SparkSession) -> str:
    """Folder for shared intermediates: the checkpoint folder that driver and executors share."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared.rstrip('/')}/{spark.sparkContext.applicationId}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder of intermediates, wherever the cluster keeps it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, name: str, folder: str | None) -> DataFrame:
    """Write a shared intermediate to the staging folder and read it back.

    Later stages then start from columnar files that outlive a lost executor. Without a
    folder the plan is returned as it is.
    """
    if not folder:
        return df
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
