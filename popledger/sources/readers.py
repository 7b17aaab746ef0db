"""Input formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from popledger.functions.text import date_stamp, file_name


def read_parquet(spark: SparkSession, *paths: str, columns: list[str] | None = None, rename: dict[str, str] | None = None, where: str | None = None) -> DataFrame:
    """One or several folders seen as one table. Columns and filter are pushed into the scan."""
    df = spark.read.parquet(*paths)
    if where:
        df = df.where(where)
    if columns:
        df = df.select(*columns)
    return df.withColumnsRenamed(rename or {})


def optional_table(spark: SparkSession, path: str | None, schema: T.StructType) -> DataFrame:
    """The table when a path is given, else a table of the same columns without rows."""
    if path:
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, delimiter: str = ",", header: bool = True) -> DataFrame:
    """Typed delimited text: quotes honoured, short lines filled with missing values."""
    return spark.read.schema(schema).option("sep", delimiter).option("header", header).option("mode", "PERMISSIVE").option(
        "ignoreTrailingWhiteSpace", True
    ).csv(path)


def read_guessed(spark: SparkSession, path: str, sampling: float = 1.0) -> DataFrame:
    """CSV with names from the header and types from the values."""
    return spark.read.option("header", True).option("inferSchema", True).option("samplingRatio", sampling).csv(path)


def read_fixed_width(spark: SparkSession, path: str, widths: dict[str, int], skip_header: bool = True) -> DataFrame:
    """Fixed-width text; fields are cut by position and trimmed, blank ones are missing.

    Lines are read as delimited text with one column, by a separator that no text holds: that reader knows each file's header."""
    lines = spark.read.schema("value string").option("sep", "\u0001").option("quote", "").option("header", skip_header).csv(path)
    position, cols = 1, []
    for name, width in widths.items():
        cols.append(F.nullif(F.trim(F.substring("value", position, width)), F.lit("")).alias(name))
        position += width
    return lines.select(*cols)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType) -> DataFrame:
    return spark.read.format("xml").schema(schema).option("rowTag", row_tag).load(path)


def list_files(spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = False) -> DataFrame:
    """File listing as a frame: path, name, size and change time; contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive)
    return reader.load(folder).select("path", file_name("path").alias("name"), "length", "modificationTime")


def newest_file(files: DataFrame) -> DataFrame:
    """Last file by name, on one row."""
    return files.agg(F.max(F.struct("name", "path")).alias("_f")).select("_f.path", "_f.name")


def snapshots_by_stamp(files: DataFrame) -> DataFrame:
    """Files with the date stamp in their name."""
    return files.select("name", date_stamp("name").alias("stamp"))
