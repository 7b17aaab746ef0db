"""Settings, sizes and shared tables of the operators in this package."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: Texts handed to a Python worker at once.
BATCH_ROWS = 512
_OWN_FOLDERS: dict[str, str] = {}
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that their Python workers can import it wherever they run."""
    package = Path(__file__).resolve().parents[1]
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or not package.is_dir():
        return
    _SHIPPED.add(app)
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))


def give_back() -> None:
    """Return freed memory to the system: workers are kept for later tasks, and what the allocators hold would count as theirs."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def lean(run: Callable) -> Callable:
    """A function for ``mapInArrow`` that gives back its memory at the end of the task."""

    def whole_task(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole_task


def prepare(spark: SparkSession) -> SparkSession:
    """Package on the executors; Arrow batches small enough for long texts; skewed joins are split also where that costs a
    shuffle above."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key as bigint and the text, without any other column."""
    return docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))


#: Stands for a missing id where ids are put in order: after all others. No document has it as its id.
NO_ID = 2**63 - 1


def numbered(texts: DataFrame) -> DataFrame:
    """Rows with NO_ID in place of a null ``doc_id``."""
    return texts.withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID).cast("bigint")))


def unnumbered(rows: DataFrame) -> DataFrame:
    return rows.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts: the size from which numbers of groups and buckets follow."""
    return docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]


def shared_folder(spark: SparkSession) -> str:
    """Folder that driver and executors share: the cluster's checkpoint folder. Only a session on one
    machine that names none, as in tests, gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = spark.sparkContext.applicationId
    if own not in _OWN_FOLDERS:
        _OWN_FOLDERS[own] = "file://" + tempfile.mkdtemp(prefix="llm-")
    return _OWN_FOLDERS[own]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back: later steps start from files
    that outlive a lost executor, with no lineage behind them."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(T.StructType(df.schema.fields)).parquet(path)
