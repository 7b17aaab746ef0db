from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from popledger.oracle.base import with_ctes
from popledger.plans.report import Report, StoredReport
from popledger.session import apply_plan_settings
from popledger.sources.star import StarModel
from popledger.sources.writers import remove_folder, staging_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tidy(df: DataFrame) -> DataFrame:
    """Comparable types: money to cents, other fractions to six digits, whole numbers as bigint.

    Amounts are rounded while they are still decimals, so halves are exact."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = F.round(c, 2).cast("double")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


_REPORTS: dict[tuple[str, str], Report] = {}


def report(spark: SparkSession, path: str) -> Report:
    """Report over the tables of a folder; its plans are built once per application."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _REPORTS:
        apply_plan_settings(spark)
        _REPORTS[key] = Report(StarModel(spark, path))
    return _REPORTS[key]


_STAGED: list[str] = []


def staged_report(spark: SparkSession, path: str, only: Collection[str] | None = None) -> Report:
    """Report whose shared intermediates, or only those named, are written to a folder of its own in the shared folder."""
    _STAGED.append(f"{shared_folder(spark)}/report-{uuid.uuid4().hex[:12]}")
    return Report(StarModel(apply_plan_settings(spark), path), folder=_STAGED[-1], only=only)


def release(spark: SparkSession) -> None:
    """Delete what staged reports have written, once their results are used."""
    while _STAGED:
        remove_folder(spark, _STAGED.pop())


_MARTS: dict[tuple[str, str], tuple[Report, StoredReport]] = {}


def written(spark: SparkSession, path: str) -> tuple[Report, StoredReport]:
    """Staged report over the tables of a folder and its stored mart; each table of it is written once per application, when a query reads it."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _MARTS:
        # kept for the whole application, unlike a staged report
        folder = f"{shared_folder(spark)}/mart-{uuid.uuid4().hex[:12]}"
        r = Report(StarModel(apply_plan_settings(spark), path), folder=f"{folder}-stages")
        _MARTS[key] = (r, r.store(folder))
    return _MARTS[key]


_OWN_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a session on one machine that has none, as in tests, is given a temporary one."""
    own = spark.sparkContext.applicationId
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.startswith("local"):
        if own not in _OWN_FOLDERS:
            _OWN_FOLDERS[own] = "file://" + tempfile.mkdtemp(prefix="popledger-")
        return _OWN_FOLDERS[own]
    return staging_folder(spark)


def query(name: str, sql: str | None = None, staged: bool | Collection[str] = False):
    """Register ``fn(report) -> DataFrame`` under a name; ``sql`` is its DuckDB counterpart. ``staged``: the report's shared
    intermediates, or those named, are stored first, anew for each run."""
    only = None if isinstance(staged, bool) else staged

    def wrap(fn: Callable[[Report], DataFrame]):
        QUERIES[name] = lambda spark, path: tidy(fn(staged_report(spark, path, only) if staged else report(spark, path)))
        if sql:
            ORACLES[name] = with_ctes(sql)
        return fn

    return wrap


def mart_query(name: str, sql: str):
    """Register ``fn(report, stored) -> DataFrame`` over the stored mart."""

    def wrap(fn: Callable[[Report, StoredReport], DataFrame]):
        QUERIES[name] = lambda spark, path: tidy(fn(*written(spark, path)))
        ORACLES[name] = with_ctes(sql)
        return fn

    return wrap


def money(expr: str) -> str:
    return f"cast(round({expr}, 2) as double)"


def ratio(expr: str) -> str:
    return f"round(cast({expr} as double), 6)"


def whole(expr: str) -> str:
    return f"cast({expr} as bigint)"


def long_sql(source: str, metrics: dict[str, tuple[str, str]], category: str, where: str = "") -> str:
    """Wide SQL source to metric rows; ``metrics``: id -> (label, expression)."""
    parts = [
        f"select 'Sample Client' as name_client, time_period, elig_status_1, '{category}' as metric_category, '{m}' as metric_id, "
        f"'{label}' as metric_name, {ratio(expr)} as metric_value from {source}"
        for m, (label, expr) in metrics.items()
    ]
    text = "\nunion all\n".join(parts)
    return f"select * from ({text}) {where}" if where else text
