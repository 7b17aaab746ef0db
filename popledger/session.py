"""One place for the session settings the report relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Semantics first (time zone, ANSI), then the adaptive features the plans count on:
# skewed joins are split at run time and small sides are broadcast on measured size only.
CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even when that costs the sums above it a shuffle of their own
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # plans here are built from many small expressions; do not capture a call site for each
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# A single local machine: keep all cores busy on small shuffles and compiled stages in memory.
LOCAL_CONF = {
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.codegen.cache.maxEntries": "2000",
    "spark.ui.enabled": "false",
}


def get_session(
    app_name: str = "popledger",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the report's settings. On a cluster leave ``master`` unset and
    ``shuffle_partitions`` at the cluster's value; AQE coalesces what is too fine."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    local = LOCAL_CONF if master and master.startswith("local") else {}
    for key, value in {**CONF, **local, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_plan_settings(spark: SparkSession) -> SparkSession:
    """Set the adaptive features the plans count on in a session made elsewhere."""
    for key, value in CONF.items():
        if key.startswith("spark.sql.adaptive."):
            spark.conf.set(key, value)
    return spark
