"""Session defaults and the shared folder for written intermediates."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from tidemark.sources.paths import delete_on_exit

# Audit times are UTC wall clocks shifted explicitly, so the session zone is
# pinned; rebase modes are stated because old parquet writers differ in them.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    # Small shuffle tasks are joined, large ones of a join or rebalance are split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.int96RebaseModeInRead": "CORRECTED",
    "spark.sql.parquet.int96RebaseModeInWrite": "CORRECTED",
    "spark.sql.parquet.datetimeRebaseModeInRead": "CORRECTED",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
}


# Set when a session is made; they cannot be changed later.
AT_START = {
    # Jobs of pools share the cluster's cores evenly (plans.control gives each table a pool).
    "spark.scheduler.mode": "FAIR",
    # Keep the compiled code of many queries (Spark's default holds 100 classes).
    "spark.sql.codegen.cache.maxEntries": "2000",
    # Do not record a Python call site for every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def apply_defaults(spark: SparkSession) -> SparkSession:
    for name, value in DEFAULTS.items():
        spark.conf.set(name, value)
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int, task_bytes: int = 256 << 20) -> int:
    """Start shuffles with enough tasks for `input_bytes`.

    Adaptive execution joins small shuffle tasks but never adds any, so the
    number to start from must suit the largest input. Only ever raised; returns
    the number that the input asks for.
    """
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(usual, -(-input_bytes // task_bytes))
    if parts > int(spark.conf.get(name, None) or usual):
        spark.conf.set(name, str(parts))
    return parts


def get_session(app_name: str, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**AT_START, **conf}.items():
        builder = builder.config(name, value)
    return apply_defaults(builder.getOrCreate())


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the one the cluster names in spark.checkpoint.dir.

    All such folders of a session lie in one, which is deleted when the session's
    JVM ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    own = f"{base.rstrip('/')}/tidemark-{spark.sparkContext.applicationId}"
    delete_on_exit(spark, own)
    return f"{own}/{uuid.uuid4().hex}/{name}"
