"""How many tasks shuffles have."""

from __future__ import annotations

from pyspark.sql import SparkSession


def shuffle_parts(spark: SparkSession) -> int:
    """How many tasks a shuffle starts with before adaptive execution joins small ones."""
    parts = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(parts or spark.conf.get("spark.sql.shuffle.partitions"))
