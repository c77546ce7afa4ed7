"""Joins rely on adaptive execution to split a hot key: check that it can, at thresholds that suit small data."""

import pytest
from pyspark.sql import functions as F

from helpers import plan
from tidemark.operators import history, joins
from tidemark.operators.history import History
from tidemark.plans import control
from tidemark.sources import files

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def small(spark):
    before = {name: spark.conf.get(name, None) for name in SMALL}
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def log(spark, folder, small):
    """Sixty per cent of the rows on one key, in several files."""
    n = 400_000
    df = spark.range(0, n, 1, 8).select(
        F.when(F.xxhash64("id") % 10 < 2, F.abs(F.xxhash64("id")) % 5000).otherwise(0).alias("k"),
        F.col("id").alias("ts"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    df.write.parquet(folder)
    return spark.read.parquet(folder)


def ran(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df)


def test_join_splits_the_hot_key(spark, log, folder):
    log.groupBy("k").agg(F.max("ts").alias("newest")).write.parquet(folder + "-keys")
    one_per_key = spark.read.parquet(folder + "-keys")
    assert "skew=true" in ran(joins.join_on_keys(log, one_per_key, "k"))


def test_join_with_grouped_rows_splits_the_hot_key(spark, log):
    one_per_key = log.groupBy("k").agg(F.max("ts").alias("newest"))
    assert "skew=true" in ran(joins.join_grouped(log, one_per_key, ["k"]).select("l.*", "newest"))


def test_left_join_splits_the_hot_key(spark, log):
    config = log.groupBy("k").agg(F.max("ts").alias("newest"))
    assert "skew=true" in ran(control.with_config(log, config, {"k": "k"}).select("v", "newest"))


def test_touched_rows_split_the_hot_key(spark, log):
    assert "skew=true" in ran(joins.rows_touched(log, log, "k"))
    assert "skew=true" in ran(joins.rows_untouched(log, log.filter("k > 9"), "k"))


def test_late_rows_split_the_hot_key(spark, log):
    current = log.groupBy("k").agg(F.max("ts").alias("effective_from")).withColumns(
        {"v": F.lit(""), "effective_to": F.lit(None).cast("long"), "status": F.lit("active")}
    )
    late = history.late_rows(current, log, History(keys="k", ts="ts"))
    assert "skew=true" in ran(late)


def test_partitioned_write_splits_the_hot_folder(spark, log, folder):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4MB")
    df = log.withColumn("part", F.when(F.col("k") == 0, "hot").otherwise((F.col("k") % 3).cast("string")))
    files.write_files(df, "parquet", folder + "-parts", partition_by="part")
    listed = files.file_manifest(spark, folder + "-parts", "*.parquet")
    counts = listed.groupBy(F.regexp_extract("path", "part=([^/]+)", 1).alias("part")).count().collect()
    counts = {r.part: r["count"] for r in counts}
    assert set(counts) == {"hot", "0", "1", "2"}
    assert counts["hot"] >= 4 and max(counts[p] for p in "012") <= 2
    assert files.read_parquet(spark, folder + "-parts").count() == log.count()
