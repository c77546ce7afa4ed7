"""The example job on a small lake, two days long."""

import pytest
from pyspark.sql import functions as F

from examples.daily_job import CONTROL_KEYS, run_day
from tidemark.functions.times import null_timestamp
from tidemark.sources import files, keyed

CONTROL = (
    "batch_name string, table_name string, business_date string, job_id string, "
    "start_time string, from_time string, to_time string"
)


@pytest.fixture
def lake(spark, folder):
    jobs = [
        ("HR", "EMP", "2024-01-01", "7", "2024-01-02 01:00:00", "2024-01-01 00:00:00", "2024-01-01 23:59:59"),
        ("HR", "EMP", "2024-01-02", "7", "2024-01-03 01:00:00", "2024-01-02 00:00:00", "2024-01-02 23:59:59"),
        ("HR", "GONE", "2024-01-01", "7", "2024-01-02 01:00:00", "2024-01-01 00:00:00", "2024-01-01 23:59:59"),
        ("HR", "EMP", "2024-01-01", "8", "2024-01-02 01:00:00", "2024-01-01 00:00:00", "2024-01-01 23:59:59"),
    ]
    control = spark.createDataFrame(jobs[:1] + jobs[2:3], CONTROL)
    add_jobs(spark, folder, control)
    config = [("HR", "EMP", "daily_emp", "id,site", "hr_src"), ("HR", "GONE", "daily_gone", "id", "hr_src")]
    spark.createDataFrame(
        config, "owner string, source_table string, target string, primary_key string, source_schema string"
    ).write.parquet(f"{folder}/config")
    return folder, spark.createDataFrame(jobs[1:2], CONTROL)


DAY_1 = [(1, "a", "Ann", "2023-12-31 20:00:00", "I"), (2, "a", "Bob", "2024-01-01 01:00:00", "I")]
DAY_2 = [
    (1, "a", "Anne", "2024-01-01 18:00:00", "U"),
    (2, "a", "Bob", "2024-01-01 19:00:00", "D"),
    (1, "b", "Amy", "2024-01-02 01:00:00", "I"),
]
VERSIONS = [
    (1, "a", "Ann", "inactive", "2024-01-01 04:00:00", "2024-01-02 02:00:00"),
    (1, "a", "Anne", "active", "2024-01-02 02:00:00", "None"),
    (1, "b", "Amy", "active", "2024-01-02 09:00:00", "None"),
    (2, "a", "Bob", "inactive", "2024-01-01 09:00:00", "2024-01-02 03:00:00"),
]


def add_jobs(spark, lake, jobs):
    jobs = jobs.select(
        "batch_name", "table_name", F.col("business_date").cast("date").alias("business_date"), "job_id", "start_time",
        "from_time", "to_time", F.lit(1).alias("step_index"), F.lit("R").alias("status"),
        F.lit(None).cast("string").alias("status_desc"), null_timestamp().alias("updated_at"),
    )
    keyed.write_keyed(jobs, f"{lake}/control", CONTROL_KEYS, known_unique=True)


def land(spark, lake, *rows):
    df = spark.createDataFrame(list(rows), "id int, site string, name string, changed_at string, op string")
    df = df.withColumn("changed_at", F.col("changed_at").cast("timestamp_ntz"))
    files.write_parquet(df, f"{lake}/landing/hr/emp", mode="append")


def versions(spark, lake):
    rows = keyed.read_keyed(spark, f"{lake}/structured/hr/emp").collect()
    assert {r.source_system for r in rows} == {"hr_src"}
    return sorted((r.id, r.site, r.name, r.status, str(r.effective_from), str(r.effective_to)) for r in rows)


def test_two_days(spark, lake):
    lake, second_day = lake
    land(spark, lake, *DAY_1)
    done = run_day(spark, lake, "7", "2024-01-02 02:00:00")
    assert sorted((k[1], v) for k, v in done.items()) == [("EMP", "initial"), ("GONE", "nothing")]
    assert run_day(spark, lake, "7") == {}
    add_jobs(spark, lake, second_day)
    land(spark, lake, *DAY_2)
    assert list(run_day(spark, lake, "7", "2024-01-03 02:00:00").values()) == ["incremental"]
    assert versions(spark, lake) == VERSIONS
    control = keyed.read_keyed(spark, f"{lake}/control").collect()
    assert {(r.step_index, r.status, r.status_desc) for r in control} == {(2, "R", "Ready")}
    assert sorted(str(r.updated_at) for r in control) == ["2024-01-02 10:00:00"] * 2 + ["2024-01-03 10:00:00"]


def test_two_days_due_at_once_run_in_order(spark, lake):
    lake, second_day = lake
    add_jobs(spark, lake, second_day)
    land(spark, lake, *DAY_1, *DAY_2)
    done = run_day(spark, lake, "7")
    assert {(k[1], str(k[2])): v for k, v in done.items()} == {
        ("EMP", "2024-01-01"): "initial",
        ("EMP", "2024-01-02"): "incremental",
        ("GONE", "2024-01-01"): "nothing",
    }
    assert versions(spark, lake) == VERSIONS
