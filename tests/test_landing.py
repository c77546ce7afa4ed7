import threading
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from helpers import rows
from tidemark.plans import control, landing
from tidemark.plans.daily import Zones, run_table
from tidemark.plans.zones import Run
from tidemark.sources import catalog, files, keyed
from tidemark.sources.paths import has_files
from tidemark.streaming import ingest

SCHEMA = "id int, v string"


def deliver(spark, folder, *data):
    frame = spark.createDataFrame(list(data), SCHEMA).coalesce(1)
    files.write_parquet(frame, folder + "/landing", mode="append")


def taken(spark, folder, write=None, **options):
    out = folder + "/out"
    write = write or (lambda df, id_: keyed.write_keyed(df, out, "id", batch_id=id_))
    return landing.take_files(spark, folder + "/landing", folder + "/files", write, SCHEMA, **options)


def stored(spark, folder):
    return sorted(tuple(r) for r in keyed.read_keyed(spark, folder + "/out").collect())


def test_each_file_once_and_the_last_batch_is_moved(spark, folder):
    archive = folder + "/backup"
    assert taken(spark, folder, archive=archive) == []
    for n in range(2):
        deliver(spark, folder, (n, "a"))
        deliver(spark, folder, (n, "b"))
        assert taken(spark, folder, archive=archive) == [n]
        assert not has_files(spark, folder + "/landing")
        assert stored(spark, folder) == sorted((i, v) for i in range(n + 1) for v in "ab")
    assert taken(spark, folder, archive=archive) == []
    moved = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(archive)
    assert rows(moved) == rows(keyed.read_keyed(spark, folder + "/out"))
    steps = landing.read_manifest(spark, folder + "/files").groupBy("batch", "step").count().collect()
    assert sorted(map(tuple, steps)) == [(0, "done", 2), (0, "taken", 2), (1, "done", 2), (1, "taken", 2)]


def test_files_stay_without_an_archive(spark, folder):
    deliver(spark, folder, (1, "a"))
    assert taken(spark, folder) == [0] and taken(spark, folder) == []
    deliver(spark, folder, (2, "b"))
    assert taken(spark, folder) == [1]
    assert stored(spark, folder) == [(1, "a"), (2, "b")] and has_files(spark, folder + "/landing")


def test_run_that_dies_is_gone_on_with(spark, folder, monkeypatch):
    """Before the write, after the write, and between noting and moving; a file arrives meanwhile."""
    archive = folder + "/backup"
    deliver(spark, folder, (1, "a"))

    def dies(df, id_):
        raise RuntimeError("before")

    def writes_and_dies(df, id_):
        keyed.write_keyed(df, folder + "/out", "id", batch_id=id_)
        raise RuntimeError("after")

    for write in (dies, writes_and_dies):
        with pytest.raises(RuntimeError):
            taken(spark, folder, write, archive=archive)
    deliver(spark, folder, (2, "b"))
    monkeypatch.setattr(landing, "_move", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        taken(spark, folder, archive=archive)
    monkeypatch.undo()
    assert stored(spark, folder) == [(1, "a")]
    assert taken(spark, folder, archive=archive) == [1]
    assert stored(spark, folder) == [(1, "a"), (2, "b")] and not has_files(spark, folder + "/landing")


def test_daily_run_by_manifest(spark, folder):
    run = Run(
        keys="id", ts_col="ts", window_from="2024-01-01 00:00:00", window_to="2024-01-31 00:00:00", business_date="2024-01-31",
        versions_with={"job_id": "j"}, zone="UTC",
    )
    zones = Zones(*[f"{folder}/{n}" for n in ("landing", "processed", "structured", "mark")], folder + "/backup", folder + "/files")
    for day, done in ((2, "initial"), (3, "incremental")):
        feed = spark.createDataFrame([(1, f"2024-01-0{day} 00:00:00")], "id int, t string")
        files.write_parquet(feed.select("id", F.col("t").cast("timestamp_ntz").alias("ts")), zones.landing, mode="append")
        assert run_table(spark, zones, run) == done
        assert not has_files(spark, zones.landing)
    assert keyed.read_keyed(spark, zones.structured).count() == 2


def test_delivered_files_can_be_deleted(spark, folder):
    for n in range(3):
        deliver(spark, folder, (n, "a"))
        stream = ingest.new_files(spark, folder + "/landing", SCHEMA, delete=True)
        ingest.append_stream(stream, folder + "/out", "id", folder + "/mark")
    assert [i for i, _ in stored(spark, folder)] == [0, 1, 2]
    # Files of the last batch go once a later one commits.
    assert [r["id"] for r in spark.read.schema(SCHEMA).parquet(folder + "/landing").collect()] == [2]
    with pytest.raises(ValueError, match="not both"):
        ingest.new_files(spark, folder + "/landing", SCHEMA, archive=folder + "/a", delete=True)


def test_only_missing_data_is_no(spark, folder):
    path = folder + "/there"
    assert not catalog.exists(spark, path) and not catalog.exists(spark, "no_such_table")
    files.write_parquet(spark.createDataFrame([(1, "a")], SCHEMA), path)
    assert catalog.exists(spark, path)
    spark.createDataFrame([("x",)], "s string").write.text(folder + "/text")
    with pytest.raises(Exception) as error:  # there, and no parquet
        catalog.exists(spark, folder + "/text")
    assert not isinstance(error.value, AnalysisException) or error.value.getCondition() != "PATH_NOT_FOUND"


def test_rows_are_counted_by_the_write(spark, folder):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(1000).mapInArrow(count, "id long")
    assert files.write_counted(df, "parquet", folder + "/n") == 1000 and seen.value == 1000
    assert files.write_counted(spark.range(0), "parquet", folder + "/none") == 0
    some, number = files.observed(spark.range(50))
    files.write_parquet(some.filter("id < 7"), folder + "/some")
    assert number() == 50 and spark.read.parquet(folder + "/some").count() == 7


def test_long_table_does_not_hold_up_a_short_one(spark, folder):
    """The long run's tasks fill all cores when the short run starts; with a pool each, the short one ends first."""
    control_rows = spark.createDataFrame([("long", 1, "R"), ("short", 1, "R")], "t string, step_index int, status string")
    keyed.write_keyed(control_rows, folder + "/control", "t", known_unique=True)
    ended, started, pools = {}, threading.Event(), {}
    nap = "reflect('java.lang.Thread', 'sleep', CAST(150 + id * 0 AS BIGINT))"

    def run_one(job):
        pools[job["t"]] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        if job["t"] == "long":
            started.set()
            spark.range(0, 160, 1, 160).selectExpr(f"{nap} AS s").write.format("noop").mode("overwrite").save()
        else:
            started.wait()
            time.sleep(0.5)
            spark.range(0, 2, 1, 2).selectExpr(f"{nap} AS s").write.format("noop").mode("overwrite").save()
        ended[job["t"]] = time.time()
        return "done"

    control.run_pending(spark, folder + "/control", run_one, ["t"], {"step_index": 1, "status": "R"}, {"step_index": 2}, parallel=2)
    assert pools == {"long": "long", "short": "short"}
    assert ended["short"] < ended["long"] - 0.5
