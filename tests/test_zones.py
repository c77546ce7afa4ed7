from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from checks import queries
from helpers import rows
from tidemark.functions.times import null_timestamp
from tidemark.plans import control, zones
from tidemark.plans.daily import Zones, run_table
from tidemark.sources import files, keyed
from tidemark.sources.paths import has_files

RUN = queries._run(*queries.FIRST, op_col="op")
NEXT = queries._run(*queries.SECOND, op_col="op")
CHANGES = "user_id bigint, ts timestamp_ntz, event_id bigint, value string, op string"


def changes(spark, *data):
    return spark.createDataFrame(list(data), "user_id bigint, ts string, event_id bigint, value string, op string").select(
        "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id", "value", "op"
    )


def versions(spark, path):
    df = keyed.read_keyed(spark, path)
    return sorted((r.user_id, r.value, r.status, str(r.effective_from), str(r.effective_to), str(r.business_date)) for r in df.collect())


def test_nothing_to_do(spark, folder):
    assert zones.structure(spark, folder + "/p", folder + "/s", RUN) == "nothing"
    zones.land(changes(spark, (1, "2030-01-01 00:00:00", 1, "a", "I")), folder + "/p", RUN)
    assert zones.structure(spark, folder + "/p", folder + "/s", RUN) == "nothing"
    assert not keyed.table_exists(spark, folder + "/s")


def test_initial_then_incremental(spark, folder):
    p, s = folder + "/p", folder + "/s"
    zones.land(
        changes(
            spark,
            (1, "2024-01-01 00:00:00", 1, "a", "I"),
            (1, "2024-01-02 00:00:00", 2, "b", "U"),
            (2, "2024-01-02 00:00:00", 3, "c", "I"),
            (3, "2024-01-03 00:00:00", 4, "d", "D"),
            (None, "2024-01-03 00:00:00", 5, "e", "I"),
        ),
        p,
        replace(RUN, key_defaults={}),
    )
    assert zones.structure(spark, p, s, replace(RUN, key_defaults={})) == "initial"
    first = [
        (0, "e", "active", "2024-01-03 08:00:00", "None", "2024-01-15"),
        (1, "b", "active", "2024-01-02 08:00:00", "None", "2024-01-15"),
        (2, "c", "active", "2024-01-02 08:00:00", "None", "2024-01-15"),
    ]
    assert versions(spark, s) == first
    zones.land(
        changes(
            spark,
            (1, "2024-01-20 00:00:00", 6, "x", "U"),
            (1, "2024-01-21 00:00:00", 7, "y", "U"),
            (2, "2024-01-20 00:00:00", 8, "c", "D"),
            (3, "2024-01-20 00:00:00", 9, "z", "I"),
        ),
        p,
        replace(NEXT, key_defaults={}),
    )
    assert zones.structure(spark, p, s, replace(NEXT, key_defaults={})) == "incremental"
    want = [
        first[0],
        (1, "b", "inactive", "2024-01-02 08:00:00", "2024-01-21 08:00:00", "2024-02-01"),
        (1, "y", "active", "2024-01-21 08:00:00", "None", "2024-02-01"),
        (2, "c", "inactive", "2024-01-02 08:00:00", "2024-01-20 08:00:00", "2024-02-01"),
        (3, "z", "active", "2024-01-20 08:00:00", "None", "2024-02-01"),
    ]
    assert versions(spark, s) == want
    df = keyed.read_keyed(spark, s)
    assert "op" not in df.columns and "ts" not in df.columns and "change_date" not in df.columns


def test_equal_times_go_by_commit(spark, folder):
    p, s = folder + "/p", folder + "/s"
    zones.land(changes(spark, (1, "2024-01-01 00:00:00", 9, "first", "I")), p, RUN)
    zones.land(changes(spark, (1, "2024-01-01 00:00:00", 1, "second", "U")), p, RUN)
    zones.structure(spark, p, s, RUN)
    assert [v[1] for v in versions(spark, s)] == ["second"]


def test_run_reads_its_days_only(spark, sf_dir, folder):
    zones.land(queries.cdc(spark, sf_dir), folder, RUN)
    window = zones.changes_in_window(spark, folder, NEXT)
    days = sorted({f.split("change_date=")[1][:10] for f in window.inputFiles()})
    assert days[0] == "2024-01-15" and len(days) == 17
    whole = keyed.read_keyed(spark, folder)
    assert window.count() == whole.filter("ts > timestamp_ntz'2024-01-15'").count()
    assert zones.changes_in_window(spark, folder, queries._run("1999-01-01", "1999-01-02", "1999-01-02")).isEmpty()


def test_staging_holds_the_last_batch_only(spark, folder):
    files.write_parquet(spark.range(5), folder + "/a")
    files.write_parquet(spark.range(7), folder + "/b")
    for part in "ab":
        zones.stage_batch(spark, f"{folder}/{part}", folder + "/staging")
    staged = files.read_parquet(spark, folder + "/staging")
    assert staged.count() == 7 and staged.filter("source_file LIKE 'part-%'").count() == 7
    assert has_files(spark, folder + "/staging") and not has_files(spark, folder + "/none")


@pytest.fixture
def jobs(spark):
    data = [(1, "b1", "t1", 1, "R"), (2, "b1", "t2", 1, "R"), (3, "b2", "t3", 2, "R")]
    df = spark.createDataFrame(data, "id int, batch_name string, table_name string, step_index int, status string")
    return df.withColumn("updated_at", null_timestamp())


def test_control_join_keeps_rows_without_config(spark, jobs):
    config = spark.createDataFrame([("b1", "t1", "daily_t1")], "owner string, tab string, daily string")
    got = control.with_config(control.pending(jobs, step_index=1), config, {"batch_name": "owner", "table_name": "tab"})
    assert [(r.id, r.daily) for r in got.orderBy("id").collect()] == [(1, "daily_t1"), (2, None)]
    assert control.pending_count(jobs, step_index=1, status="R").first().n_jobs == 2


def test_update_touches_matching_rows(jobs):
    done = control.update_where(jobs, F.col("id") == 1, queries.DONE)
    assert done.dtypes == jobs.dtypes
    assert [(r.step_index, str(r.updated_at)) for r in done.orderBy("id").collect()] == [
        (2, "2024-02-01 08:00:00"),
        (1, "None"),
        (2, "None"),
    ]


def test_run_pending_marks_what_worked(spark, jobs, folder):
    keyed.write_keyed(jobs, folder, "id", known_unique=True)

    def run_one(job):
        if job["table_name"] == "t2":
            raise RuntimeError("no source")
        return f"ran {job['table_name']}"

    with pytest.raises(RuntimeError, match="no source"):
        control.run_pending(spark, folder, run_one, ["id"], queries.DUE, queries.DONE)
    state = {r.id: (r.step_index, r.updated_at is not None) for r in keyed.read_keyed(spark, folder).collect()}
    assert state == {1: (2, True), 2: (1, False), 3: (2, False)}
    assert control.run_pending(spark, folder, lambda job: "ok", ["id"], queries.DUE, queries.DONE) == {(2,): "ok"}
    assert control.run_pending(spark, folder, lambda job: "ok", ["id"], queries.DUE, queries.DONE) == {}


def test_a_failed_run_holds_back_later_ones_of_its_table(spark, jobs, folder):
    keyed.write_keyed(jobs, folder, ["batch_name", "id"], known_unique=True)
    ran = []

    def run_one(job):
        ran.append(job["id"])
        raise RuntimeError("no source")

    with pytest.raises(RuntimeError):
        control.run_pending(spark, folder, run_one, ["batch_name", "id"], queries.DUE, queries.DONE, table_by=["batch_name"])
    assert ran == [1] and keyed.read_keyed(spark, folder).filter("step_index = 1").count() == 2


def test_control_query_marks_all_due_tables(spark, sf_dir):
    got = queries.QUERIES["control_run"](spark, sf_dir)
    assert got.select("table_name").distinct().count() == 4 and got.filter("step_index <> 2").isEmpty()
    assert rows(got.filter("status = 'active'").groupBy("table_name", "user_id").count().select("count")).keys() == {(1,)}


def test_daily_run_of_one_table(spark, folder):
    where = Zones(*(f"{folder}/{z}" for z in ("landing", "processed", "structured", "mark", "backup")))
    assert run_table(spark, where, RUN) == "nothing"
    feed = changes(spark, (1, "2024-01-01 00:00:00", 1, "a", "I"), (2, "2024-01-02 00:00:00", 2, "b", "I"))
    files.write_parquet(feed, where.landing, mode="append")
    assert run_table(spark, where, RUN) == "initial"
    files.write_parquet(changes(spark, (1, "2024-01-20 00:00:00", 3, "c", "U")), where.landing, mode="append")
    assert run_table(spark, where, NEXT) == "incremental"
    want = versions(spark, where.structured)
    assert [(v[0], v[1], v[2]) for v in want] == [(1, "a", "inactive"), (1, "c", "active"), (2, "b", "active")]
    # The same run again takes in no file twice and changes no version.
    assert run_table(spark, where, NEXT) == "incremental"
    assert versions(spark, where.structured) == want
    assert keyed.read_keyed(spark, where.processed).count() == 3
    assert has_files(spark, where.backup)


def test_null_key_stops_the_run_unless_a_default_is_given(spark, folder):
    p, s = folder + "/p", folder + "/s"
    rows = [(None, "2024-01-02 00:00:00", 1, "n", "I"), (0, "2024-01-02 00:00:00", 2, "zero", "I")]
    zones.land(changes(spark, *rows), p, RUN)
    with pytest.raises(Exception, match="NULL in key"):
        zones.structure(spark, p, s, RUN)
    with pytest.raises(Exception, match="a key in use"):
        zones.structure(spark, p, s, replace(RUN, key_defaults={}))
    assert zones.structure(spark, p, s, replace(RUN, key_defaults={"user_id": -1})) == "initial"
    assert [r[:2] for r in versions(spark, s)] == [(-1, "n"), (0, "zero")]


def test_an_unrelated_run_keeps_versions_of_one_instant(spark, folder):
    p, s = folder + "/p", folder + "/s"
    run, later = (replace(r, collapse=False, tie_breaker="event_id") for r in (RUN, NEXT))
    instant = "2024-01-02 00:00:00"
    zones.land(changes(spark, (1, instant, 1, "a", "I"), (1, instant, 2, "b", "U")), p, run)
    assert zones.structure(spark, p, s, run) == "initial"
    before = versions(spark, s)
    assert [r[1] for r in before] == ["a", "b"]
    zones.land(changes(spark, (9, "2024-01-20 00:00:00", 3, "z", "I")), p, later)
    assert zones.structure(spark, p, s, later) == "incremental"
    assert [r for r in versions(spark, s) if r[0] == 1] == before


def test_a_run_that_keeps_all_changes_writes_no_copy_of_them(spark, folder, monkeypatch):
    p, s = folder + "/p", folder + "/s"
    run, later = (replace(r, collapse=False, tie_breaker="event_id") for r in (RUN, NEXT))
    day = ("2024-01-02 00:00:00", "2024-01-03 00:00:00")
    zones.land(changes(spark, (1, day[0], 1, "a", "I"), (1, day[1], 2, "b", "U"), (2, day[0], 3, "c", "I")), p, run)
    monkeypatch.setattr(zones, "shared_dir", lambda *a: pytest.fail("changes were copied"))
    assert zones.structure(spark, p, s, run) == "initial"
    assert zones.structure(spark, p, s, later) == "nothing"
    zones.land(changes(spark, (1, "2024-01-20 00:00:00", 4, "d", "D")), p, later)
    assert zones.structure(spark, p, s, later) == "incremental"
    assert [(v[0], v[1], v[2], v[4][:10]) for v in versions(spark, s)] == [
        (1, "a", "inactive", "2024-01-03"), (1, "b", "inactive", "2024-01-20"), (2, "c", "active", "None"),
    ]
