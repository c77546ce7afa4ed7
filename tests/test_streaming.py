import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import queries
from helpers import rows
from tidemark.operators import history, latest
from tidemark.operators.columns import add_column
from tidemark.operators.history import History
from tidemark.sources import files, keyed
from tidemark.streaming import ingest


@pytest.fixture
def events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def deliver(events, landing, pieces, seed=None):
    """Write events as single files, in time order or shuffled."""
    numbered = events.withColumn("n", F.ntile(pieces).over(Window.orderBy("ts")))
    order = list(range(1, pieces + 1))
    if seed is not None:
        random.Random(seed).shuffle(order)
    for n in order:
        files.write_parquet(numbered.filter(F.col("n") == n).drop("n").coalesce(1), landing, mode="append")


def test_new_files_once(spark, events, folder):
    landing = folder + "/landing"

    def run():
        stream = ingest.new_files(spark, landing, events.schema)
        ingest.append_stream(
            stream, folder + "/out", "event_id", folder + "/mark", lambda b: add_column(b, "job", "j")
        )
        return keyed.read_keyed(spark, folder + "/out").count()

    files.write_parquet(events.filter("event_type = 'view'"), landing)
    first = run()
    assert first == events.filter("event_type = 'view'").count() and run() == first
    files.write_parquet(events.filter("event_type <> 'view'"), landing, mode="append")
    assert run() == events.count() and run() == events.count()
    assert set(keyed.read_keyed(spark, folder + "/out").select("job").distinct().collect()[0]) == {"j"}


@pytest.mark.parametrize("seed,max_files", [(None, 1), (1, 1), (2, 2), (None, None)])
def test_upsert_in_any_order(spark, events, folder, seed, max_files):
    deliver(events, folder + "/landing", 4, seed)
    stream = ingest.new_files(spark, folder + "/landing", events.schema, max_files=max_files)
    ingest.upsert_stream(stream, folder + "/out", "user_id", ["ts", "event_id"], folder + "/mark")
    assert rows(keyed.read_keyed(spark, folder + "/out")) == rows(latest.keep_last(events, "user_id", ["ts", "event_id"]))


def test_retried_batch_is_written_once(spark, events, folder):
    calls = []

    def write(batch, id_):
        calls.append(id_)
        keyed.write_keyed(batch, folder + "/out", "event_id", batch_id=id_)
        if len(calls) == 1:
            raise RuntimeError("driver lost after the write")

    files.write_parquet(events, folder + "/landing")
    for _ in range(2):
        stream = ingest.new_files(spark, folder + "/landing", events.schema)
        try:
            ingest.run_available(stream, folder + "/mark", write)
        except Exception as error:
            assert "driver lost" in str(error)
    assert len(calls) == 2 and calls[0] == calls[1]
    assert keyed.read_keyed(spark, folder + "/out").count() == events.count()


def test_history_stream_equals_batch(spark, events, folder):
    spec = queries.USERS_OP
    feed = queries.cdc(spark, queries_dir(events))
    deliver(feed, folder + "/landing", 3)
    stream = ingest.new_files(spark, folder + "/landing", feed.schema, max_files=1)
    ingest.history_stream(stream, folder + "/out", spec, folder + "/mark")
    got = keyed.read_keyed(spark, folder + "/out")
    written = spark.sql(f"SHOW TBLPROPERTIES {keyed.catalog_name(folder + '/out')}").collect()
    assert {r["key"]: r["value"] for r in written}["tidemark.writes"] == "3"
    assert rows(got) == rows(history.new_versions(feed, spec))


def test_late_changes_of_a_stream_are_kept_apart(spark, folder):
    spec = History(keys="id", ts="ts", tie_breaker="seq")
    deliveries = [[(1, "b", 10, 1), (2, "c", 3, 2)], [(1, "a", 5, 3), (2, "d", 9, 4)], [(1, "x", 12, 5)]]
    for rows_ in deliveries:
        df = spark.createDataFrame(rows_, "id int, v string, ts int, seq int")
        files.write_parquet(df.coalesce(1), folder + "/landing", mode="append")
        stream = ingest.new_files(spark, folder + "/landing", df.schema)
        ingest.history_stream(stream, folder + "/out", spec, folder + "/mark", buckets=2)
    got = keyed.read_keyed(spark, folder + "/out").select("id", "v", "effective_from", "effective_to", "status")
    assert sorted(map(tuple, got.collect()), key=str) == [
        (1, "b", 10, 12, "inactive"), (1, "x", 12, None, "active"), (2, "c", 3, 9, "inactive"), (2, "d", 9, None, "active"),
    ]
    assert [tuple(r) for r in keyed.read_keyed(spark, folder + "/out-late").collect()] == [(1, "a", 5, 3)]


def queries_dir(events) -> str:
    return events.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]


def test_archive_moves_finished_files(spark, events, folder):
    for kind in ("view", "click", "error"):
        files.write_parquet(events.filter(F.col("event_type") == kind).coalesce(1), folder + "/landing", mode="append")
        stream = ingest.new_files(spark, folder + "/landing", events.schema, archive=folder + "/backup")
        ingest.append_stream(stream, folder + "/out", "event_id", folder + "/mark")
    backup = files.read_parquet(spark, folder + "/backup", events.schema, recursiveFileLookup="true")
    landing = files.read_parquet(spark, folder + "/landing", events.schema)
    # The last batch stays until another one commits after it.
    assert {r[0] for r in backup.select("event_type").distinct().collect()} == {"view", "click"}
    assert {r[0] for r in landing.select("event_type").distinct().collect()} == {"error"}
    assert rows(backup.unionByName(landing)) == rows(keyed.read_keyed(spark, folder + "/out"))
