"""Type-2 history on small hand-made frames, and its properties on events."""

import random
from dataclasses import replace
from types import SimpleNamespace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import queries
from helpers import plan, rows
from tidemark.operators import history, joins
from tidemark.operators.history import History
from tidemark.plans import history_table
from tidemark.plans.history_table import merge_history, read_active, write_versions
from tidemark.sources import keyed

CURRENT = [(1, "A", 1, None, "active"), (2, "Z", 1, None, "active"), (1, "Q", 0, 1, "inactive")]
SPEC = History(keys="id", ts="ts")
SPEC_OP = History(keys="id", ts="ts", op="op")


@pytest.fixture
def current(spark):
    return spark.createDataFrame(CURRENT, "id int, v string, effective_from int, effective_to int, status string")


def log(spark, *data, schema="id int, v string, ts int, op string"):
    return spark.createDataFrame(list(data), schema)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_several_changes_close_once(spark, current):
    batch = log(spark, (1, "B", 5, "U"), (1, "C", 9, "U"))
    want = [(1, "A", 1, 5, "inactive"), (1, "B", 5, 9, "inactive"), (1, "C", 9, None, "active")]
    assert got(history.delta(current, batch, SPEC)) == want
    assert got(history.closed_versions(current, batch, SPEC)) == want[:1]
    assert got(history.new_versions(batch, SPEC, current.schema)) == want[1:]
    rest = [CURRENT[1], CURRENT[2]]
    assert got(history.snapshot(current, batch, SPEC)) == sorted(want + rest, key=str)
    assert [tuple(r) for r in history.first_change(batch, SPEC).collect()] == [(1, 5)]


def test_delete_closes_and_opens_nothing(spark, current):
    batch = log(spark, (1, "B", 5, "U"), (1, "B", 9, "D"))
    want = [(1, "A", 1, 5, "inactive"), (1, "B", 5, 9, "inactive")]
    assert got(history.delta(current, batch, SPEC_OP)) == want
    # Without an operation column a delete is a change like any other.
    assert got(history.delta(current, batch, SPEC)) == want + [(1, "B", 9, None, "active")]


def test_reinsert_leaves_a_gap(spark, current):
    batch = log(spark, (1, "B", 5, "D"), (1, "C", 9, "I"))
    assert got(history.delta(current, batch, SPEC_OP)) == [(1, "A", 1, 5, "inactive"), (1, "C", 9, None, "active")]


def test_late_change(spark, current):
    batch = log(spark, (1, "B", 0, "U"))
    assert got(history.delta(current, batch, SPEC)) == [(1, "A", 1, 0, "inactive"), (1, "B", 0, None, "active")]
    drop = History(keys="id", ts="ts", late="drop")
    assert got(history.delta(current, batch, drop)) == [] == got(history.closed_versions(current, batch, drop))
    later = log(spark, (1, "B", 0, "U"), (1, "C", 7, "U"))
    assert got(history.closed_versions(current, later, drop)) == [(1, "A", 1, 7, "inactive")]
    assert got(history.snapshot(current, batch, drop)) == got(current)
    assert got(history.late_rows(current, batch, drop)) == [(1, "B", 0, "U")]
    new_key = log(spark, (3, "N", 0, "U"))
    assert got(history.delta(current, new_key, drop)) == [(3, "N", 0, None, "active")]


def test_null_key_is_rejected(spark, current):
    batch = log(spark, (None, "B", 5, "U"))
    with pytest.raises(PySparkException, match="fill_null_keys"):
        history.delta(current, batch, SPEC).collect()


def test_columns_go_by_name(spark, current):
    batch = log(spark, (5, "U", "B", 1, "extra"), schema="ts int, op string, V string, id int, more string")
    assert got(history.delta(current, batch, SPEC)) == [(1, "A", 1, 5, "inactive"), (1, "B", 5, None, "active")]
    with pytest.raises(ValueError, match="no such column"):
        history.delta(current, batch.drop("V"), SPEC)


def test_start_may_be_the_ordering_column(spark, current):
    spec = History(keys=["id"], ts="effective_from")
    batch = log(spark, (1, "B", 5), schema="id int, v string, effective_from int")
    assert got(history.delta(current, batch, spec)) == [(1, "A", 1, 5, "inactive"), (1, "B", 5, None, "active")]


def test_tie_breaker_orders_equal_times(spark, current):
    spec = History(keys="id", ts="ts", tie_breaker="seq")
    batch = log(spark, (1, "C", 5, 2), (1, "B", 5, 1), schema="id int, v string, ts int, seq int")
    want = [(1, "A", 1, 5, "inactive"), (1, "B", 5, 5, "inactive"), (1, "C", 5, None, "active")]
    assert got(history.delta(current, batch, spec)) == want


def test_initial_load_and_as_of(spark, current):
    batch = log(spark, (1, "B", 5, "U"), (1, "C", 9, "U"), (2, "D", 3, "D"))
    first = history.initial_load(batch, SPEC_OP, current.schema)
    assert got(first) == [(1, "C", 9, None, "active")]
    whole = history.snapshot(current, batch, SPEC_OP)
    assert [r.v for r in history.as_of(whole, 5, SPEC_OP).collect()] == ["B"]
    assert sorted(r.v for r in history.as_of(whole, 1, SPEC_OP).collect()) == ["A", "Z"]


def test_rows_of_unknown_status_survive(spark, current):
    odd = current.union(spark.createDataFrame([(1, "?", 3, None, None)], current.schema))
    batch = log(spark, (1, "B", 5, "U"))
    for limit in ("10MB", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        assert (1, "?", 3, None, None) in got(history.snapshot(odd, batch, SPEC))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_one_shuffle_for_the_merge(spark, sf_dir, folder):
    write_versions(queries.user_history(spark, sf_dir), folder, queries.USERS)
    stored = keyed.read_keyed(spark, folder)
    batch = queries.user_log(spark, sf_dir)
    text = plan(history.snapshot(stored, batch, queries.USERS))
    assert text.count("Exchange") == 1 and "Join" not in text


def test_hot_key(spark):
    rnd = random.Random(3)
    data = [(rnd.choice([1, 1, 1, rnd.randrange(2, 200)]), f"v{i}", rnd.randrange(50, 900), rnd.choice("IUUD"), i) for i in range(2500)]
    batch = spark.createDataFrame(data, "id int, v string, ts int, op string, seq int").repartition(5)
    now = spark.createDataFrame(
        [(i, f"c{i}", i % 7, None, "active") for i in range(150)],
        "id int, v string, effective_from int, effective_to int, status string",
    )
    spec = History(keys="id", ts="ts", tie_breaker="seq", op="op")
    for operator in (history.delta, history.snapshot):
        sliced = operator(now, batch, spec)
        assert "slice" in plan(sliced)
        assert rows(sliced) == rows(operator(now, batch, replace(spec, hot_keys=False)))


def test_hot_key_with_late_changes(spark):
    rnd = random.Random(5)
    data = [(rnd.choice([1, 1, rnd.randrange(2, 99)]), f"v{i}", rnd.randrange(900), i) for i in range(1500)]
    batch = spark.createDataFrame(data, "id int, v string, ts int, seq int").repartition(5)
    now = spark.createDataFrame(
        [(i, f"c{i}", 400, None, "active") for i in range(60)],
        "id int, v string, effective_from int, effective_to int, status string",
    )
    spec = History(keys="id", ts="ts", tie_breaker="seq", late="drop")
    sliced, plain = (rows(history.delta(now, batch, replace(spec, hot_keys=hot))) for hot in (True, False))
    kept = [d for d in data if d[0] >= 60 or d[2] > 400]
    assert sliced == plain and sum(plain.values()) == len(kept) + len({d[0] for d in kept if d[0] < 60})
    assert history.late_rows(now, batch, spec).count() == len(data) - len(kept)


def test_versions_of_a_key_neither_overlap_nor_leave_gaps(spark, sf_dir):
    whole = queries.QUERIES["scd2_snapshot"](spark, sf_dir)
    stored, batch = queries.user_history(spark, sf_dir), queries.user_log(spark, sf_dir)
    assert whole.count() == stored.count() + batch.count()
    assert whole.filter("status = 'active'").groupBy("user_id").count().filter("count > 1").isEmpty()
    order = Window.partitionBy("user_id").orderBy("effective_from")
    after = whole.withColumn("after", F.lead("effective_from").over(order))
    assert after.filter(~F.col("after").eqNullSafe(F.col("effective_to"))).isEmpty()


def test_table_equals_snapshot_and_rerun_changes_nothing(spark, sf_dir, folder):
    stored, batch = queries.user_history(spark, sf_dir), queries.user_log(spark, sf_dir)
    write_versions(stored, folder, queries.USERS)
    merge_history(batch, folder, queries.USERS)
    want = rows(history.snapshot(stored, batch, queries.USERS))
    assert rows(keyed.read_keyed(spark, folder)) == want
    merge_history(batch, folder, queries.USERS)
    assert rows(keyed.read_keyed(spark, folder)) == want


@pytest.mark.parametrize("stored", [False, True])
def test_stored_changes_are_read_where_they_lie(spark, folder, monkeypatch, stored):
    data = [(1, "A", 1), (2, "Z", 1), (1, "B", 5), (1, "B", 5), (2, None, 7), (3, "N", 9)]
    spark.createDataFrame(data, "id int, v string, ts int").write.parquet(folder + "/log")
    log = spark.read.parquet(folder + "/log")
    copies = []
    real = history_table.shared_dir
    monkeypatch.setattr(history_table, "shared_dir", lambda *a: copies.append(a) or real(*a))
    for batch in ("ts < 5", "ts >= 5"):
        merge_history(log.filter(batch), folder + "/table", SPEC, stored=stored)
    assert len(copies) == (not stored)
    found = {(r.id, r.v, r.effective_from, r.effective_to) for r in keyed.read_keyed(spark, folder + "/table").collect()}
    assert found == {(1, "A", 1, 5), (1, "B", 5, None), (2, "Z", 1, 7), (2, None, 7, None), (3, "N", 9, None)}


def test_merge_lists_active_folders_only(spark, sf_dir, folder):
    write_versions(queries.user_history(spark, sf_dir), folder, queries.USERS)
    active = read_active(spark, folder, queries.USERS)
    assert {f.split("status=")[1].split("/")[0] for f in active.inputFiles()} == {"active"}
    assert "PartitionFilters: [isnotnull(status" in plan(active)
    assert rows(active) == rows(keyed.read_keyed(spark, folder).filter("status = 'active'"))


def test_ended_versions_are_never_rewritten(spark, sf_dir, folder):
    write_versions(queries.user_history(spark, sf_dir), folder, queries.USERS)
    before = set(keyed.read_keyed(spark, folder).inputFiles())
    merge_history(queries.user_log(spark, sf_dir), folder, queries.USERS)
    after = set(keyed.read_keyed(spark, folder).inputFiles())
    assert {f.split("status=")[1].split("/")[0] for f in before & after} == {"inactive"}
    assert {f.split("status=")[1].split("/")[0] for f in before - after} == {"active"}


def test_only_versions_the_batch_can_meet_are_read(spark, folder, monkeypatch):
    schema = "id int, v string, ts int"
    for batch in ([(1, "A", 1), (2, "Z", 1)], [(1, "B", 5)], [(1, "C", 9), (3, "N", 9)], [(1, "D", 12)]):
        merge_history(spark.createDataFrame(batch, schema), folder, SPEC)
    seen = []
    real = keyed._joined
    monkeypatch.setattr(keyed, "_joined", lambda old, *a: seen.append(plan(old)) or real(old, *a))
    merge_history(spark.createDataFrame([(2, "Y", 15)], schema), folder, SPEC)
    assert "(status" in seen[0] and "(status" in seen[1]
    assert "PushedFilters: [IsNotNull(effective_from), GreaterThanOrEqual(effective_from,15)]" in seen[1]
    ids = {(r.id, r.v, r.effective_from, r.effective_to) for r in keyed.read_keyed(spark, folder).collect()}
    assert ids == {
        (1, "A", 1, 5), (1, "B", 5, 9), (1, "C", 9, 12), (1, "D", 12, None),
        (2, "Z", 1, 15), (2, "Y", 15, None), (3, "N", 9, None),
    }


def test_late_version_replaces_the_stored_one_with_its_start(spark, folder):
    schema = "id int, v string, ts int"
    for batch in ([(1, "A", 1)], [(1, "B", 5)], [(1, "C", 9)], [(1, "B2", 5)]):
        merge_history(spark.createDataFrame(batch, schema), folder, SPEC)
    rows_now = sorted((r.v, r.effective_from, r.effective_to) for r in keyed.read_keyed(spark, folder).collect() if r.v != "B2")
    assert rows_now == [("A", 1, 5), ("C", 9, 5)]
    assert keyed.read_keyed(spark, folder).filter("effective_from = 5").count() == 1


def test_spec_is_checked():
    with pytest.raises(ValueError):
        History(keys="", ts="t")
    with pytest.raises(ValueError):
        History(keys="k", ts="t", late="maybe")
    spec = History(keys="a, b", ts="t", tie_breaker="s, u")
    assert spec.record_keys(SimpleNamespace(columns=["a", "b", "S"])) == ["a", "b", "effective_from", "s"]


def test_ties_do_not_depend_on_row_order(spark, current):
    data = [(1, f"v{i}", 5, "U") for i in range(8)] + [(2, f"w{i}", i // 3 + 2, "U") for i in range(9)]
    found = set()
    for seed in range(3):
        random.Random(seed).shuffle(data)
        batch = log(spark, *data).repartition(4)
        results = [history.new_versions(batch, SPEC, current.schema), history.delta(current, batch, SPEC), history.snapshot(current, batch, SPEC)]
        found.add(tuple(str(sorted(got(r), key=str)) for r in results))
    assert len(found) == 1


def test_null_keys_stop_all_operators(spark, current):
    batch = log(spark, (1, "B", 5, "U"), (None, "N", 5, "U"))
    for operator in (history.closed_versions, history.late_rows, history.delta, history.snapshot):
        with pytest.raises(PySparkException, match="NULL in key"):
            operator(current, batch, SPEC).collect()
    with pytest.raises(PySparkException, match="NULL in key"):
        history.first_change(batch, SPEC).collect()
