"""Operators against plain Python on random small inputs."""

import random
from dataclasses import replace

import pytest

from tidemark.operators import history, latest
from tidemark.operators.history import History
from tidemark.plans.history_table import merge_history
from tidemark.sources import keyed

LOG = "id int, v string, ts int, seq int, op string"
TABLE = "id int, v string, effective_from int, effective_to int, status string"


def random_log(rnd, n, start=0, stop=60):
    return [(rnd.randrange(8), f"v{rnd.randrange(9)}", rnd.randrange(start, stop), i, rnd.choice("IUUD")) for i in range(n)]


def model(current, log, op, late):
    """Snapshot by replaying the log row by row."""
    table = [list(r) for r in current]
    since = {r[0]: r[2] for r in current if r[4] == "active"}
    if late == "drop":
        log = [c for c in log if c[0] not in since or c[2] > since[c[0]]]
    for key, value, ts, _, code in sorted(log, key=lambda c: (c[2], c[3])):
        for row in table:
            if row[0] == key and row[4] == "active":
                row[3], row[4] = ts, "inactive"
        if not (op and code == "D"):
            table.append([key, value, ts, None, "active"])
    return sorted(map(tuple, table), key=str)


@pytest.mark.parametrize("seed", range(6))
def test_snapshot(spark, seed):
    rnd = random.Random(seed)
    current = [(i, "c", rnd.randrange(40), None, "active") for i in range(5)] + [(6, "old", 1, 2, "inactive")]
    log = random_log(rnd, 30)
    op, late = rnd.choice([None, "op"]), rnd.choice(["apply", "drop"])
    frames = spark.createDataFrame(current, TABLE), spark.createDataFrame(log, LOG)
    for hot_keys in (True, False):
        spec = History(keys="id", ts="ts", tie_breaker="seq", op=op, late=late, hot_keys=hot_keys)
        got = history.snapshot(*frames, spec)
        assert sorted((tuple(r) for r in got.collect()), key=str) == model(current, log, op, late)


@pytest.mark.parametrize("seed", range(3))
def test_history_table_over_batches(spark, folder, seed):
    rnd = random.Random(seed)
    spec = History(keys="id", ts="ts", tie_breaker="seq", op="op")
    # Several changes of a key at one instant: the tie-breaker tells their versions apart.
    whole = random_log(rnd, 90, 0, 30)
    table = []
    for low, high in ((0, 10), (10, 20), (20, 30)):
        batch = [c for c in whole if low <= c[2] < high]
        merge_history(spark.createDataFrame(batch, LOG), folder, spec)
        table = model(table, batch, "op", "apply")
        stored = keyed.read_keyed(spark, folder).select("id", "v", "effective_from", "effective_to", "status")
        assert sorted((tuple(r) for r in stored.collect()), key=str) == table


@pytest.mark.parametrize("seed", range(4))
def test_upserts(spark, folder, seed):
    rnd = random.Random(seed)
    parts = rnd.choice([[], ["part"]])
    model_rows = {}
    for _ in range(4):
        batch = [(rnd.randrange(12), rnd.choice("abc"), rnd.randrange(10), rnd.randrange(10**6)) for _ in range(8)]
        df = spark.createDataFrame(batch, "k int, part string, ts int, v int")
        keyed.write_keyed(df, folder, "k", ["ts", "v"], parts, dedup=True)
        for row in batch:
            known = model_rows.get(row[0])
            if known is None or (row[2], row[3]) >= (known[2], known[3]):
                model_rows[row[0]] = row
        assert sorted(tuple(r) for r in keyed.read_keyed(spark, folder).collect()) == sorted(model_rows.values())


@pytest.mark.parametrize("seed", range(3))
def test_order_within_key(spark, seed):
    rnd = random.Random(seed)
    data = [(rnd.choice([None, 1, 2]), rnd.choice([None, *range(6)]), i) for i in range(40)]
    df = spark.createDataFrame(data, "k int, ts int, id int")
    groups = {}
    for row in sorted(data, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        groups.setdefault(row[0], []).append(row)
    numbers = {r.id: r.n for r in latest.row_number_per_key(df, "k", "ts,id", "n").collect()}
    nexts = {r.id: r.nx for r in latest.lead_next(df, "k", "ts,id", "id", "nx").collect()}
    for rows in groups.values():
        assert [numbers[r[2]] for r in rows] == list(range(1, len(rows) + 1))
        assert [nexts[r[2]] for r in rows] == [r[2] for r in rows[1:]] + [None]
    last = {r.k: r.id for r in latest.keep_last(df, "k", "ts,id").collect()}
    first = {r.k: r.id for r in latest.keep_first(df, "k", "ts,id").collect()}
    assert last == {k: rows[-1][2] for k, rows in groups.items()}
    assert first == {k: rows[0][2] for k, rows in groups.items()}


def whole_history(spark, log, spec):
    """All changes at once, without the deletes that a history with late inserts keeps."""
    names = ["id", "v", "seq", "effective_from", "effective_to", "status"]
    made = history.new_versions(spark.createDataFrame(log, LOG), spec).filter("status <> 'removed'")
    return sorted((tuple(r) for r in made.select(*names).collect()), key=str), names


@pytest.mark.parametrize("seed", range(4))
def test_late_changes_in_any_order_make_the_same_history(spark, seed):
    rnd = random.Random(seed)
    log = random_log(rnd, 60, 0, 25)
    spec = History(keys="id", ts="ts", tie_breaker="seq", op=rnd.choice(["op", "op", None]), late="insert", hot_keys=seed % 2 == 0)
    want, names = whole_history(spark, log, spec)
    usual = history.new_versions(spark.createDataFrame(log, LOG), replace(spec, late="apply")).select(*names)
    assert want == sorted((tuple(r) for r in usual.collect()), key=str)
    rnd.shuffle(log)
    cuts = sorted(rnd.sample(range(1, 60), 3))
    table = history.new_versions(spark.createDataFrame(log[: cuts[0]], LOG), spec)
    for a, b in zip(cuts, [*cuts[1:], 60]):
        table = spark.createDataFrame(table.collect(), table.schema)
        table = history.snapshot(table, spark.createDataFrame(log[a:b], LOG), spec)
    got = table.filter("status <> 'removed'").select(*names)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


@pytest.mark.parametrize("seed", range(2))
def test_history_table_with_late_inserts(spark, folder, seed):
    rnd = random.Random(100 + seed)
    log = random_log(rnd, 50, 0, 25)
    spec = History(keys="id", ts="ts", tie_breaker="seq", op="op", late="insert", hot_keys=False)
    want, names = whole_history(spark, log, spec)
    rnd.shuffle(log)
    batches = [log[:10], log[10:30], log[20:40], log[38:], log[5:9]]  # some changes arrive twice
    for i, batch in enumerate(batches):
        merge_history(spark.createDataFrame(batch, LOG), folder, spec, ("feed", i), buckets=2, slices=2)
    got = keyed.read_keyed(spark, folder).filter("status <> 'removed'").select(*names)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    at = history.as_of(keyed.read_keyed(spark, folder), 12, spec)
    assert sorted(r["id"] for r in at.collect()) == sorted(w[0] for w in want if w[3] <= 12 and (w[4] is None or w[4] > 12))


def test_late_inserts_need_one_order_column(spark):
    with pytest.raises(ValueError, match="tie_breaker"):
        History(keys="id", ts=["ts", "seq"], late="insert")
    with pytest.raises(ValueError, match="apply, drop or insert"):
        History(keys="id", ts="ts", late="other")
