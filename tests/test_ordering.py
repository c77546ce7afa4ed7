"""Keep last/first, row numbers, next value; also with one key holding most rows."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from tidemark.operators import hotkeys, latest

KEYS = [("k", 1, "a", 0), ("k", 2, "b", 0), ("j", None, "c", 0), ("j", 5, "d", 0), (None, 1, "e", 0), (None, 2, "f", 0)]


@pytest.fixture
def keys(spark):
    return spark.createDataFrame(KEYS, "k string, ts int, v string, rank int")


def test_keep_last_and_first(keys):
    last = latest.keep_last(keys, "k", "ts")
    assert last.columns == ["k", "ts", "v", "rank"]
    assert sorted(r.v for r in last.collect()) == ["b", "d", "f"]
    assert sorted(r.v for r in latest.keep_first(keys, "K", "TS").collect()) == ["a", "c", "e"]


def test_keep_last_takes_sort_expressions(keys):
    assert sorted(r.v for r in latest.keep_last(keys, ["k"], [F.desc("ts")]).collect()) == ["b", "d", "f"]
    assert sorted(r.v for r in latest.keep_last(keys, ["k"], [F.asc("ts")]).collect()) == ["a", "c", "e"]


def test_ties_do_not_depend_on_row_order(spark):
    data = [("k", 1, i, {"m": i}) for i in range(50)]
    found = set()
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k string, ts int, seq int, m map<string,int>").repartition(5)
        found.add(latest.keep_last(df, "k", "ts").first().seq)
    assert len(found) == 1
    assert latest.keep_last(df, "k", ["ts", "seq"], unique_order=True).first().seq == 49


def test_keep_last_limits_groups_before_the_shuffle(spark, sf_dir):
    df = latest.keep_last(spark.read.parquet(f"{sf_dir}/orders.parquet"), "o_custkey", ["o_orderdate", "o_orderkey"])
    text = plan(df)
    assert "Partial" in text and "Final" in text and text.count("WindowGroupLimit") == 2
    assert text.count("Exchange hashpartitioning") == 1


def skewed(spark):
    """One key with two thirds of the rows, ties in time, one instant with a quarter of them."""
    rnd = random.Random(7)
    data = []
    for i in range(3000):
        key = rnd.choice(["hot", "hot", f"c{rnd.randrange(200)}"])
        ts = rnd.choice([None, 5, rnd.randrange(1000), rnd.randrange(1000)])
        data.append((None if key == "c7" else key, ts, i, rnd.choice([None, i])))
    return spark.createDataFrame(data, "k string, ts int, id int, value int").repartition(6)


@pytest.mark.parametrize("ascending", [True, False])
def test_row_number_with_hot_key(spark, ascending):
    df = skewed(spark)
    plain = latest.row_number_per_key(df, "k", ["ts", "id"], "n", ascending, hot_keys=False)
    sliced = latest.row_number_per_key(df, "k", ["ts", "id"], "n", ascending)
    assert "slice" in plan(sliced) and "slice" not in plan(plain)
    assert plain.dtypes == sliced.dtypes
    assert rows(plain) == rows(sliced)


def test_lead_with_hot_key(spark):
    df = skewed(spark)
    plain = latest.lead_next(df, "k", ["ts", "id"], "value", "nx", hot_keys=False)
    sliced = latest.lead_next(df, "k", ["ts", "id"], "value", "nx")
    assert "slice" in plan(sliced)
    assert rows(plain) == rows(sliced)


def test_hot_key_is_spread(spark):
    df = skewed(spark)
    cuts = hotkeys.find_cuts(df, ["k"], ["ts", "id"])
    assert cuts.count() == 1
    sizes = hotkeys.with_slices(df, ["k"], ["ts", "id"], cuts).filter("k = 'hot'").groupBy(hotkeys.SLICE).count()
    found = [r["count"] for r in sizes.collect()]
    assert len(found) >= 4 and max(found) < 2.5 * sum(found) / len(found)


def test_slices_spread_also_when_rows_come_spread_by_key(spark):
    df = skewed(spark).repartition("k")
    text = plan(latest.lead_next(df, "k", ["ts", "id"], "value", "nx"))
    window = text.index("Window [lead")
    assert "hashpartitioning(k#" in text and ", __tm_slice#" in text[window:].split("Exchange hashpartitioning(")[1].split(")")[0]


def test_no_cuts_without_hot_keys(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    assert hotkeys.find_cuts(orders, ["o_custkey"], ["o_orderdate"]) is None


def test_string_order_can_be_cut(spark):
    df = skewed(spark).withColumn("s", F.concat(F.lit("x"), F.col("id").cast("string")))
    plain = latest.lead_next(df, "k", "s", "s", "nx", hot_keys=False)
    assert rows(plain) == rows(latest.lead_next(df, "k", "s", "s", "nx"))


@pytest.mark.parametrize(
    "order",
    [
        "CAST(ts AS timestamp)", "CAST(ts AS timestamp_ntz)", "CAST(CAST(ts AS timestamp) AS date)",
        "CAST(ts AS decimal(12, 2)) / 7", "CASE WHEN ts % 9 = 0 THEN double('NaN') ELSE double(ts) / 3 END",
        "CAST(CAST(ts AS string) AS binary)", "struct(ts % 5 AS a, ts AS b)", "ts > 500",
    ],
)
def test_hot_null_key_and_orders_of_all_types(spark, order):
    df = skewed(spark).withColumn("k", F.when(F.col("k") != "hot", F.col("k")))
    df = df.withColumn("at", F.expr(order.replace("CAST(ts AS timestamp", "CAST(timestamp_seconds(ts) AS timestamp")))
    results = []
    for hot_keys in (True, False):
        numbered = latest.row_number_per_key(df, "k", ["at", "id"], "n", hot_keys=hot_keys)
        after = latest.lead_next(df, "k", ["at", "id"], "id", "nx", hot_keys=hot_keys)
        assert ("__tm_slice" in plan(numbered)) == hot_keys
        results.append((rows(numbered, "id", "n"), rows(after, "id", "nx")))
    assert results[0] == results[1]


def test_ties_in_windows_do_not_depend_on_row_order(spark):
    """Rows of one place in an order get the same numbers and successors however they lie, cut or not."""
    data = [("k", i // 10, i) for i in range(60)] + [("j", 1, i) for i in range(20)]
    found = set()
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k string, ts int, id int").repartition(5)
        for hot_keys in (True, False):
            numbered = rows(latest.row_number_per_key(df, "k", "ts", "n", hot_keys=hot_keys))
            after = rows(latest.lead_next(df, "k", "ts", "id", "nx", hot_keys=hot_keys))
            found.add((frozenset(numbered.items()), frozenset(after.items())))
    assert len(found) == 1


def test_cost_of_finding_a_slice_grows_with_the_root_of_their_number(spark):
    """Compared points per row: the coarse ones and one step of the others."""
    n = 1000
    step = -(-(n**0.5) // 1)
    assert n / step + step < 70
    cuts = spark.range(1).selectExpr(
        "xxhash64('a') AS __tm_hash", f"transform(sequence(1, {n - 1}), i -> named_struct('o0', i * 10)) AS __tm_cuts",
        f"{int(step)} AS __tm_step",
    )
    cuts = cuts.withColumn("__tm_coarse", F.expr("filter(__tm_cuts, (c, i) -> (i + 1) % __tm_step = 0)"))
    df = spark.range(0, 12_000).selectExpr("'a' AS k", "CAST(id AS int) AS ts")
    sliced = hotkeys.with_slices(df, ["k"], ["ts"], cuts)
    wrong = sliced.filter(F.col(hotkeys.SLICE) != F.least(F.lit(n - 1), F.greatest(F.lit(0), F.ceil(F.col("ts") / 10) - 1)))
    assert wrong.count() == 0


def test_slices_are_found_by_compiled_comparisons(spark):
    """No function over an array of cut points runs for each row."""
    df = skewed(spark)
    sliced = hotkeys.with_slices(df, ["k"], ["ts", "id"], hotkeys.find_cuts(df, ["k"], ["ts", "id"]))
    assert sliced.count() == df.count() and "filter(" not in plan(sliced)


def test_repeated_cut_points_leave_empty_slices(spark):
    """One place with most of the rows makes equal cut points; each row is still in one slice."""
    df = spark.range(4000).selectExpr("'a' AS k", "IF(id % 4 = 0, id, 7) AS ts", "id")
    cuts = hotkeys.find_cuts(df, ["k"], ["ts"])
    sliced = hotkeys.with_slices(df, ["k"], ["ts"], cuts)
    assert sliced.filter(f"{hotkeys.SLICE} IS NOT NULL").count() == 4000 and sliced.count() == 4000
    ends = sliced.groupBy(hotkeys.SLICE).agg(F.min("ts").alias("a"), F.max("ts").alias("b")).orderBy(hotkeys.SLICE).collect()
    assert all(x.b < y.a for x, y in zip(ends, ends[1:])) and 1 < len(ends) < 8
