"""Names with dots, spaces and backticks, and names in another case, work everywhere."""

from tidemark.operators import columns, history, hotkeys, joins, latest
from tidemark.operators.history import History
from tidemark.plans.history_table import merge_history
from tidemark.sources import keyed

SPEC = History(keys="Cust.ID", ts="change`d at", tie_breaker="s.eq", op="O P", status="st.at", start="fr om", end="t`o")


def log(spark, *data):
    return spark.createDataFrame(list(data), ["cust.id", "a b", "change`d at", "s.eq", "o p"])


def test_history(spark, folder):
    first = log(spark, (1, "A", 1, 1, "I"), (2, "B", 1, 2, "I"))
    second = log(spark, (1, "C", 5, 3, "U"), (2, "B", 5, 4, "D"))
    merge_history(first, folder, SPEC)
    merge_history(second, folder, SPEC)
    got = keyed.read_keyed(spark, folder)
    assert got.columns == ["cust.id", "a b", "s.eq", "fr om", "t`o", "st.at"]
    want = [(1, "A", 1, 1, 5, "inactive"), (1, "C", 3, 5, None, "active"), (2, "B", 2, 1, 5, "inactive")]
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert history.late_rows(got, first, SPEC).count() == 1
    for late in ("apply", "drop"):
        spec = History(**{**SPEC.__dict__, "late": late})
        assert history.closed_versions(got, log(spark, (1, "D", 9, 5, "U")), spec).count() == 1
        assert history.delta(got, log(spark, (1, "D", 9, 5, "U")), spec).count() == 2
    assert history.as_of(got, 3, SPEC).count() == 2


def test_upsert(spark, folder):
    for batch in (log(spark, (1, "A", 1, 1, "x")), log(spark, (1, "B", 2, 1, "y"), (2, "C", 1, 1, "x"))):
        keyed.write_keyed(batch, folder, ["CUST.ID"], ["change`d at"], ["o p"], dedup=True)
    assert sorted(tuple(r) for r in keyed.read_keyed(spark, folder).collect()) == [(1, "B", 2, 1, "y"), (2, "C", 1, 1, "x")]


def test_others(spark):
    df = log(spark, *[(i % 2, "A", i, i, "x") for i in range(20)])
    for hot_keys in (True, False):
        numbered = latest.row_number_per_key(df, "cust.id", ["change`d at"], "N o", hot_keys=hot_keys)
        assert sorted(r["N o"] for r in numbered.collect()) == sorted([*range(1, 11)] * 2)
        after = latest.lead_next(df, "cust.id", "change`d at", "s.eq", "ne.xt", hot_keys=hot_keys)
        assert sum(r["ne.xt"] is None for r in after.collect()) == 2
    assert latest.keep_last(df, "CUST.id", "change`d at").count() == 2
    assert columns.rename_columns(df, {"A B": "c.d"}).columns[1] == "c.d"
    assert columns.replace_values(df, {"A": "B"}, "a b").first()["a b"] == "B"
    assert columns.fill_null_keys(columns.cast_columns(df, {"a b": "int"}), "a b").first()["a b"] == 0
    assert columns.drop_columns(df, ["cust.id", "S.EQ"]).columns == ["a b", "change`d at", "o p"]
    assert joins.rows_touched(df, df.limit(1), "cust.id").count() == 10
