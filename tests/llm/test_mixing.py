import pytest
from pyspark.sql import functions as F

from conftest import documents, rows_of
from tidemark.llm import mixing


def plain_targets(sizes, weights, share=1.5, most=2.0):
    """Cap and share again, one round after the other."""
    goal, capped = share * sum(sizes.values()), {}
    while True:
        open_ = [s for s in sizes if s not in capped and weights[s] > 0]
        total = sum(weights[s] for s in open_)
        left = goal - sum(capped.values())
        targets = {s: left * weights[s] / total for s in open_}
        over = {s: most * sizes[s] for s in open_ if targets[s] > most * sizes[s]}
        if not over:
            return {**{s: 0.0 for s in sizes}, **targets, **capped}
        capped |= over


@pytest.mark.parametrize(
    "sizes", [[100, 100, 100], [1000, 10, 5], [10, 1000, 1000, 3], [0, 5, 0], [7], [1, 2, 4, 8, 16, 32, 64, 128]]
)
def test_targets(spark, sizes):
    named = {f"s{i}": n for i, n in enumerate(sizes)}
    weights = {f"s{i}": [5, 2, 1][i % 3] for i in range(len(sizes))}
    frame = spark.createDataFrame([(s, n, float(weights[s])) for s, n in named.items()], "source string, source_size long, weight double")
    found = {r["source"]: r["target"] for r in mixing.with_targets(frame).collect()}
    assert found == pytest.approx(plain_targets(named, weights))


def test_sources_by_code_point_null_last(spark):
    names = ["b", None, "é", "a", "Z", "漢", "", "ab"]
    frame = spark.createDataFrame([(n, 1) for n in names], "source string, source_size long").repartition(3)
    ranked = {r["source"]: r["rank"] for r in mixing.ranked_sources(frame).collect()}
    order = sorted((n for n in names if n is not None)) + [None]
    assert ranked == {n: i for i, n in enumerate(order)}


def test_copies(docs):
    mix = mixing.mixed_documents(docs, [5, 2, 1])
    taken = {}
    for doc_id, text in rows_of(mix, "doc_id", "text"):
        taken[doc_id, text] = taken.get((doc_id, text), 0) + 1
    rows = {}
    for doc_id, text, *_ in documents():
        rows[doc_id, text] = rows.get((doc_id, text), 0) + 1
    assert set(taken) <= set(rows) and all(n <= 2 * rows[key] for key, n in taken.items())
    again = mixing.mixed_documents(docs.repartition(7), [5, 2, 1])
    assert rows_of(again, "doc_id") == rows_of(mix, "doc_id")


def test_taken_near_target(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    docs = docs.select("doc_id", "text", "source", mixing.word_count().alias("size"))
    check_taken(docs)


def check_taken(docs):
    """Each source within five standard deviations of its draws; all together close."""
    targets = mixing.with_targets(mixing.cyclic_weights(mixing.source_sizes(docs), [5, 2, 1]))
    rate = F.col("target") / F.col("source_size")
    spread = F.sum(F.col("size") * F.col("size") * (rate - F.floor(rate)) * (1 - rate + F.floor(rate)))
    rows = mixing.planned(docs, targets).groupBy("source", "target").agg(
        F.sum(F.col("size") * F.col("copies")).alias("taken"), F.sqrt(spread).alias("sd")
    ).collect()
    assert sum(r["taken"] for r in rows) == pytest.approx(sum(r["target"] for r in rows), rel=0.1)
    for r in rows:
        assert abs(r["taken"] - r["target"]) <= 5 * r["sd"] + 1


@pytest.mark.parametrize("doc_id", ["CAST(NULL AS BIGINT)", "CAST(7 AS BIGINT)"])
def test_null_and_repeated_ids_draw_apart(spark, sf_dir, doc_id):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    docs = docs.dropDuplicates(["text"]).selectExpr(f"{doc_id} AS doc_id", "text", "source")
    check_taken(docs.withColumn("size", mixing.word_count()))


def test_plan_keeps_columns_of_its_own_names(spark):
    frame = spark.createDataFrame([(1, "a b", "x", 2, "mine")], "doc_id long, text string, source string, size long, _source string")
    targets = spark.createDataFrame([("x", 2, 1.0, 4.0)], "source string, source_size long, weight double, target double")
    row = mixing.planned(frame, targets).first()
    assert row["_source"] == "mine" and row["copies"] == 2


def test_many_sources_without_broadcast(docs, monkeypatch):
    mix = rows_of(mixing.mixed_documents(docs, [5, 2, 1]), "doc_id")
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 1)
    assert rows_of(mixing.mixed_documents(docs, [5, 2, 1]), "doc_id") == mix


def test_columns_stay(docs):
    mix = mixing.mixed_documents(docs, [5, 2, 1])
    assert mix.columns == docs.columns
    assert {tuple(r) for r in mix.select("size", "copies", "weight").collect()} == {("size", "copies", "weight")}


def test_empty_table(no_docs):
    assert mixing.mixed_documents(no_docs, [5, 2, 1]).count() == 0
