import numpy as np
import pytest

from conftest import documents
from tidemark.llm import sharding
from tidemark.llm.sharding import fisher_yates, sharded, write_shards


@pytest.mark.parametrize("bucket_bytes", [1 << 24, 3000])
def test_even_shards_of_all_rows(docs, monkeypatch, bucket_bytes):
    monkeypatch.setattr(sharding, "BUCKET_BYTES", bucket_bytes)
    rows = sharded(docs, 4).collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in rows) == sorted((str(d), str(t)) for d, t, *_ in documents())
    slots = {}
    for row in rows:
        slots.setdefault(row["shard"], []).append(row["slot"])
    assert sorted(slots) == [0, 1, 2, 3]
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_same_order_however_rows_lie(docs):
    def order(frame):
        return sorted((r["shard"], r["slot"], r["doc_id"] or -1, r["text"] or "") for r in frame.collect())

    assert order(sharded(docs, 4)) == order(sharded(docs.repartition(7, "text"), 4))
    assert order(sharded(docs, 4, seed=1)) != order(sharded(docs, 4, seed=2))


def test_columns_of_any_names_stay(docs):
    rows = sharded(docs, 4)
    assert set(docs.columns) - {"shard", "slot"} <= set(rows.columns)
    assert {(r["_bucket"], r["_tie"]) for r in rows.select("_bucket", "_tie").collect()} == {("_bucket", "_tie")}


def test_equals_plain_version(spark, monkeypatch):
    """Buckets in order, each by Fisher and Yates, dealt to the shards in turn."""
    monkeypatch.setattr(sharding, "BUCKET_BYTES", 1000)
    rows = [(d, t) for d, t, *_ in documents() if d is not None and len(t or "") < 2000]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    hashed = frame.selectExpr("doc_id", "text", "xxhash64(20000, doc_id, crc32(text)) AS h", "xxhash64(doc_id, text) AS tie").collect()
    n = sum(len((t or "").encode()) for _, t in rows) // 1000 + 1
    buckets = [sorted((r for r in hashed if r["h"] % n == b), key=lambda r: r["tie"]) for b in range(n)]
    whole = [own[i] for b, own in enumerate(buckets) for i in fisher_yates(len(own), 20_000, b).tolist()]
    want = sorted((r["doc_id"], r["text"] or "", i % 4, i // 4) for i, r in enumerate(whole))
    got = sorted((r["doc_id"], r["text"] or "", r["shard"], r["slot"]) for r in sharded(frame, 4).collect())
    assert n > 3 and got == want


def test_permutations():
    assert sorted(fisher_yates(100, 1, 2)) == list(range(100))
    first = np.array([fisher_yates(3, seed, 0)[0] for seed in range(3000)])
    assert abs(np.bincount(first, minlength=3) / 3000 - 1 / 3).max() < 0.05


def test_order_is_random(spark):
    docs = spark.range(2000).selectExpr("id AS doc_id", "repeat('w ', 50) AS text")
    rows = sorted((r["slot"], r["shard"], r["doc_id"]) for r in sharded(docs, 5).collect())
    ids = np.array([r[2] for r in rows])
    assert abs(np.corrcoef(ids[:-1], ids[1:])[0, 1]) < 0.1 and abs(np.corrcoef(ids, np.arange(2000))[0, 1]) < 0.1


def test_written_shards(spark, docs, tmp_path):
    path = str(tmp_path / "shards")
    write_shards(sharded(docs, 3), path)
    read = spark.read.parquet(path)
    assert read.count() == len(documents()) and {r["shard"] for r in read.select("shard").collect()} == {0, 1, 2}


def test_empty_table_and_wrong_count(no_docs):
    assert sharded(no_docs).count() == 0
    with pytest.raises(ValueError):
        sharded(no_docs, 0)
