import random
import re
import tracemalloc
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import documents, rows_of, text_of
from tidemark.llm import jaccard_join, pages
from tidemark.llm import components as components_module
from tidemark.llm.components import clusters, components
from tidemark.llm.jaccard_join import similar_groups


def shingles(text, k):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def plain(rows, k=5, percent=75):
    """All pairs; rows of one id are one document."""
    sets = [(doc_id, shingles(text, k)) for doc_id, text, *_ in rows]
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(sets)), 2):
        (a, x), (b, y) = sets[i], sets[j]
        linked = x and y and 100 * len(x & y) >= percent * len(x | y)
        if a is None or b is None:
            linked = linked and x == y and (a is None) != (b is None)
        if linked or (a is not None and a == b and x and y):
            parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(sets):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    result = [(d, len(x), d if not x else least.get(find(i))) for i, (d, x) in enumerate(sets)]
    return sorted(result, key=lambda r: [(v is None, v) for v in r])


@pytest.mark.parametrize(("words", "percent"), [(5, 75), (2, 50), (1, 100)])
def test_odd_documents(docs, words, percent):
    found = rows_of(similar_groups(docs, words, percent), "doc_id", "n_shingles", "component_id")
    assert found == plain(documents(), words, percent)


def family(seed, size, n, change):
    """Copies of one text, each with some words changed."""
    draw, base = random.Random(seed), text_of(seed, n).split()
    for i in range(size):
        words = [f"new{i}x{j}" if draw.random() < change else w for j, w in enumerate(base)]
        yield " ".join(words)


@pytest.mark.parametrize("block", [256, 7])
def test_groups_of_near_copies(spark, monkeypatch, block):
    """Members that link through others only, in one block and in many, over many pages."""
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(pages, "PAGE_BYTES", 3000)
    monkeypatch.setattr(pages, "BUCKET_QUESTIONS", 300)
    texts = [t for f in range(4) for t in family(f, 25, 60, 0.02 + 0.01 * f)]
    texts += [text_of(900 + i, 30) for i in range(20)]
    rows = [(i * 7 % 1000, t) for i, t in enumerate(texts)]
    found = similar_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    expected = plain(rows)
    assert len({r[2] for r in expected}) < len(rows) - 20
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == expected


def test_rows_of_one_id(spark):
    a, b = text_of(1, 40), text_of(2, 40)
    rows = [(5, a), (5, b), (3, a), (9, b), (4, b), (7, text_of(3, 40))]
    found = rows_of(similar_groups(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "component_id")
    assert found == [(3, 3), (4, 3), (5, 3), (5, 3), (7, 7), (9, 3)]


def test_empty_table_and_wrong_parameters(no_docs):
    assert similar_groups(no_docs).count() == 0
    for words, percent in ((0, 75), (5, 0), (5, 101)):
        with pytest.raises(ValueError):
            similar_groups(no_docs, words, percent)


def test_components(spark):
    draw = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 160)]
    links = chain + [(draw.randrange(60), draw.randrange(60)) for _ in range(50)] + [(70, 70), (None, 3), (3, None)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    draw.shuffle(links)
    frame = spark.createDataFrame(links, "a long, b long")
    assert rows_of(components(frame), "node", "component") == sorted((n, find(n)) for n in parent)
    assert components(frame.limit(0)).count() == 0


def test_no_pairs_of_a_large_group_are_made(spark):
    """300 near copies: what the joins make stays near their number."""
    rows = list(enumerate(family(5, 300, 80, 0.004)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    sets = jaccard_join.written(jaccard_join.shingle_sets(frame, 5, 75, "doc_id", "text"))
    nodes = sets.filter("lead > 0").withColumnRenamed("doc_id", "node").drop("digest")
    group = jaccard_join._grouped(nodes, spark.createDataFrame([], "a long, b long"), 75)
    assert group.agg(F.count_distinct("component")).first()[0] == 1


def test_clusters_of_keys(spark):
    draw = random.Random(11)
    held = [(draw.randrange(-400, 400), draw.randrange(300)) for _ in range(500)]
    held += [(1000 + i, 5000 + i) for i in range(120)] + [(1001 + i, 5000 + i) for i in range(120)]  # a long chain
    held += [(2000 + i, 9000) for i in range(300)] + [(3000, 9500)] * 3  # one key of many, one node alone
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for node, key in held:
        parent[root(("n", node))] = root(("k", key))
    frame = spark.createDataFrame(held, "node long, key long")
    found = clusters(frame.repartition(5)).collect()
    assert sorted(r["node"] for r in found) == sorted({n for n, _ in held})
    names, roots = {}, {}
    for r in found:
        assert names.setdefault(root(("n", r["node"])), r["cluster"]) == r["cluster"]
        assert roots.setdefault(r["cluster"], root(("n", r["node"]))) == root(("n", r["node"]))
    assert clusters(frame.limit(0)).count() == 0


@pytest.mark.parametrize("key", ["doc_id", "xxhash64(doc_id)"])
def test_rows_of_clusters_grow_with_the_family(spark, monkeypatch, key):
    """Near copies of one text: what each round writes grows in proportion to their number."""
    written_rows = []
    real = components_module.written

    def counted(df, *args):
        frame = real(df, *args)
        written_rows.append(frame.count())
        return frame

    monkeypatch.setattr(components_module, "written", counted)
    totals = []
    for n in (100, 200, 400):
        draw = random.Random(n)
        base = text_of(77, 160).split()
        rows = [(i, " ".join(w if draw.random() > 0.02 else f"x{i}y{j}" for j, w in enumerate(base))) for i in range(n)]
        frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(f"{key} AS doc_id", "text")
        written_rows.clear()
        similar_groups(frame).count()
        totals.append(sum(written_rows) / n)
    assert totals[2] < 1.6 * totals[0] + 20


def test_a_page_takes_little_memory():
    """What a task holds for a full page of its text, beside the text itself."""
    numbers = np.random.default_rng(0).integers(0, 1 << 20, (pages.PAGE_BYTES // 2800, 400)).tolist()
    texts = [" ".join(f"{n:06x}" for n in row) for row in numbers]
    table = pa.table({"doc_id": range(len(texts)), "text": texts})
    tracemalloc.start()
    try:
        page = jaccard_join._Page(table, 5, 30)
        asked = page.questions(0)
        replies = [(b, bytes([9]) * (len(p) // 4)) for b, p in zip(asked["bucket"].to_pylist(), asked["payload"].to_pylist())]
        page.sets(pa.concat_tables([pages.answers(1, b, [0], [p]) for b, p in replies]), 75)
        assert tracemalloc.get_traced_memory()[1] < 60 << 20
    finally:
        tracemalloc.stop()
