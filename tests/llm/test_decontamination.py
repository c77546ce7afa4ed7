import random
import tracemalloc

import numpy as np
import pytest

from conftest import rows_of, text_of
from tidemark.llm.decontamination import Index, _distance, find_leaks

ITEMS = [(i, text_of(1000 + i, 9 + 4 * i)) for i in range(12)]


def edited(text, edits, seed):
    draw, words = random.Random(seed), text.split()
    for _ in range(edits):
        kind, at = draw.randrange(3), draw.randrange(len(words))
        if kind == 0:
            words.insert(at, "new%d" % draw.randrange(999))
        elif kind == 1:
            words[at] = "other%d" % draw.randrange(999)
        else:
            del words[at]
    return " ".join(words)


def plain_distance(item, words):
    """Fewest edits that make the item a part of the words."""
    row = [0] * (len(words) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(words, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [*ITEMS, (50, None), (51, ""), (52, "too short"), (None, text_of(2000, 15))]
    return spark.createDataFrame(rows, "item_id long, text string")


def planted(seeds):
    rows = []
    for number, seed in enumerate(seeds):
        item_id, text = ITEMS[seed % len(ITEMS)]
        n = len(text.split())
        changed = edited(text, seed % (n // 4 + 1), seed)
        rows.append((number, f"{text_of(seed + 1, 30)} {changed.upper()}! {text_of(seed + 2, 30)}", item_id))
    return rows


def test_finds_planted_items(spark, benchmark):
    rows = planted(range(300))
    frame = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["distance"] for r in find_leaks(frame, benchmark).collect()}
    wanted = {(r[0], r[2]) for r in rows}
    assert len(wanted - set(found)) <= 0.02 * len(wanted)
    unchanged = {(number, seed % 12) for number, seed in enumerate(range(300)) if seed % (len(ITEMS[seed % 12][1].split()) // 4 + 1) == 0}
    assert unchanged <= set(found)
    items = dict(ITEMS)
    for (doc, item), distance in found.items():  # all are real, with the right distance
        words, passage = rows[doc][1].lower().replace("!", "").split(), items[item].split()
        assert distance == plain_distance(passage, words) <= len(passage) // 4


def test_clean_documents_stay(docs, benchmark):
    assert find_leaks(docs, benchmark).count() == 0


def test_rows_of_odd_tables(spark, docs, no_docs, benchmark):
    assert find_leaks(no_docs, benchmark).count() == 0
    assert find_leaks(docs, benchmark.limit(0)).count() == 0
    item = ITEMS[3][1]
    twice = spark.createDataFrame([(1, item), (1, item), (None, item)], "doc_id long, text string")
    found = rows_of(find_leaks(twice, benchmark), "doc_id", "item_id", "distance", "first_word", "n_item_words")
    n = len(item.split())
    assert found == [(1, 3, 0, 0, n), (1, 3, 0, 0, n), (None, 3, 0, 0, n)]


def test_item_without_id(spark, benchmark):
    frame = spark.createDataFrame([(1, text_of(2000, 15))], "doc_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in find_leaks(frame, benchmark).collect()] == [(1, None)]


def test_distance():
    a, b = np.array([1, 2, 3, 4], np.uint64), np.array([9, 1, 2, 7, 3, 4, 9], np.uint64)
    assert _distance(a, b) == (1, 6)
    assert _distance(a, b[:0]) == (4, 0)


def test_index_of_many_sizes():
    index = Index([(i, text_of(i, i)) for i in range(8, 400, 3)], 75, 8, 0.9)
    assert len(index.sizes) <= 64 and all(size.need >= 1 for size in index.sizes)


@pytest.mark.parametrize("n", [40, 80, 200, 600])
def test_long_items_at_the_edit_limit(n):
    items = [(i, text_of(5000 + i, n)) for i in range(10)]
    texts = [f"{text_of(j, 40)} {edited(items[j % 10][1], n // 4, j)} {text_of(j + 7, 40)}" for j in range(60)]
    index = Index(items, 75, 8, 0.99)
    found = {(text, item): (distance, first) for text, item, distance, first in index.look_up([t.encode() for t in texts])}
    assert {(j, j % 10) for j in range(60)} <= set(found)
    for (text, item), (distance, first) in found.items():
        words, passage = texts[text].split(), items[item][1].split()
        assert distance == plain_distance(passage, words) <= n // 4
        assert plain_distance(passage, words[first : first + n + n // 4]) == distance


def test_sizes_are_exact_or_reach_the_recall():
    index = Index([(i, text_of(i, n)) for i, n in enumerate((10, 16, 60, 120, 300))], 75, 8, 0.99)
    assert [size.exact for size in index.sizes] == [False, False, False, False, True]
    assert all(size.exact == (not size.walks) for size in index.sizes)
    assert all(size.exact for size in Index([(1, text_of(1, 16))], 75, 8, 1.0).sizes)


def test_given_items_all_go_by_walks(spark):
    """No size of the given benchmark is compared without walks, and its walks find edited copies drawn anew."""
    rows = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").collect()
    items = [(r["item_id"], r["text"]) for r in rows]
    index = Index(items, 75, 8, 0.99)
    assert not any(size.exact for size in index.sizes)
    found = total = 0
    for size in index.sizes:
        own = [items[i] for i in size.items]
        texts = []
        for j in range(40):
            words = (own[j % len(own)][1] or "").split()
            texts.append(f"{text_of(j + 31, 25)} {edited(' '.join(words), len(words) // 4, 7000 + j)} {text_of(j + 17, 25)}")
        met = {(t, index.ids[i]) for t, i, *_ in index.look_up([t.encode() for t in texts])}
        hits = sum((j, own[j % len(own)][0]) in met for j in range(40))
        assert hits >= 36
        found, total = found + hits, total + 40
    assert found >= 0.98 * total


def test_short_items_are_found_unchanged(spark):
    short = [(1, "one"), (2, "Two words"), (3, "seven words of text that are here"), (4, "?!"), (5, None)]
    frame = spark.createDataFrame([(1, "ONE, two words"), (2, "two more words"), (3, "x seven words of text that are here."),
                                   (4, "seven words of text that were here"), (5, None), (6, "?!")], "doc_id long, text string")
    benchmark = spark.createDataFrame(short, "item_id long, text string")
    found = rows_of(find_leaks(frame, benchmark), "doc_id", "item_id", "distance")
    assert found == [(1, 1, 0), (1, 2, 0), (3, 3, 0)]


def test_whole_table_equals_all_pairs(spark, sf_dir):
    """Every pair of a small table that a plain edit distance finds, but for the stated recall, and no other."""
    from tidemark.llm.hashing import PLAIN_WORDS, word_hashes
    from tidemark.llm.queries import QUERIES

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    words = lambda text: word_hashes([(text or "").encode().translate(PLAIN_WORDS)])[0]
    bodies = {d: words(t) for d, t in docs.items()}
    want = {}
    for item, text in items.items():
        own = words(text)
        for doc, body in bodies.items():
            distance = _distance(own, body)[0]
            if distance <= len(own) // 4:
                want[doc, item] = distance
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in QUERIES["op3_decontamination"](spark, sf_dir).collect()}
    assert want and set(got) <= set(want) and all(want[pair] == distance for pair, distance in got.items())
    assert len(got) >= 0.99 * len(want) and all(pair in got for pair, distance in want.items() if not distance)


def test_memory_of_a_long_item():
    item, other = text_of(1, 4000), text_of(2, 2000)
    index = Index([(1, item)], 75, 8, 0.99)
    tracemalloc.start()
    found = index.look_up([f"{other} {item}".encode(), other.encode()])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [(0, 0, 0, 2000)] and peak < 20e6
