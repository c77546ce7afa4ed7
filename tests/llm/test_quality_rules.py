import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import documents, rows_of
from tidemark.llm import quality_rules as rules
from tidemark.llm.shared import held_out

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(5)}
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, repeated, len(covered)


def grams(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    hashes, counts = rules.word_hashes([b" ".join(words)])
    return rules._grams(hashes, counts)[0]


ODD = [
    (200, "a\nb \na\n\n \na\nb\n", "en", "x"),
    (201, "# * $ % & | < > ## é# <b>漢字</b> 　x", "en", "x"),
    (202, "one two three four five one two three four five six", "en", "x"),
    (203, "x\n" * 5000, "en", "x"),
    (204, "w" * 300_000 + " v", "en", "x"),
    (205, "a b c d e " * 2 + "f g h i j k l m n o p q r s t u v w x y z aa bb cc dd ee ff gg hh", None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    frame = spark.createDataFrame(documents() + ODD, "doc_id long, text string, lang string, source string")
    clash = "n_words word_chars n_symbols n_dup_lines n_repeat_words score base_failed kept quality chunk counts".split()
    return frame.repartition(3).withColumns({name: F.lit(name) for name in clash})


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1), (1, 1), (1, 0), (11, 1), (13, 1), (201, 0), (None, 1), (4, None), (999, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int").withColumns({"text": F.lit("t"), "n": F.lit(1)})


def test_rules_and_score_equal_plain_version(odd, labels):
    rows = documents() + ODD
    ratio = rules.learn(odd, labels)
    totals = [np.ones(rules.BUCKETS), np.ones(rules.BUCKETS)]
    for doc_id, text, *_ in rows:
        for total, counts in zip(totals, (doc_id in (1, 11, 13), True)):
            if counts:
                np.add.at(total, grams(text), 1)
    log_ratio = np.log(totals[0] / totals[0].sum()) - np.log(totals[1] / totals[1].sum())
    assert np.allclose(ratio.log_ratio, log_ratio)
    want = []
    for doc_id, text, *_ in rows:
        base, own = plain(text), grams(text)
        score = round(float(log_ratio[own].mean()), 9) if len(own) else 0.0
        failed = base[0] < 10 or 100 * base[4] > 20 * base[0]
        want.append((doc_id, *base, failed, not failed and score >= rules.THRESHOLD, score))
    found = rules.judged(odd, ratio).withColumn("score", F.round("score", 9))
    got = rows_of(found, "doc_id", *BASE, "base_failed", "kept", "score")
    assert [g[:8] for g in got] == sorted([w[:8] for w in want], key=lambda row: [(x is None, x) for x in row])
    assert np.allclose(sorted(g[8] for g in got), sorted(w[8] for w in want), atol=1e-8)


def test_no_documents_and_no_labels(odd, labels):
    none = odd.limit(0)
    assert rules.judged(none, rules.learn(none, labels)).count() == 0
    rows = rules.judged(odd, rules.learn(odd, labels.limit(0))).collect()
    assert {r["score"] for r in rows} == {0.0} and all(r["kept"] != r["base_failed"] for r in rows)


def test_texts_in_portions(odd, labels, monkeypatch):
    whole = rows_of(rules.judged(odd, rules.learn(odd, labels)), "doc_id", *BASE, "kept")
    monkeypatch.setattr(rules, "PART_BYTES", 100)
    assert rows_of(rules.judged(odd, rules.learn(odd, labels)), "doc_id", *BASE, "kept") == whole


def test_held_out_documents_of_good_quality_stay(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    ratio = rules.learn(docs, labels.filter(~held_out()))
    rows = rules.judged(docs, ratio).filter(held_out()).join(labels, "doc_id").select("kept", "base_failed", "quality")
    rows = rows.collect()
    good = [r["kept"] for r in rows if r["quality"] == 1 and not r["base_failed"]]
    poor = [r["kept"] for r in rows if r["quality"] == 0]
    assert len(good) > 500 and np.mean(good) > 0.99 and np.mean(poor) < 0.15


def test_ratio_is_the_same_on_any_partitions(spark, odd, labels):
    first = rules.learn(odd, labels).log_ratio
    assert np.array_equal(first, rules.learn(odd.repartition(7), labels).log_ratio)
