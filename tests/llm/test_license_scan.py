import random
import re

import pytest

from conftest import documents
from tidemark.llm.license_scan import APART, BASE, COVERED, GRAM, NOTICES, scan_licenses

TEXTS = [
    "Under the MIT License. under the mit license, under the MIT-license",
    "Apache License, Version 2.0 and apache license version 3",
    "CC BY-NC 4.0 cc by nc cc\nby\tnc",
    "This work is licensed under the GNU General Public License, version 3.",
    "This work is hereby licensed under the terms of the GNU General Public License version 3",
    "under the mitK license Kcc by nc cc by Knc",
    "This work is licensed",
    None,
    "",
    "word " * 20_000 + "cc by nc",
]


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def places(text):
    words = words_of(text)
    found = []
    for phrase, label in BASE.items():
        part = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(part)] == part]
    return sorted(found)


@pytest.fixture(scope="module")
def scanned(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    return {r["doc_id"]: r for r in scan_licenses(frame).collect()}


def test_base_places(scanned):
    for doc_id, text in enumerate(TEXTS):
        row = scanned[doc_id]
        assert row["n_words"] == len(words_of(text))
        assert sorted((s["first"], s["label"]) for s in row["spans"] if s["base"]) == places(text)


def test_notices_with_small_changes(scanned):
    for doc_id in (3, 4):
        (span,) = [s for s in scanned[doc_id]["spans"] if not s["base"]]
        assert span["label"] == "gpl-3" and span["first"] == 0
    assert scanned[3]["spans"][0]["score"] == 1.0
    assert scanned[6]["spans"] == []


def test_odd_documents(docs):
    rows = scan_licenses(docs).collect()
    assert sorted(r["n_words"] for r in rows) == sorted(len(words_of(t)) for _, t, *_ in documents())
    assert all(r["spans"] == [] for r in rows)


def test_empty_table(no_docs):
    assert scan_licenses(no_docs).count() == 0


def test_native_plan(docs):
    plan = scan_licenses(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
    assert "BroadcastHashJoin" in plan


def test_one_grouping_of_documents(docs):
    """Each sorter of a task holds a page of a few dozen MB, so documents are grouped once; templates need no workers."""
    frame = scan_licenses(docs)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("BroadcastHashJoin")]
    assert above.count("Aggregate") == 2 and "Window" not in above
    assert plan.count("ExistingRDD") == 1  # the documents


def plain_spans(text):
    """Spans by loops over all places of all templates."""
    words, spans = words_of(text), []
    for base, phrases in ((True, BASE), (False, NOTICES)):
        for phrase, label in phrases.items():
            of = phrase.split()
            hits = [
                (pos - at, at, pos)
                for pos in range(len(words) - GRAM + 1)
                for at in range(len(of) - GRAM + 1)
                if words[pos : pos + GRAM] == of[at : at + GRAM]
            ]
            groups = []
            for hit in sorted(hits):
                if not groups or hit[0] - groups[-1][-1][0] > (0 if base else APART):
                    groups.append([])
                groups[-1].append(hit)
            for group in groups:
                covered = {at + i for _, at, _ in group for i in range(GRAM)}
                places = [pos for _, _, pos in group]
                if len(covered) / len(of) >= (1 if base else COVERED):
                    spans.append((label, base, min(places), max(places) + GRAM - 1, len(covered) / len(of)))
    return sorted(spans)


def test_spans_as_by_plain_loops(spark):
    """Notices and phrases with words left out, put in and repeated; rows of one id stay apart."""
    rng = random.Random(5)
    texts = []
    for _ in range(60):
        words = []
        for _ in range(rng.randrange(1, 6)):
            part = rng.choice([*BASE, *NOTICES]).split()
            words += [w for w in part if rng.random() > 0.05]
            words += [rng.choice(["the", "license", "word"]) for _ in range(rng.randrange(3))]
        texts.append(" ".join(words))
    texts.append("cc by nc " * 30_000)
    frame = spark.createDataFrame([(i % 2, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = scan_licenses(frame.repartition(3)).collect()
    found = sorted((r["doc_id"], r["n_words"], [tuple(s) for s in r["spans"]]) for r in rows)
    assert found == sorted((i % 2, len(words_of(t)), plain_spans(t)) for i, t in enumerate(texts))
