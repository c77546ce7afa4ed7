import re

import pytest

from conftest import documents, rows_of, text_of
from tidemark.llm import pages
from tidemark.llm.substring_dedup import remove_repeats


def plain(rows, window):
    """Every window of every document in order, one after the other."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, (r[1] or "").encode()))
    seen, result = set(), []
    for doc_id, text, *_ in order:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            passage = tuple(words[i : i + window])
            if passage in seen:
                gone[i : i + window] = [True] * window
            seen.add(passage)
        result.append((doc_id, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return result


@pytest.mark.parametrize("window", [2, 20])
@pytest.mark.parametrize("small", [False, True])
def test_equals_plain_windows(docs, monkeypatch, window, small):
    if small:  # many pages and buckets
        monkeypatch.setattr(pages, "PAGE_BYTES", 2000)
        monkeypatch.setattr(pages, "BUCKET_QUESTIONS", 500)
    expected = sorted(plain(documents(), window), key=lambda r: [(x is None, x) for x in r])
    assert rows_of(remove_repeats(docs, window), "doc_id", "n_words", "n_removed", "kept") == expected


def test_spans_are_what_was_removed(docs):
    for row in remove_repeats(docs).collect():
        assert sum(s["end"] - s["start"] for s in row["spans"]) == row["n_removed"]
    copy = remove_repeats(docs).filter("doc_id = 2").first()
    assert [tuple(s) for s in copy["spans"]] == [(0, 120)] and copy["kept"] == ""


@pytest.mark.parametrize("doc_id", [None, 7])
def test_one_id_for_all_rows(spark, monkeypatch, doc_id):
    """Rows of one id are spread over pages, and a passage that all share stays once."""
    monkeypatch.setattr(pages, "PAGE_BYTES", 2000)
    monkeypatch.setattr(pages, "BUCKET_QUESTIONS", 500)
    passage = text_of(1, 30)
    rows = [(doc_id, f"{passage} own{i} " + " ".join(f"w{i}x{j}" for j in range(25))) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    size = pages.layout(frame)
    spread = [r["count"] for r in pages.paged(frame, size.pages).groupBy("page").count().collect()]
    assert len(spread) > size.pages * 0.9 and max(spread) < 30
    found = remove_repeats(frame).collect()
    assert sorted(r["n_removed"] for r in found) == [0, *[30] * 299]
    assert sorted(r["kept"].split()[-1] for r in found) == sorted(text.split()[-1] for _, text in rows)
    assert {r["doc_id"] for r in found} == {doc_id}


def test_empty_table(no_docs):
    assert remove_repeats(no_docs).count() == 0


def test_odd_window(docs):
    with pytest.raises(ValueError):
        remove_repeats(docs, 7)
