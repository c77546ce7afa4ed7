from collections import Counter

import pytest
import xxhash

from conftest import documents, rows_of
from tidemark.llm import line_dedup
from tidemark.llm.line_dedup import drop_common_lines

SPACE = " \t\n\x0b\f\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def plain(rows, min_docs, min_chars):
    texts = [(doc_id, (text or "").split("\n")) for doc_id, text, *_ in rows]
    counts = Counter(key for _, lines in texts for key in {key_of(x) for x in lines} if len(key) >= min_chars)
    result = []
    for doc_id, lines in texts:
        kept = [x for x in lines if counts[key_of(x)] < min_docs]
        result.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(result, key=lambda r: [(x is None, x) for x in r])


@pytest.mark.parametrize(("min_docs", "min_chars"), [(10, 1), (2, 1), (2, 0), (2, 12), (1000, 1)])
def test_equals_plain_count(docs, min_docs, min_chars):
    found = rows_of(drop_common_lines(docs, min_docs, min_chars), "doc_id", "n_lines", "n_dropped", "kept")
    assert found == plain(documents(), min_docs, min_chars)


def test_full_filters_change_nothing(docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "LEAST_BITS", 8)
    monkeypatch.setattr(line_dedup, "MOST_BITS", 8)
    found = rows_of(drop_common_lines(docs), "doc_id", "n_lines", "n_dropped", "kept")
    assert found == plain(documents(), 10, 1)


def test_few_lines_are_suspected(spark):
    rows = [(i, "\n".join(f"own line {i} {j}" for j in range(50)) + "\nshared") for i in range(200)]
    texts = spark.createDataFrame(rows, "doc_id long, text string").withColumn("version", line_dedup.F.xxhash64("text"))
    bitmap = line_dedup._seen_twice(texts, 1)
    suspects = line_dedup._suspects(texts, bitmap, 1).collect()
    assert 200 <= len(suspects) < 0.15 * 200 * 51


def plain_first(rows, min_docs, min_chars):
    """As `plain`, with each common key's first line left in the document that comes first."""
    versions = {}
    for doc_id, text, *_ in rows:
        versions.setdefault((doc_id, text or ""), []).append(text)
    hashes = {x: line_dedup_hash(x[1]) for x in versions}
    order = sorted(versions, key=lambda x: (x[0] is None, x[0] or 0, hashes[x]))
    counts = Counter(
        key for x, copies in versions.items() for key in {key_of(i) for i in x[1].split("\n")} for _ in copies
    )
    seen, result = set(), []
    for x in order:
        lines, kept = x[1].split("\n"), []
        for line in lines:
            key = key_of(line)
            if counts[key] < min_docs or len(key) < min_chars or key not in seen:
                kept.append(line)
                seen.add(key)
        result += [(x[0], len(lines), len(lines) - len(kept), "\n".join(kept))] * len(versions[x])
    return sorted(result, key=lambda r: [(y is None, y) for y in r])


def line_dedup_hash(text):
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >= 1 << 63 else h


@pytest.mark.parametrize(("min_docs", "min_chars"), [(10, 1), (2, 1), (2, 0), (2, 12)])
def test_first_places_stay(docs, min_docs, min_chars):
    found = drop_common_lines(docs, min_docs, min_chars, keep_first=True)
    assert rows_of(found, "doc_id", "n_lines", "n_dropped", "kept") == plain_first(documents(), min_docs, min_chars)


def test_many_equal_rows(spark):
    rows = [(1, "a\nb\nb")] * 50 + [(None, "b\nc")] * 50 + [(2, "own\nC ")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = rows_of(drop_common_lines(frame), "doc_id", "n_lines", "n_dropped", "kept")
    assert found == plain(rows, 10, 1)
    found = rows_of(drop_common_lines(frame, keep_first=True), "doc_id", "n_lines", "n_dropped", "kept")
    expected = [(1, 3, 1, "a\nb")] * 50 + [(2, 2, 0, "own\nC ")] + [(None, 2, 2, "")] * 50
    assert found == expected


def test_empty_table_and_wrong_count(no_docs):
    with pytest.raises(ValueError):
        drop_common_lines(no_docs, 1)
    assert drop_common_lines(no_docs).count() == 0
