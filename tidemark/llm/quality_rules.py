"""Quality of documents: counts that rules ask for, and a log-likelihood ratio of hashed n-grams.

Method: words and pairs of words are hashed into BUCKETS. Two multinomials over
the buckets are counted, one from documents that are trusted and one from all
documents. A document's score is the mean over its n-grams of the log ratio of
the two, so its length does not matter, and it is kept if the score reaches a
fixed threshold.

Counting is a sum of arrays of fixed size over all documents; scoring is one more
pass without a shuffle. Only the documents with a trusted id are moved, by the
join that finds them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.hashing import mixed, rolling, runs, window_starts, word_hashes
from tidemark.llm.shared import parts, shipped
from tidemark.operators.joins import join_grouped

BUCKETS = 1 << 16
ORDERS = (1, 2)
THRESHOLD = -0.25
MIN_WORDS = 10
REPEATED = 20  # percent of words in repeated windows
WINDOW = 5
PART_BYTES = 2 << 20  # of text that a task works on at a time
CHUNK = 1 << 10  # buckets in a row of partial counts
COUNTS = "chunk int, counts binary"
RULES = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double"
)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\x0b\x0c\r")] = True


@dataclass(frozen=True)
class Ratio:
    """Log ratio of trusted to all n-grams by bucket."""

    log_ratio: np.ndarray

    @staticmethod
    def of(trusted: np.ndarray, raw: np.ndarray) -> Ratio:
        """From counts by bucket, each with one added; without trusted n-grams all ratios are 0."""
        if not trusted.any():
            return Ratio(np.zeros(len(raw)))
        return Ratio(_log_share(trusted + 1.0) - _log_share(raw + 1.0))


def _log_share(counts: np.ndarray) -> np.ndarray:
    return np.log(counts / counts.sum())


def _grams(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of texts, and the text of each."""
    buckets, docs = [], []
    for n in ORDERS:
        starts, doc = window_starts(counts, n)
        keys = mixed(hashes, 3) if n == 1 else rolling(hashes, n, n)
        buckets.append((keys[starts] % np.uint64(BUCKETS)).astype(np.int64))
        docs.append(doc)
    return np.concatenate(buckets), np.concatenate(docs)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        texts = _texts(batch)
        for a, b in parts(texts, PART_BYTES):
            total += np.bincount(_grams(*word_hashes(texts[a:b]))[0], minlength=BUCKETS)
    yield from _rows(dict(enumerate(total.reshape(-1, CHUNK))))


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per chunk from those of all tasks."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
            total[chunk] = total.get(chunk, 0) + np.frombuffer(counts, np.int64)
    yield from _rows(total)


def _rows(by_chunk: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    held = {chunk: counts for chunk, counts in by_chunk.items() if counts.any()}
    yield pa.RecordBatch.from_pydict(
        {
            "chunk": pa.array(list(held), pa.int32()),
            "counts": pa.array([counts.tobytes() for counts in held.values()], pa.binary()),
        }
    )


def bucket_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How many n-grams of all texts fall into each bucket; null and empty texts have none."""
    texts = docs.select(F.col(text).cast("string").alias("text"))
    total = np.zeros(BUCKETS, np.int64)
    # BUCKETS numbers reach the driver, whatever the input.
    for row in texts.mapInArrow(_count, COUNTS).repartition("chunk").mapInArrow(_add, COUNTS).collect():
        total[row["chunk"] * CHUNK :][:CHUNK] = np.frombuffer(row["counts"], np.int64)
    return total


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Ratio:
    """The ratio of documents with label 1 in `labels` (doc_id, `label`) to all documents.

    Null ids and null labels trust nothing; a document counts once however many
    labels of 1 it has, and rows that repeat count each. Runs two jobs when called.
    """
    good = labels.filter(F.col(label) == 1).select(F.col("doc_id").cast("long").alias("doc_id"))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Labels grow with the documents, so no side is small; one plan at every size.
    trusted = join_grouped(own, good.distinct().hint("merge"), ["doc_id"], "left_semi")
    return Ratio.of(bucket_counts(trusted), bucket_counts(docs))


def _repeated_words(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """By text, the words in windows that the text has twice or more."""
    starts, doc = window_starts(counts, WINDOW)
    windows = rolling(hashes, WINDOW, 9)[starts]
    order = np.lexsort((windows, doc))
    new = runs(windows[order]) | runs(doc[order])
    sizes = np.diff(np.append(np.flatnonzero(new), len(order)))
    again = np.sort(starts[order][np.repeat(sizes, sizes) > 1])
    edges = np.zeros(len(hashes) + 1, np.int32)
    edges[again] += 1
    edges[again + WINDOW] -= 1
    covered = np.cumsum(edges[:-1]) > 0
    return np.bincount(np.repeat(np.arange(len(counts)), counts)[covered], minlength=len(counts))


def _repeated_lines(text: bytes) -> int:
    if b"\n" not in text:
        return 0
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def rated(docs: DataFrame, ratio: Ratio, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and score.

    Words are runs of characters other than ASCII whitespace, compared as they
    are. word_chars counts their code points, n_symbols all of #*$%&|<>,
    n_dup_lines the lines with a word that equal an earlier line, n_repeat_words
    the words in windows of WINDOW words that the text holds twice or more. Null
    and texts without words have zeros and score 0. Repeated rows are rated each;
    other columns are not looked at, whatever their names.
    """
    shared = shipped(docs.sparkSession, ratio)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_ratio = shared().log_ratio
        for batch in batches:
            texts = _texts(batch)
            for a, b in parts(texts, PART_BYTES):
                own = texts[a:b]
                hashes, counts = word_hashes(own)
                buckets, doc = _grams(hashes, counts)
                raw = np.frombuffer(b" ".join([*own, b""]), np.uint8)
                ends = np.cumsum([len(t) + 1 for t in own]) - 1
                n_grams = np.maximum(np.bincount(doc, minlength=b - a), 1)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").slice(a, b - a),
                        "n_words": pa.array(counts, pa.int64()),
                        "word_chars": _sums(~_SPACE[raw] & (raw & 0xC0 != 0x80), ends),
                        "n_symbols": _sums(_SYMBOL[raw], ends),
                        "n_dup_lines": pa.array([_repeated_lines(t) for t in own], pa.int64()),
                        "n_repeat_words": pa.array(_repeated_words(hashes, counts), pa.int64()),
                        "score": pa.array(np.bincount(doc, log_ratio[buckets], minlength=b - a) / n_grams),
                    }
                )

    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return texts.mapInArrow(rate, RULES)


def _sums(flags: np.ndarray, ends: np.ndarray) -> pa.Array:
    """How many flags are set in each text; `ends` are behind the texts."""
    before = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[ends]
    return pa.array(np.diff(before, prepend=0), pa.int64())


def fails_rules() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))


def judged(docs: DataFrame, ratio: Ratio, threshold: float = THRESHOLD) -> DataFrame:
    """As `rated`, with base_failed (the rules) and kept (passes them and reaches the threshold)."""
    rows = rated(docs, ratio).withColumn("base_failed", fails_rules())
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
