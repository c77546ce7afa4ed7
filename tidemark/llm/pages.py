"""Questions that groups of documents ask about window hashes of the whole corpus.

Documents are dealt into pages by a hash of their id and text, so that null or
repeated ids spread like others. A page asks about each of its distinct window
hashes once, whatever the number of its documents that hold it, so a passage that
a third of all documents share is one question per page. Questions travel as arrays, grouped by ranges of hashes (buckets); the answer to
an array has one bit or byte per question, in the order they were asked.

Pages and buckets fit a task's memory. Both grow with the square root of the
corpus beyond 100 GB of text, so that an array keeps some dozens of questions
and the number of arrays stays in proportion to the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGE_BYTES = 4 << 20
BUCKET_QUESTIONS = 2 << 20
LEVEL_BYTES = 100 << 30
BYTES_PER_WORD = 6

QUESTION = "bucket long, page long, payload binary"
ANSWER = "round int, bucket long, page long, payload binary"
LAST_ID = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Layout:
    pages: int
    buckets: int


def layout(docs: DataFrame, text: str = "text") -> Layout:
    """Numbers of pages and buckets for the bytes of all texts."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    stretch = max(1.0, (total / LEVEL_BYTES) ** 0.5)
    pages = int(total / (PAGE_BYTES * stretch)) + 1
    buckets = int(total / BYTES_PER_WORD / (BUCKET_QUESTIONS * stretch)) + 1
    return Layout(pages, buckets)


def paged(docs: DataFrame, pages: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns page, doc_id, text; equal rows lie in one page."""
    key, body = F.col(doc_id).cast("long"), F.col(text).cast("string")
    page = F.pmod(F.xxhash64(key, body), F.lit(pages)).cast("long")
    return docs.select(page.alias("page"), key.alias("doc_id"), body.alias("text"))


def page_rows(table: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    """Ids and texts of a page in document order: by id, rows of one id by text; null ids last."""
    ids = table["doc_id"].combine_chunks().fill_null(LAST_ID).to_numpy(zero_copy_only=False)
    texts = [t or b"" for t in table["text"].cast(pa.binary()).to_pylist()]
    order = sorted(range(len(texts)), key=lambda i: (ids[i], texts[i]))
    return ids[order], [texts[i] for i in order]


def spans_of(sorted_buckets: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of each run of equal buckets."""
    if not len(sorted_buckets):
        return []
    cuts = np.flatnonzero(np.diff(sorted_buckets)) + 1
    first = np.concatenate([[0], cuts])
    last = np.concatenate([cuts, [len(sorted_buckets)]])
    return [(int(sorted_buckets[a]), int(a), int(b)) for a, b in zip(first, last)]


def questions(page: int, buckets: list[int], payloads: list[bytes]) -> pa.Table:
    return pa.table(
        {
            "bucket": pa.array(buckets, pa.int64()),
            "page": pa.array([page] * len(buckets), pa.int64()),
            "payload": pa.array(payloads, pa.binary()),
        }
    )


def answers(rounds: int, bucket: int, pages: list[int], payloads: list[bytes]) -> pa.Table:
    return pa.table(
        {
            "round": pa.array([rounds] * len(pages), pa.int32()),
            "bucket": pa.array([bucket] * len(pages), pa.int64()),
            "page": pa.array(pages, pa.int64()),
            "payload": pa.array(payloads, pa.binary()),
        }
    )


def answers_of(table: pa.Table, rounds: int) -> list[bytes]:
    """Payloads of one round in the order the buckets were asked."""
    rows = zip(table["round"].to_pylist(), table["bucket"].to_pylist(), table["payload"].to_pylist())
    return [p for _, p in sorted((b, p) for r, b, p in rows if r == rounds)]


def bits(payloads: list[bytes], lengths: list[int]) -> np.ndarray:
    """One boolean per question from answers of packed bits."""
    parts = [np.unpackbits(np.frombuffer(p, np.uint8), count=n) for p, n in zip(payloads, lengths)]
    return (np.concatenate(parts) if parts else np.empty(0, np.uint8)).astype(bool)


# Short hashes: a bucket and 30 more bits, sorted. Enough to leave things out by;
# what they let through is compared by its whole hash later.
SHORT = 30


def short_codes(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Codes below buckets << SHORT that keep the order of the hashes."""
    width = buckets.bit_length()
    return ((hashes >> np.uint64(width)) * np.uint64(buckets)) >> np.uint64(64 - width - SHORT)


def code_buckets(codes: np.ndarray) -> np.ndarray:
    return (codes >> np.uint64(SHORT)).astype(np.int64)


def code_payload(codes: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """32 bits a question: the code within its bucket and two bits of what the page knows of it."""
    low = codes & np.uint64((1 << SHORT) - 1)
    return (low.astype(np.uint32) << np.uint32(2)) | flags.astype(np.uint32)
