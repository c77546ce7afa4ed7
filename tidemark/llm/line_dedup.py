"""Removal of lines that many documents have.

Method: two Bloom filters. Each task records the keys of its lines in a filter
of keys seen once and, if they are in that, in a filter of keys seen twice; the
tasks' filters are folded chunk by chunk, and a bit that two tasks have set in
their first filter counts as seen twice. Only lines in the second filter can
occur in two documents: they alone are shuffled, by a 128-bit digest of the key,
counted exactly, and where asked the first place of each key is chosen, which
stays. The filters grow with the text up to MOST_BITS; beyond that
more lines are suspected and shuffled, which changes no result.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.hashing import runs
from tidemark.llm.shared import parts, written
from tidemark.operators.joins import join_grouped

MIN_DOCS = 10
MIN_CHARS = 1
# Bits of a filter: a quarter as many as bytes of text, 32 MB to broadcast at most.
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 28
CHUNK_BYTES = 1 << 13
PART_BYTES = 2 << 20  # of text that a task works on at a time
FILTERS = "chunk int, once binary, twice binary"
SUSPECTS = "doc_id long, version long, digest binary, numbers array<int>"


def _keys(text: bytes, min_chars: int) -> Iterator[tuple[int, bytes]]:
    for number, line in enumerate(text.split(b"\n")):
        key = line.strip().lower()
        if len(key) >= min_chars and (min_chars < 2 or len(key.decode()) >= min_chars):
            yield number, key


def _bits(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each hash."""
    return (hashes & np.uint64(size - 1)).astype(np.int64), (hashes >> np.uint64(36)).astype(np.int64) % size


def _has(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _set(bitmap: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(bitmap, at >> 3, (1 << (at & 7)).astype(np.uint8))


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _chunks(once: np.ndarray, twice: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(once), CHUNK_BYTES):
        a, b = once[at : at + CHUNK_BYTES], twice[at : at + CHUNK_BYTES]
        if a.any():
            yield pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array([at // CHUNK_BYTES], pa.int32()),
                    "once": pa.array([a.tobytes()], pa.binary()),
                    "twice": pa.array([b.tobytes()], pa.binary()),
                }
            )


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per chunk from those of all tasks."""
    folded: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            a, b = (np.frombuffer(row[name], np.uint8) for name in ("once", "twice"))
            if row["chunk"] in folded:
                once, twice = folded[row["chunk"]]
                twice |= b | (once & a)
                once |= a
            else:
                folded[row["chunk"]] = (a.copy(), b.copy())
    for chunk, (once, twice) in folded.items():
        yield pa.RecordBatch.from_pydict(
            {
                "chunk": pa.array([chunk], pa.int32()),
                "once": pa.array([b""], pa.binary()),
                "twice": pa.array([twice.tobytes()], pa.binary()),
            }
        )


def _seen_twice(texts: DataFrame, min_chars: int) -> np.ndarray:
    """The filter of line keys that may occur in two documents."""
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    size = min(max(1 << (total // 4).bit_length(), LEAST_BITS), MOST_BITS)

    def record(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(size // 8, np.uint8), np.zeros(size // 8, np.uint8)
        for batch in batches:
            texts_ = _texts(batch)
            for a, b in parts(texts_, PART_BYTES):
                found: list[int] = []
                for text in texts_[a:b]:
                    found.extend({xxhash.xxh3_64_intdigest(key) for _, key in _keys(text, min_chars)})
                hashes = np.sort(np.array(found, np.uint64))
                new = runs(hashes)
                several = np.diff(np.append(np.flatnonzero(new), len(hashes))) > 1
                i, j = _bits(hashes[new], size)
                again = several | (_has(once, i) & _has(once, j))
                for at in (i, j):
                    _set(twice, at[again])
                for at in (i, j):
                    _set(once, at)
        yield from _chunks(once, twice)

    chunks = texts.mapInArrow(record, FILTERS).repartition("chunk").mapInArrow(_fold, FILTERS)
    bitmap = np.zeros(size // 8, np.uint8)
    for row in chunks.select("chunk", "twice").collect():  # MOST_BITS at most
        at = row["chunk"] * CHUNK_BYTES
        bitmap[at : at + len(row["twice"])] = np.frombuffer(row["twice"], np.uint8)
    return bitmap


def _suspects(texts: DataFrame, bitmap: np.ndarray, min_chars: int) -> DataFrame:
    """Lines whose key may occur in two documents: numbers by document and key."""
    twice, size = texts.sparkSession.sparkContext.broadcast(bitmap), len(bitmap) * 8

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions = batch.column("doc_id").to_pylist(), batch.column("version").to_pylist()
            bodies, rows = _texts(batch), []
            for a, b in parts(bodies, PART_BYTES):
                seen, hashes = [], []
                for row in range(a, b):
                    found = defaultdict(list)
                    for number, key in _keys(bodies[row], min_chars):
                        found[key].append(number)
                    seen.extend((row, key, numbers) for key, numbers in found.items())
                    hashes.extend(map(xxhash.xxh3_64_intdigest, found))
                i, j = _bits(np.array(hashes, np.uint64), size)
                rows += [seen[at] for at in np.flatnonzero(_has(twice.value, i) & _has(twice.value, j)).tolist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array([ids[row] for row, _, _ in rows], pa.int64()),
                    "version": pa.array([versions[row] for row, _, _ in rows], pa.int64()),
                    "digest": pa.array(
                        [hashlib.blake2b(key, digest_size=16).digest() for _, key, _ in rows], pa.binary()
                    ),
                    "numbers": pa.array([numbers for _, _, numbers in rows], pa.list_(pa.int32())),
                }
            )

    return texts.mapInArrow(look_up, SUSPECTS)


def drop_common_lines(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    doc_id: str = "doc_id",
    text: str = "text",
    keep_first: bool = False,
) -> DataFrame:
    """Drop lines whose key is found in at least `min_docs` documents, everywhere.

    With `keep_first` a key's first line stays: the smallest document id that has
    it, null last, its text of the smallest hash if the id repeats, and there the
    smallest line number. Rows equal in id and text share their result, so each of
    them keeps it.

    Lines end at \\n. A line's key is the line without ASCII whitespace at both
    ends and with A-Z in lower case; keys of fewer than `min_chars` characters
    stay. One row per input row: doc_id, n_lines (before), n_dropped, dropped
    (line numbers from 0), kept (the other lines, joined by \\n).

    A null or empty text is one empty line. A key counts once per row however
    often the row has it; each row is a document, also where rows repeat. Where
    all lines go, kept is empty. Other columns are not looked at. Builds the
    filters and stores the suspected lines when called.
    """
    if min_docs < 2:
        raise ValueError("a line that repeats is in two documents at least")
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    key = F.col(doc_id).cast("long")
    texts = docs.select(key.alias("doc_id"), body.alias("text"))
    # Rows with one id and one text share their result, so these two tell rows apart.
    texts = texts.withColumn("version", F.xxhash64("text"))
    suspects = written(_suspects(texts, _seen_twice(texts, min_chars), min_chars))
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "version")
    counts = [F.count(F.lit(1)).alias("n_docs")] + ([F.min(place).alias("first")] if keep_first else [])
    common = suspects.groupBy("digest").agg(*counts).filter(F.col("n_docs") >= min_docs)
    hits = join_grouped(suspects, common.drop("n_docs"), ["digest"])
    if keep_first:
        here = F.col("l.doc_id").eqNullSafe(F.col("r.first.doc_id")) & (F.col("l.version") == F.col("r.first.version"))
        rest = F.when(here, F.slice("l.numbers", 2, F.size("l.numbers"))).otherwise(F.col("l.numbers"))
        hits = hits.select("l.doc_id", "l.version", rest.alias("numbers"))
    else:
        hits = hits.select("l.doc_id", "l.version", "l.numbers")
    # As a set, so that equal rows, which send equal numbers, are merged before the shuffle.
    dropped = hits.groupBy("doc_id", "version").agg(
        F.array_sort(F.flatten(F.collect_set("numbers"))).alias("dropped")
    )
    joined = join_grouped(texts, dropped, ["doc_id", "version"], "left", null_safe=True)
    lines = F.split("text", "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.col("n_lines") - 1), "dropped")
    kept = F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")
    return (
        joined.select(F.col("l.doc_id").alias("doc_id"), "text", "dropped", lines.alias("lines"))
        .withColumn("n_lines", F.size("lines"))
        .select(
            "doc_id",
            F.col("n_lines").cast("long").alias("n_lines"),
            F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
            F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
            F.when(F.col("dropped").isNull(), F.col("text")).otherwise(kept).alias("kept"),
        )
    )
