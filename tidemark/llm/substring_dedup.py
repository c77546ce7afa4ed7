"""Removal of word passages that occur earlier in the corpus.

Method: fixed-block anchors. With windows of 2b words, every place where a
window occurs holds at least one whole block of b words that starts at a multiple
of b. Round 1 indexes those non-overlapping blocks and probes the index with
every rolling window of b words of every document. Round 2 extends the hits: all
windows around a hit are compared by two hashes of theirs, 64 bits and a bucket,
and the earliest place of each is found. Runs of repeated windows are the maximal
exact repeats; their words go.

Both rounds are questions of pages (see pages.py): a block or passage counts once
per page, no pairs of places are made, and what a task holds is bounded.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import pages
from tidemark.llm.hashing import by_small, mixed, rolling, runs, window_starts, word_hashes

WINDOW = 20
Key = tuple[pa.Scalar, ...]
KEPT = 0  # round of answers that hold what a page sent to itself
RESULT = "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept string"


class _Page:
    """A page's words, its rolling blocks, and the windows around hits."""

    def __init__(self, table: pa.Table, window: int, buckets: int):
        self.block, self.window, self.buckets = window // 2, window, buckets
        self.ids, self.texts = pages.page_rows(table)
        self.hashes, self.counts = word_hashes(self.texts)
        self.first = np.cumsum(self.counts) - self.counts

    def _blocks(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all rolling blocks, and their short codes with a last bit for indexed ones."""
        starts, doc = window_starts(self.counts, self.block)
        codes = pages.short_codes(rolling(self.hashes, self.block)[starts], self.buckets)
        aligned = (starts - self.first[doc]) % self.block == 0
        return starts, codes << np.uint64(1) | aligned.astype(np.uint64)

    def block_questions(self, page: int) -> pa.Table:
        keys = np.sort(self._blocks()[1])
        codes = keys >> np.uint64(1)
        first = runs(codes)
        last = np.append(first[1:], True)[: len(codes)]
        # An indexed block sorts behind others of its code.
        flags = (keys[last] & np.uint64(1)) << np.uint64(1) | ~(first & last)[last]
        payload = pages.code_payload(codes[last], flags)
        spans = pages.spans_of(pages.code_buckets(codes[last]))
        return pages.questions(page, [b for b, _, _ in spans], [payload[i:j].tobytes() for _, i, j in spans])

    def near_hits(self, replies: pa.Table) -> np.ndarray:
        """For each word, whether a window starts there that holds a hit."""
        starts, keys = self._blocks()
        order = np.argsort(keys)
        codes = keys[order] >> np.uint64(1)
        first = runs(codes)
        lengths = [j - i for _, i, j in pages.spans_of(pages.code_buckets(codes[first]))]
        hit = pages.bits(pages.answers_of(replies, 1), lengths)
        hits = np.zeros(len(self.hashes) + 1, np.int32)
        hits[starts[order] + 1] = hit[np.cumsum(first) - 1]
        before = np.cumsum(hits)
        near = np.zeros(len(self.hashes), bool)
        windows, _ = window_starts(self.counts, self.window)
        near[windows] = before[windows + self.window - self.block + 1] > before[windows]
        return near

    def compare(self, near: np.ndarray) -> None:
        """Those windows in order of bucket and hash, and the first place of each distinct one."""
        places = np.flatnonzero(near)
        values = rolling(self.hashes, self.window, 1)[places]
        more = mixed(self.hashes[places] ^ mixed(self.hashes[places + self.window // 2]))
        buckets = (more % np.uint64(self.buckets)).astype(np.int64)
        order = by_small(np.argsort(values), buckets, self.buckets)
        self.places, values, buckets = places[order], values[order], buckets[order]
        new = runs(values) | runs(buckets)
        self.window_of = np.cumsum(new) - 1
        self.values, self.value_buckets = values[new], buckets[new]
        self.first_place = np.minimum.reduceat(self.places, np.flatnonzero(new)) if len(places) else places
        doc = np.searchsorted(self.first, self.first_place, "right") - 1
        self.owners = self.ids[doc]

    def window_questions(self, page: int, near: np.ndarray) -> pa.Table:
        spans = pages.spans_of(self.value_buckets)
        payloads = [self.values[i:j].tobytes() + self.owners[i:j].tobytes() for _, i, j in spans]
        # A page sends the places to itself, in a bucket of its own, for the last step.
        return pages.questions(page, [-1 - page, *(b for b, _, _ in spans)], [np.packbits(near).tobytes(), *payloads])

    def result(self, replies: pa.Table) -> pa.Table:
        lengths = [j - i for _, i, j in pages.spans_of(self.value_buckets)]
        ours = pages.bits(pages.answers_of(replies, 2), lengths)
        # The first place in the page stays where no other page has an earlier one.
        stays = (self.places == self.first_place[self.window_of]) & ours[self.window_of]
        repeated = self.places[~stays]
        cover = np.zeros(len(self.hashes) + 1, np.int64)
        np.add.at(cover, repeated, 1)
        np.subtract.at(cover, repeated + self.window, 1)
        gone = np.cumsum(cover[:-1]) > 0
        removed, spans, kept = [], [], []
        for text, a, n in zip(self.texts, self.first.tolist(), self.counts.tolist()):
            own = gone[a : a + n]
            edges = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8))).tolist()
            spans.append([{"start": s, "end": e} for s, e in zip(edges[::2], edges[1::2])])
            removed.append(int(own.sum()))
            words = text.split()
            if edges:
                stay = [0, *edges, n]
                words = [w for s, e in zip(stay[::2], stay[1::2]) for w in words[s:e]]
            kept.append(b" ".join(words).decode())
        ids = pa.array([None if i == pages.LAST_ID else i for i in self.ids.tolist()], pa.int64())
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table(
            {
                "doc_id": ids,
                "n_words": pa.array(self.counts, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "spans": pa.array(spans, span),
                "kept": pa.array(kept, pa.string()),
            }
        )


def _answer_blocks(key: Key, table: pa.Table) -> pa.Table:
    """Which rolling windows hit an indexed block at another place."""
    asked = [np.frombuffer(p, np.uint32) for p in table["payload"].to_pylist()]
    every = np.sort(np.concatenate(asked))
    codes = every >> np.uint32(2)
    first = np.flatnonzero(runs(codes))
    indexed = np.bitwise_or.reduceat(every, first)
    several = np.diff(np.append(first, len(codes))) > 1
    hits = codes[first][(indexed & 2 > 0) & (several | (indexed & 1 > 0))]
    replies = [np.packbits(np.isin(p >> np.uint32(2), hits, assume_unique=True)).tobytes() for p in asked]
    return pages.answers(1, key[0].as_py(), table["page"].to_pylist(), replies)


def _answer_windows(key: Key, table: pa.Table) -> pa.Table:
    """For each window of a page, whether the page's first place of it is the earliest of all."""
    if key[0].as_py() < 0:
        return pages.answers(KEPT, key[0].as_py(), table["page"].to_pylist(), table["payload"].to_pylist())
    table = table.sort_by("page")
    asked = [np.frombuffer(p, np.int64).reshape(2, -1) for p in table["payload"].to_pylist()]
    values = np.concatenate([a[0] for a in asked])
    owners = np.concatenate([a[1] for a in asked])
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    first = runs(ordered)
    earliest = np.minimum.reduceat(owners[order], np.flatnonzero(first))
    run = np.cumsum(first) - 1
    own = np.flatnonzero(owners[order] == earliest[run])
    ours = np.zeros(len(values), bool)
    ours[order[own[runs(run[own])]]] = True  # of pages that hold rows of one id, the first
    cuts = np.cumsum([a.shape[1] for a in asked])[:-1]
    replies = [np.packbits(part).tobytes() for part in np.split(ours, cuts)]
    return pages.answers(2, key[0].as_py(), table["page"].to_pylist(), replies)


def remove_repeats(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Remove each word in a window of `window` (even) words that also starts earlier.

    Earlier is a smaller id, or the same document and an earlier start. Words are
    runs of other characters than ASCII whitespace and are compared as they are;
    windows are judged on the input. One row per input row: doc_id, n_words,
    n_removed, spans (ranges of removed words, end exclusive), kept (the kept
    words joined by one space).

    Null and empty texts have no words and `kept` is empty. Rows of one id follow
    each other by their page, a hash of id and text, then in order of text; a null
    id comes last. Repeated rows are repeats like any other. Other columns are not
    looked at, whatever their names.
    """
    if window < 2 or window % 2:
        raise ValueError("window must be an even number of words")
    size = pages.layout(docs.select(F.col(text).cast("string").alias("text")))
    split = pages.paged(docs, size.pages, doc_id, text)

    def ask_blocks(key: Key, table: pa.Table) -> pa.Table:
        return _Page(table, window, size.buckets).block_questions(key[0].as_py())

    def ask_windows(key: Key, table: pa.Table, replies: pa.Table) -> pa.Table:
        page = _Page(table, window, size.buckets)
        near = page.near_hits(replies)
        page.compare(near)
        return page.window_questions(key[0].as_py(), near)

    def finish(key: Key, table: pa.Table, replies: pa.Table) -> pa.Table:
        page = _Page(table, window, size.buckets)
        page.compare(pages.bits(pages.answers_of(replies, KEPT), [len(page.hashes)]))
        return page.result(replies)

    by_page = split.groupBy("page")
    blocks = by_page.applyInArrow(ask_blocks, pages.QUESTION).groupBy("bucket")
    hits = blocks.applyInArrow(_answer_blocks, pages.ANSWER)
    windows = by_page.cogroup(hits.groupBy("page")).applyInArrow(ask_windows, pages.QUESTION).groupBy("bucket")
    replies = windows.applyInArrow(_answer_windows, pages.ANSWER)
    return by_page.cogroup(replies.groupBy("page")).applyInArrow(finish, RESULT)
