"""Documents that hold a passage within a few word edits of a benchmark item.

Method: CGK random walks with bit sampling. A walk reads a word sequence, writes
the current word and moves on or stays by a random bit of (step, word); two
sequences a few edits apart write the same word at many steps. Sampling a few
steps of a walk gives a key, and sequences within the allowed distance share a
key in at least one of several walks with the target recall; how many walks that
takes is found by simulation on the items. Steps are sampled from the first ones, as
many as the items have words, where the walks of near copies still go together. Keys of the items are looked up from
windows of item size in every document, and what they bring up is compared by
exact edit distance.

Windows are left out beforehand where too few of their word q-grams belong to
items of that size: an item of n words within k edits keeps n - q + 1 - k q of its
q-grams, so this loses nothing. Items of over LONGEST_WALK words, and sizes whose
walks do not reach the recall, go without walks: every window that holds enough
q-grams of one item is compared with it, and nothing is lost. Benchmark items are the
stated query set; they go to the tasks in blocks of bounded size, one pass over
the documents per block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.hashing import PLAIN_WORDS, mixed, rolling, window_starts, word_hashes
from tidemark.llm.shared import parts, shipped

PERCENT = 75
MIN_WORDS = 8
RECALL = 0.99
# Steps of a walk that make a key: fewer where these do not reach the recall.
SAMPLED = (3, 2)
# Sizes that need more walks, or have more words, are compared exactly instead.
MOST_WALKS = 64
LONGEST_WALK = 256
SIMULATED = 1000
MARGIN = 0.2  # share of walks added to those that reached the recall in the simulation
# Text of the items that one pass over the documents looks for.
BLOCK_BYTES = 32 << 20
PART_BYTES = 1 << 20  # of documents that a task works on at a time
FOUND = "doc_id long, item_id long, distance int, first_word long, n_item_words long"


def _walk(h: np.ndarray, start: np.ndarray, end: np.ndarray, steps: np.ndarray, walk: int) -> np.ndarray:
    """The key of the walk over h[start:end] for each pair: its words at the sampled steps."""
    at, keys, padded = start.copy(), np.zeros(len(start), np.uint64), np.append(h, np.uint64(0))
    wanted = set(steps.tolist())
    for step in range(int(steps.max()) + 1):
        if step % 64 == 0:
            moves = mixed(padded, 1000 * walk + step // 64 + 7)
        here = np.where(at < end, at, len(h))
        if step in wanted:
            keys = mixed(keys ^ padded[here], step)
        at += ((moves[here] >> np.uint64(step % 64)) & np.uint64(1)).astype(np.int64)
    return keys


def _distance(item: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """Fewest word edits that make the item a part of the region, and where that part ends."""
    n = len(region)
    places = np.arange(n + 1)
    row = np.zeros(n + 1, np.int64)
    for i, word in enumerate(item, 1):
        best = np.minimum(row[1:] + 1, row[:-1] + (region != word))
        row = np.minimum.accumulate(np.concatenate([[i], best]) - places) + places
    end = int(row.argmin())
    return int(row[end]), end


@dataclass
class _Size:
    """Items of about one size: n from `least` to `most` words."""

    least: int
    most: int
    edits: int
    gram: int
    need: int
    items: list[int] = field(default_factory=list)
    walks: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    # Without walks: sorted q-grams of the items, and the item each belongs to.
    exact: bool = False
    grams: np.ndarray | None = None
    owners: np.ndarray | None = None


def _gram(n: int, edits: int) -> tuple[int, int]:
    """The longest q up to 3 for which an item keeps a q-gram, and how many it keeps."""
    return next((q, n - q + 1 - edits * q) for q in (3, 2, 1) if n - q + 1 - edits * q >= 1)


class Index:
    """A block of benchmark items, ready to be looked for."""

    def __init__(self, items: list[tuple[int, str | None]], percent: int, min_words: int, recall: float):
        self.ids, self.words, self.edits = [], [], []
        for item_id, text in items:
            words, _ = word_hashes([(text or "").encode().translate(PLAIN_WORDS)])
            if len(words):
                self.ids.append(item_id)
                self.words.append(words)
                self.edits.append(len(words) * (100 - percent) // 100 if len(words) >= min_words else 0)
        self.sizes = self._by_size()
        for size in self.sizes:
            self._sample(size, recall)
        self._grams()

    def _by_size(self) -> list[_Size]:
        """At most 64 sizes, each a tenth wider than it is long, or more where lengths differ a lot."""
        order = sorted(range(len(self.words)), key=lambda i: len(self.words[i]))
        wide = 1.1
        while True:
            sizes: list[_Size] = []
            for i in order:
                n, edits = len(self.words[i]), self.edits[i]
                gram, need = _gram(n, edits)
                if not sizes or n > sizes[-1].least * wide or gram != sizes[-1].gram:
                    sizes.append(_Size(n, n, edits, gram, need))
                last = sizes[-1]
                last.most, last.edits, last.need = n, max(edits, last.edits), min(need, last.need)
                last.items.append(i)
            if len(sizes) <= 64:
                return sizes
            wide *= 1.2

    def _keys(self, words: list[np.ndarray], steps: np.ndarray, walk: int) -> np.ndarray:
        ends = np.cumsum([len(w) for w in words])
        return _walk(np.concatenate(words), ends - [len(w) for w in words], ends, steps, walk)

    def _sample(self, size: _Size, recall: float) -> None:
        """Walks until edited copies of the items are found with the recall; exact if MOST_WALKS do not find them.

        A copy stands in other words and is read as a window of the widest item, from its first word on.
        """
        random = np.random.Generator(np.random.PCG64(size.least))
        items = [self.words[i] for i in size.items]
        if size.most <= LONGEST_WALK and recall <= 1 - 1 / SIMULATED:
            tried = random.integers(len(items), size=SIMULATED)
            copies = [self._edited(items[i], self.edits[size.items[i]], random) for i in tried]
            behind = random.integers(1 << 62, size=size.most).astype(np.uint64)
            windows = [np.concatenate([copy, behind])[: size.most] for copy in copies]
            for sampled in SAMPLED:
                missing, enough = np.ones(SIMULATED, bool), MOST_WALKS
                size.walks = []
                while len(size.walks) < enough:
                    walk = len(size.walks)
                    steps = np.sort(random.choice(max(size.least, sampled), sampled, replace=False))
                    keys = self._keys(items, steps, walk)
                    order = np.argsort(keys, kind="stable")
                    size.walks.append((steps, keys[order], np.array(size.items)[order]))
                    if enough == MOST_WALKS:
                        missing &= keys[tried] != self._keys(windows, steps, walk)
                        if missing.mean() <= 1 - recall:
                            enough = min(int(np.ceil((walk + 1) * (1 + MARGIN))), MOST_WALKS - 1)
                if enough < MOST_WALKS:
                    return
        size.exact, size.walks = True, []
        own = [np.unique(rolling(words, size.gram)) for words in items]
        grams = np.concatenate(own)
        order = np.argsort(grams, kind="stable")
        size.grams = grams[order]
        size.owners = np.repeat(np.arange(len(own), dtype=np.int32), [len(g) for g in own])[order]

    @staticmethod
    def _edited(words: np.ndarray, edits: int, random: np.random.Generator) -> np.ndarray:
        copy = words.tolist()
        for _ in range(edits):
            kind, at = random.integers(3), int(random.integers(max(len(copy), 1)))
            new = int(random.integers(1 << 62))
            if kind == 0:
                copy.insert(at, new)
            elif kind == 1 and copy:
                copy[at] = new
            elif copy:
                del copy[at]
        return np.array(copy, np.uint64)

    def _grams(self) -> None:
        """For each q, sorted hashes of the items' q-grams and the sizes they belong to as bits."""
        self.grams = {}
        for q in {size.gram for size in self.sizes}:
            hashes, masks = [], []
            for bit, size in enumerate(self.sizes):
                if size.gram == q:
                    own = np.unique(np.concatenate([rolling(self.words[i], q) for i in size.items]))
                    hashes.append(own)
                    masks.append(np.full(len(own), 1 << bit, np.uint64))
            hashes, masks = np.concatenate(hashes), np.concatenate(masks)
            order = np.argsort(hashes, kind="stable")
            hashes, masks = hashes[order], masks[order]
            first = np.flatnonzero(np.insert(hashes[1:] != hashes[:-1], 0, True))
            width = max(16, int(len(hashes) * 8).bit_length())
            quick = np.zeros(1 << width, bool)
            quick[(hashes & np.uint64((1 << width) - 1)).astype(np.int64)] = True
            self.grams[q] = (hashes[first], np.bitwise_or.reduceat(masks, first), quick)

    def look_up(self, texts: list[bytes]) -> list[tuple[int, int, int, int]]:
        """(text, item, distance, first word) of every text and item within the edits, its best place."""
        h, counts = word_hashes([t.translate(PLAIN_WORDS) for t in texts])
        ends = np.cumsum(counts)
        owner = np.repeat(np.arange(len(counts)), counts)
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for q, (hashes, masks, quick) in self.grams.items():
            starts, _ = window_starts(counts, q)
            grams = rolling(h, q)[starts]
            maybe = np.flatnonzero(quick[(grams & np.uint64(len(quick) - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(hashes, grams[maybe]), len(hashes) - 1)
            real = hashes[at] == grams[maybe]
            places, kinds, bits = starts[maybe[real]], hashes[at[real]], masks[at[real]]
            for number, size in enumerate(self.sizes):
                if size.gram == q:
                    chosen = bits >> np.uint64(number) & np.uint64(1) > 0
                    self._of_size(size, h, places[chosen], kinds[chosen], owner, ends, best)
        return [(t, i, d, s) for (t, i), (d, s) in best.items()]

    def _of_size(self, size, h, hits, kinds, owner, ends, best) -> None:
        if not len(hits):
            return
        # Starts whose window, as wide as an item may become, holds enough hits.
        reach = size.most + size.edits
        # Each hit adds the starts up to it that the hit before did not; memory is linear in the starts.
        opens = np.maximum(hits - reach + 1, np.concatenate([[0], hits[:-1] + 1]))
        added = hits - opens + 1
        near = np.repeat(opens - np.cumsum(added) + added, added) + np.arange(int(added.sum()))
        stop = np.minimum(near + reach, ends[owner[near]])
        count = np.searchsorted(hits, stop) - np.searchsorted(hits, near)
        enough = count >= size.need
        near, stop = near[enough], ends[owner[near[enough]]]
        if not len(near):
            return
        if size.exact:
            for text in np.unique(owner[near]).tolist():
                self._compare(size, text, h, hits, kinds, ends, best)
            return
        # Walks read only words in some window; those of one window stay together.
        stop = np.minimum(near + size.most, stop)
        cover = np.zeros(len(h) + 1, np.int64)
        np.add.at(cover, near, 1)
        np.subtract.at(cover, stop, 1)
        read = np.cumsum(cover[:-1]) > 0
        words, place = h[read], np.cumsum(read) - 1
        begin, end = place[near], place[stop - 1] + 1
        seen: set[tuple[int, int]] = set()
        for walk, (steps, keys, items) in enumerate(size.walks):
            found = _walk(words, begin, end, steps, walk)
            low, high = np.searchsorted(keys, found), np.searchsorted(keys, found, "right")
            for at in np.flatnonzero(high > low).tolist():
                for item in items[low[at] : high[at]].tolist():
                    start = int(near[at])
                    if (start, item) not in seen:
                        seen.add((start, item))
                        self._verify(item, start, h, owner, ends, best)

    def _compare(self, size, text, h, hits, kinds, ends, best) -> None:
        """Edit distance to each item wherever the text holds enough of the item's own q-grams."""
        begin, stop = int(ends[text - 1]) if text else 0, int(ends[text])
        a, b = np.searchsorted(hits, [begin, stop])
        places = hits[a:b]
        grams, kind, times = np.unique(kinds[a:b], return_inverse=True, return_counts=True)
        low = np.searchsorted(size.grams, grams)
        n_owners = np.searchsorted(size.grams, grams, "right") - low
        shift = np.repeat(low - np.cumsum(n_owners) + n_owners, n_owners)
        owners = size.owners[shift + np.arange(len(shift))]
        of = np.repeat(np.arange(len(grams)), n_owners)
        order = np.argsort(owners, kind="stable")
        owners, of = owners[order], of[order]
        held = np.bincount(owners, times[of], len(size.items))
        for number in np.flatnonzero(held >= size.need).tolist():
            item = size.items[number]
            words, edits = self.words[item], self.edits[item]
            widest = len(words) + edits
            need = len(words) - size.gram + 1 - edits * size.gram
            own = np.zeros(len(grams), bool)
            own[of[slice(*np.searchsorted(owners, [number, number + 1]))]] = True
            mine = places[own[kind]]
            if len(mine) < need:
                continue
            first, last = mine[: len(mine) - need + 1], mine[need - 1 :]
            close = last + size.gram - first <= widest
            # Where passages that hold these q-grams may lie, put together where they overlap.
            lows = np.maximum(last[close] + size.gram - widest, begin)
            highs = np.minimum(first[close] + widest, stop)
            cuts = np.flatnonzero(lows[1:] >= highs[:-1]) + 1
            for at in np.split(np.arange(len(lows)), cuts) if len(lows) else []:
                self._place(item, text, int(lows[at[0]]), int(highs[at[-1]]), begin, h, best)

    def _place(self, item, text, low, high, begin, h, best) -> None:
        """Note the item's best place in h[low:high] if it is within the edits."""
        words, edits = self.words[item], self.edits[item]
        known = best.get((text, item))
        distance, end = _distance(words, h[low:high])
        if distance <= edits:
            back = max(0, end - len(words) - edits)
            backward, length = _distance(words[::-1], h[low + back : low + end][::-1])
            first = low + end - length - begin
            if known is None or (distance, first) < known:
                best[text, item] = (distance, first)

    def _verify(self, item, start, h, owner, ends, best) -> None:
        words, edits, text = self.words[item], self.edits[item], int(owner[start])
        begin = int(ends[text - 1]) if text else 0
        low = max(begin, start - edits)
        known = best.get((text, item))
        if known and known[0] == 0:
            return
        self._place(item, text, low, min(int(ends[text]), start + len(words) + edits), begin, h, best)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    recall: float = RECALL,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pairs of a document and a benchmark item (item_id, text) that it holds.

    Words are runs of ASCII letters and digits and all non-ASCII characters, A-Z
    in lower case. A document holds an item of n words if n * (100 - percent) /
    100 word edits, rounded down, make the item a part of it. Columns: doc_id,
    item_id, distance (of the best place found), first_word (its first word, from
    0), n_item_words. Pairs are found with at least the recall, simulated with
    random edits; unchanged items, and those of sizes whose walks do not reach the
    recall, always.

    Items of fewer than `min_words` words are looked for without edits. Null texts
    and texts without words find and hold nothing; no items, no pairs. Rows that repeat on either side give a pair each.
    Null ids are kept as null. Other columns are not looked at. Reads the
    benchmark when called.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = total // BLOCK_BYTES + 1
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def pass_over(block: int) -> DataFrame:
        chosen = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = sorted(map(tuple, chosen.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        index = shipped(spark, Index(rows, percent, min_words, recall))

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            wanted = index()
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                bodies = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
                for a, b in parts(bodies, PART_BYTES):
                    found = sorted(wanted.look_up(bodies[a:b]))
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array([ids[a + t] for t, *_ in found], pa.int64()),
                            "item_id": pa.array([wanted.ids[i] for _, i, *_ in found], pa.int64()),
                            "distance": pa.array([d for _, _, d, _ in found], pa.int32()),
                            "first_word": pa.array([s for *_, s in found], pa.int64()),
                            "n_item_words": pa.array([len(wanted.words[i]) for _, i, *_ in found], pa.int64()),
                        }
                    )

        return texts.mapInArrow(look, FOUND)

    result = pass_over(0)
    for block in range(1, blocks):
        result = result.unionByName(pass_over(block))
    return result
