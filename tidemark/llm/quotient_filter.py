"""Counting quotient filters of packed ids, as sorted arrays.

A key is k 64-bit ids. A permutation of all 64k-bit numbers, which can be undone,
spreads the keys evenly; the top bits of the permuted key are its quotient and
all others its remainder. A filter is sorted by permuted key: per quotient it
holds the length of its run, per key the whole remainder and a counter. Nothing
is lost, so keys and counts come back exactly, and filters of one range of
quotients merge like sorted lists.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tidemark.llm.hashing import mixed

ROUNDS = 2
_LARGE = 255  # an entry of one byte that stands for a number in the list of large ones


def _others(columns: list[np.ndarray], i: int) -> np.ndarray:
    total = np.full(len(columns[i]), len(columns), np.uint64)
    for j, column in enumerate(columns):
        if j != i:
            turn = np.uint64(7 + 13 * j)
            total = total + ((column << turn) | (column >> (np.uint64(64) - turn)))
    return total


def permuted(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Spread keys: each id in turn is changed by a hash of the others (a Feistel network)."""
    columns = [mixed(c, 11) for c in columns]
    for step in range(ROUNDS):
        for i in range(len(columns)):
            if len(columns) > 1:
                columns[i] = columns[i] ^ mixed(_others(columns, i), 17 + step)
    return columns


def _unmixed(values: np.ndarray, seed: int) -> np.ndarray:
    """What `mixed` made the values from."""
    x = values ^ (values >> np.uint64(31)) ^ (values >> np.uint64(62))
    x = x * np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    x = x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))
    x = x * np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    x = x ^ (x >> np.uint64(30)) ^ (x >> np.uint64(60))
    return x - np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & ((1 << 64) - 1))


def restored(columns: list[np.ndarray]) -> list[np.ndarray]:
    """The keys that `permuted` was given."""
    columns = list(columns)
    for step in reversed(range(ROUNDS)):
        for i in reversed(range(len(columns))):
            if len(columns) > 1:
                columns[i] = columns[i] ^ mixed(_others(columns, i), 17 + step)
    return [_unmixed(c, 11) for c in columns]


def _bytes_or_large(values: np.ndarray) -> tuple[bytes, bytes]:
    large = values >= _LARGE
    return np.where(large, _LARGE, values).astype(np.uint8).tobytes(), values[large].astype(np.uint64).tobytes()


def _from_bytes(small: np.ndarray, large: np.ndarray) -> np.ndarray:
    values = small.astype(np.uint64)
    values[small == _LARGE] = large
    return values


@dataclass(frozen=True)
class Filter:
    """Permuted keys in order, each once, and their counts."""

    columns: list[np.ndarray]
    counts: np.ndarray

    def __len__(self) -> int:
        return len(self.counts)

    @staticmethod
    def of(columns: list[np.ndarray], counts: np.ndarray) -> Filter:
        """The filter of permuted keys in any order, equal ones added up."""
        if not len(counts):
            return Filter(columns, counts)
        order = np.argsort(columns[0])
        ordered = [c[order] for c in columns]
        same = ordered[0][1:] == ordered[0][:-1]
        split = np.zeros(len(same), bool)
        for c in ordered[1:]:
            split |= c[1:] != c[:-1]
        if (same & split).any():  # keys that share their first 64 bits may lie mixed
            order = np.lexsort(columns[::-1])
            ordered = [c[order] for c in columns]
            same = ordered[0][1:] == ordered[0][:-1]
            for c in ordered[1:]:
                same &= c[1:] == c[:-1]
        first = np.flatnonzero(np.concatenate([[True], ~same]))
        return Filter([c[first] for c in ordered], np.add.reduceat(counts[order], first))

    @staticmethod
    def merged(filters: list[Filter]) -> Filter:
        """One filter with the counts of all; there must be one at least."""
        columns = [np.concatenate(parts) for parts in zip(*(f.columns for f in filters))]
        return Filter.of(columns, np.concatenate([f.counts for f in filters]))

    def shards(self, bits: int) -> list[tuple[int, Filter]]:
        """The parts whose first `bits` bits of the quotient agree, those that hold keys."""
        number = (self.columns[0] >> np.uint64(64 - bits)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(number)) + 1
        edges = [0, *cuts.tolist(), len(number)]
        return [
            (int(number[a]), Filter([c[a:b] for c in self.columns], self.counts[a:b]))
            for a, b in zip(edges, edges[1:])
            if b > a
        ]

    def packed(self, bits: int) -> bytes:
        """The filter of one shard: run lengths by quotient, remainders, counters."""
        n = len(self)
        quotient = -bits % 8
        while quotient + 8 < min(n.bit_length() + 1, 24):
            quotient += 8
        rest = (64 - bits - quotient) // 8
        head = (self.columns[0] << np.uint64(bits)) >> np.uint64(64 - quotient) if quotient else np.zeros(n, np.uint64)
        runs = np.bincount(head.astype(np.int64), minlength=1 << quotient)
        run_bytes, large_runs = _bytes_or_large(runs)
        count_bytes, large_counts = _bytes_or_large(self.counts)
        remainder = self.columns[0].astype("<u8").view(np.uint8).reshape(n, 8)[:, :rest].tobytes()
        sizes = np.array([n, quotient, len(large_runs) // 8, len(large_counts) // 8], "<u4")
        whole = [c.astype("<u8").tobytes() for c in self.columns[1:]]
        return b"".join([sizes.tobytes(), run_bytes, large_runs, remainder, *whole, count_bytes, large_counts])

    @staticmethod
    def unpacked(payload: bytes, shard: int, bits: int, ids: int) -> Filter:
        n, quotient, large_runs, large_counts = np.frombuffer(payload, "<u4", 4).tolist()
        at = 16

        def taken(size: int, kind: str) -> np.ndarray:
            nonlocal at
            values = np.frombuffer(payload, kind, size, at)
            at += values.nbytes
            return values

        run_bytes = taken(1 << quotient, "u1")
        runs = _from_bytes(run_bytes, taken(large_runs, "<u8"))
        rest = (64 - bits - quotient) // 8
        first = np.zeros((n, 8), np.uint8)
        first[:, :rest] = taken(n * rest, "u1").reshape(n, rest)
        head = np.repeat(np.arange(1 << quotient, dtype=np.uint64), runs.astype(np.int64))
        top = head + np.uint64(shard << quotient)
        shift = np.uint64(64 - bits - quotient)
        first = first.reshape(-1).view("<u8") + (top << shift if bits + quotient else np.uint64(0))
        whole = [taken(n, "<u8") for _ in range(ids - 1)]
        count_bytes = taken(n, "u1")
        return Filter([first, *whole], _from_bytes(count_bytes, taken(large_counts, "<u8")))
