"""Words of texts as numbers, inside tasks: 64-bit word hashes and hashes of rolling windows."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

# A-Z to a-z, letters and digits kept, every other ASCII character to a space: runs of
# what is left are the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of the lower-cased text.
PLAIN_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
# Bytes of text that are hashed at a time.
BLOCK = 1 << 18
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTES = np.random.Generator(np.random.PCG64(1)).integers(0, 1 << 64, 256, np.uint64)


def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i modulo 2 ** 64, for an odd base."""
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[:1] = down[:1] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def word_hashes(texts: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words of each text.

    Words are runs of bytes other than space and \\t\\n\\v\\f\\r. A word's hash is a
    polynomial of random numbers for its bytes, from differences of running sums.
    """
    texts = list(texts)
    raw = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    up, down = _powers(min(len(raw), BLOCK), _BASE)
    hashes, starts = [], []
    a = 0
    while a < len(raw):
        b = min(a + BLOCK, len(raw))
        space = _SPACE[raw[a:b]]
        if b < len(raw):  # end behind a space; a word longer than a block makes a longer block
            spaces = np.flatnonzero(space)
            while not len(spaces):
                b = min(b + BLOCK, len(raw))
                spaces = np.flatnonzero(_SPACE[raw[a:b]])
            b = a + int(spaces[-1]) + 1
            space = _SPACE[raw[a:b]]
        n = b - a
        if n > len(up):
            up, down = _powers(n, _BASE)
        edges = np.flatnonzero(np.diff(space, prepend=True))
        first, last = edges[::2], edges[1::2]
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[raw[a:b]] * up[:n], out=sums[1:])
        hashes.append((sums[last] - sums[first]) * down[first])
        starts.append(first + a)
        a = b
    if not texts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    counts = np.diff(np.searchsorted(np.concatenate(starts), bounds))
    return mixed(np.concatenate(hashes)), counts


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """Well spread 64-bit values from 64-bit values, one to one for each seed."""
    x = values + np.uint64((seed * _BASE + 0x632BE59BD9B4E019) & _MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and factors that give the hash of any bytes a to b: (sums[b] - sums[a]) * factors[a], to be mixed."""
    up, down = _powers(len(raw), _BASE)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTES[raw] * up, out=sums[1:])
    return sums, down


def rolling(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of each window of k words, by its first word; len - k + 1 values."""
    n = len(hashes)
    if n < k:
        return np.empty(0, np.uint64)
    up, down = _powers(n, (_BASE * (2 * seed + 1)) & _MASK | 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed(hashes, seed) * up, out=sums[1:])
    return mixed((sums[k:] - sums[:-k]) * down[: n - k + 1], seed)


def runs(ordered: np.ndarray) -> np.ndarray:
    """True where a sorted array has a new value."""
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return new


def by_small(order: np.ndarray, keys: np.ndarray, most: int) -> np.ndarray:
    """The order sorted by keys from 0 to `most`, else as it was."""
    small = keys[order].astype(np.uint16 if most < 1 << 16 else np.uint64)
    return order[np.argsort(small, kind="stable")]


def window_starts(counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Where windows of k words start that lie within one text, and the text of each."""
    ends = np.cumsum(counts)
    n = int(ends[-1]) if len(ends) else 0
    text = np.repeat(np.arange(len(counts)), counts)
    starts = np.flatnonzero(text[k - 1 :] == text[: n - k + 1]) if n >= k else np.empty(0, np.int64)
    return starts, text[starts] if len(starts) else np.empty(0, np.int64)
