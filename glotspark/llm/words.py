"""Words and hashes of words over UTF-8 bytes, vectorized over many texts at a time."""

from __future__ import annotations

import functools

import numpy as np

# The bytes between words, [\x20\x09-\x0D].
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[list(SPACES)] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64-bit values; works on a copy."""
    values = values ^ (values >> np.uint64(33))
    values *= np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    values ^= values >> np.uint64(33)
    return values


@functools.lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def series(base: int) -> np.ndarray:
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    return series(_BASE), series(pow(_BASE, -1, 1 << 64))


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    up, down = _powers(max(1 << 20, 1 << (size - 1).bit_length() if size > 1 else 1))
    return up[:size], down[:size]


# A random value for every byte, so that sums over bytes are hard to cancel.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """Sums ``P`` with one entry more than bytes; ``span_hashes`` turns two into a span's hash."""
    up, _ = powers(len(values))
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[values] * up, out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``bytes[start:end]``; equal bytes have equal hashes wherever they stand."""
    _, down = powers(len(sums))
    spans = (sums[ends] - sums[starts]) * down[starts]
    return mix(spans + (ends - starts).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))


def word_spans(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(starts, ends)`` of all words; none crosses the start of a text."""
    inside = _IS_WORD[values]
    if not len(inside):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cut = np.zeros(len(inside) + 1, dtype=bool)
    cut[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | cut[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def shingle_sets(
    values: np.ndarray, offsets: np.ndarray, size: int = 5
) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, bounds)``: the sorted distinct hashes of ``size``-word shingles of every text.

    ASCII capitals count as small letters. A text with fewer words has all of them as its one
    shingle, a text without words none. Text ``i`` has ``hashes[bounds[i]:bounds[i + 1]]``.
    """
    values = LOWER[values]
    starts, ends = word_spans(values, offsets)
    words = span_hashes(prefix_hashes(values), starts, ends)
    first = np.searchsorted(starts, offsets)  # of every text, among the words
    counts = np.diff(first)
    factors = mix(np.arange(1, size + 1, dtype=np.uint64))  # odd or not, each word's place counts
    rolled = np.zeros(max(0, len(words) - size + 1), dtype=np.uint64)
    for place in range(size):
        rolled += mix(words[place : place + len(rolled)] + factors[place])
    rolled = mix(rolled)
    sets: list[np.ndarray] = []
    for begin, count in zip(first[:-1].tolist(), counts.tolist()):
        if count >= size:
            sets.append(np.unique(rolled[begin : begin + count - size + 1]))
        elif count:
            short = mix(words[begin : begin + count] + factors[:count]).sum(dtype=np.uint64)
            sets.append(mix(np.array([short + np.uint64(count)], dtype=np.uint64)))
        else:
            sets.append(np.empty(0, dtype=np.uint64))
    bounds = np.concatenate(([0], np.cumsum([len(each) for each in sets]))).astype(np.int64)
    return np.concatenate(sets) if sets else np.empty(0, np.uint64), bounds
