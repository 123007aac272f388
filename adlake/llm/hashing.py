"""Words of texts as arrays: boundaries and 64-bit hashes, without a Python step per word."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

PIECE = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
STEP = np.uint64(0xD6E8FEB86659FD93)


def fold_table(kept: bytes, lower: bool = True) -> np.ndarray:
    """A byte for each byte: itself (A-Z lower-cased) inside a word, 0 outside."""
    table = np.zeros(256, np.uint8)
    for b in kept:
        table[b] = b + 32 if lower and 65 <= b <= 90 else b
    return table


# Digits, letters and all that is not ASCII.
ALNUM = fold_table(bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * STEP
    return h ^ (h >> np.uint64(29))


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    return tuple(
        np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(PIECE, b, np.uint64)]))
        for b in (BASE, BASE_INVERSE)
    )


def word_spans(folded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(folded) + 2, np.int8)
    inside[1:-1] = folded != 0
    edges = np.flatnonzero(np.diff(inside))
    return edges[::2], edges[1::2]


def word_hashes(folded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes, alike wherever the word stands.

    Works on about a MiB at a time, so that memory does not grow with the text.
    """
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        begin = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, begin + PIECE, "right")))
        length = int(ends[last - 1] - begin)
        if length > PIECE:  # one word longer than a piece
            h = 0
            for byte in folded[begin : begin + length][::-1].tolist():
                h = (h * int(BASE) + byte) & 0xFFFFFFFFFFFFFFFF
            out[first] = h
        else:
            power, inverse = _powers()
            sums = np.zeros(length + 1, np.uint64)
            np.cumsum(folded[begin : begin + length] * power[:length], out=sums[1:])
            s, e = starts[first:last] - begin, ends[first:last] - begin
            out[first:last] = (sums[e] - sums[s]) * inverse[s]
        first = last
    return mix(out)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` word hashes."""
    n = max(0, len(words) - k + 1)
    out = words[:n].copy()
    for j in range(1, k):
        out = out * BASE + words[j : j + n]
    return mix(out)
