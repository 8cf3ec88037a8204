"""Word shingles of whole texts as 64-bit hashes, over the bytes of many texts at once."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(2024).integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACES = np.random.default_rng(7).integers(1, 1 << 63, 16, dtype=np.uint64) | np.uint64(1)
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_SPAN = 1 << 18


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, b, dtype=np.uint64))]) for b in (_BASE, _INVERSE))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of a public hash)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word (run without white space) and the number of words of each text."""
    inside = ~_WHITE[data]
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    cut = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    before[cut] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    after[cut - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    counts = np.searchsorted(starts, offsets[1:]) - np.searchsorted(starts, offsets[:-1])
    out = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):  # about 256 kB at a time, or one longer word
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + _SPAN, side="right")))
        a, b = starts[first], ends[last - 1]
        size = max(_SPAN, int(b - a))
        power, inverse = _powers(size)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data[a:b]] * power[: b - a])])
        s, e = starts[first:last] - a, ends[first:last] - a
        out[first:last] = mixed((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
        first = last
    return out, counts


def shingles(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingles of ``k`` words of each text. A text of fewer words has
    one shingle of all its words; a text without words has none."""
    w, counts = words(data, offsets)
    ends = np.cumsum(counts)
    n = max(0, len(w) - k + 1)
    runs = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        runs += w[j : j + n] * _PLACES[j]
    runs = mixed(runs)
    out = []
    for c, e in zip(counts.tolist(), ends.tolist(), strict=True):
        if c >= k:
            out.append(np.unique(runs[e - c : e - k + 1]))
        elif c:
            out.append(mixed((w[e - c : e] * _PLACES[:c]).sum(dtype=np.uint64, keepdims=True) + np.uint64(c)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def slices(offsets: np.ndarray, span: int = 4 * _SPAN):
    """(first, end) of runs of texts with about ``span`` bytes."""
    first = 0
    while first < len(offsets) - 1:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + span, side="right")) - 1)
        yield first, end
        first = end
