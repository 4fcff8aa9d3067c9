"""Content-defined anchors: where equal windows of bytes must meet.

Every window of ``length`` bytes holds ``length - gram + 1`` grams; its anchor is the gram with the smallest hash, the
leftmost of equals. Equal windows have equal anchors at equal places. Windows that start one after another mostly share
their anchor, so a text falls into segments: an anchor with all the windows that chose it.
"""

from __future__ import annotations

import numpy as np

#: Bytes of the grams that anchors are chosen among.
GRAM = 64
_MIX = np.random.default_rng(2024).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A polynomial hash of each gram, by doubling; gram is a power of two."""
    h, n, base = _MIX[data], 1, _BASE
    while n < gram:
        h = h[:-n] * np.uint64(base) + h[n:]
        base, n = base * base % (1 << 64), 2 * n
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def segments(data: np.ndarray, length: int = 200, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start of the first window, number of windows, place of the anchor, its hash) of each segment of a text's bytes."""
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    h = gram_hashes(data, gram)
    width = length - gram + 1
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    least, n = key, 1
    while 2 * n <= width:
        least = np.minimum(least[:-n], least[n:])
        n *= 2
    if n < width:
        least = np.minimum(least[: len(key) - width + 1], least[width - n :])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    count = np.diff(np.append(first, len(at)))
    return first, count, at[first], h[at[first]]
