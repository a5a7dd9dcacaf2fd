"""Rolling hashes of all windows of a sequence, as wrapped 64-bit polynomials in numpy.

With prefix[i] = sum of code[k] * B**k over k < i, the window of length L at p has the hash
(prefix[p + L] - prefix[p]) * B**-p, for every p and any L in a few vector operations. Codes are
random 64-bit numbers, bases odd; two hashes with different codes and bases make 128 bits.
"""

from __future__ import annotations

import numpy as np

MASK = (1 << 64) - 1


class Rolling:
    """Hashes by one base; ``limit`` is the longest sequence that ``prefix`` takes."""

    def __init__(self, base: int, seed: int, limit: int) -> None:
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.codes = np.random.default_rng(seed).integers(0, 1 << 64, 256, dtype=np.uint64)
        self.limit, self.up, self.down = limit, np.zeros(0, np.uint64), np.zeros(0, np.uint64)

    def _powers(self, n: int) -> None:
        if n > len(self.up):
            size = min(self.limit + 1, max(n, 2 * len(self.up), 4096))
            self.up = np.cumprod(np.concatenate(([np.uint64(1)], np.full(size - 1, self.base))))
            self.down = np.cumprod(np.concatenate(([np.uint64(1)], np.full(size - 1, self.inverse))))

    def prefix(self, codes: np.ndarray) -> np.ndarray:
        self._powers(len(codes) + 1)
        out = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * self.up[: len(codes)], out=out[1:])
        return out

    def windows(self, prefix: np.ndarray, length: int) -> np.ndarray:
        """Hash of the window of ``length`` at every place where it fits."""
        n = len(prefix) - length
        return (prefix[length:] - prefix[:n]) * self.down[:n]

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (prefix[end] - prefix[start]) * self.down[start]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads all bits (the low bits of a polynomial depend on few bits)."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def runs(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Half-open intervals merged where they overlap or touch, in order."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate(([True], start[1:] > reach[:-1]))
    return start[new], reach[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(reach) - 1]))]


def ranges(low: np.ndarray, count: np.ndarray) -> np.ndarray:
    """low[0], low[0] + 1, ... (count[0] of them), then the same for each next pair."""
    ends = np.cumsum(count)
    return np.repeat(low - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)
