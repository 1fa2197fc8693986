"""Hashes of any span of a byte buffer from one prefix sum, in numpy.

The hash of bytes b0..bk is sum(T[bi] * M**i) modulo 2**64, with a random
64-bit value T for each byte value and a random odd M.
"""

from __future__ import annotations

import numpy as np


class SpanHash:
    """Span hashes under one seed; equal spans hash alike at any place in any buffer."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 1 << 64, 256, dtype=np.uint64)
        self.base = int(rng.integers(0, 1 << 64, dtype=np.uint64)) | 1
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            for name, base in (("up", self.base), ("down", pow(self.base, -1, 1 << 64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """Running sums over a uint8 buffer, to be handed to ``spans``."""
        self._powers(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.up[: len(data)], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (prefix[end] - prefix[start]) * self.down[start]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection on uint64 that spreads every input bit (the splitmix64 finaliser)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def slices(sizes: list[int], limit: int):
    """Index ranges of consecutive items whose sizes add up to about ``limit`` at most; a larger item stands alone."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)
