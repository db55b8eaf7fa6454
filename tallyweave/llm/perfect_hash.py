"""Minimal perfect hashing of 128-bit keys, in numpy.

Level by level every key not yet placed picks a bit; keys that are alone on theirs are placed,
the others go on to the next level. The slot of a key is the number of set bits before its own,
so ``n`` keys get the slots 0 to n - 1. A key that was never stored finds no set bit or the slot
of another; a stored fingerprint tells.
"""

from __future__ import annotations

import numpy as np

BITS_PER_KEY = 2
MAX_LEVELS = 64


def _mixed(high: np.ndarray, low: np.ndarray, level: int) -> np.ndarray:
    x = high + low * np.uint64(2 * level + 1) + np.uint64((level * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return (_mixed(low, high, MAX_LEVELS + 1) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """``levels``: for each level its bits, one to a byte, and the slots taken before it."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks = []
        before = 0
        for bits in levels:
            self.ranks.append(before + np.cumsum(bits, dtype=np.int64) - bits)
            before += int(bits.sum())
        self.size = before

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray) -> PerfectHash:
        """Of distinct keys; two equal ones would never part, and raise."""
        levels = []
        for level in range(MAX_LEVELS):
            if not len(high):
                return cls(levels)
            width = max(8, BITS_PER_KEY * len(high))
            at = (_mixed(high, low, level) % np.uint64(width)).astype(np.int64)
            alone = np.bincount(at, minlength=width) == 1
            levels.append(alone.astype(np.uint8))
            rest = ~alone[at]
            high, low = high[rest], low[rest]
        raise ValueError("keys are not distinct")

    def slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where no level has its bit."""
        out = np.full(len(high), -1, np.int64)
        rest = np.arange(len(high))
        for level, bits in enumerate(self.levels):
            if not len(rest):
                break
            at = (_mixed(high[rest], low[rest], level) % np.uint64(len(bits))).astype(np.int64)
            found = bits[at] == 1
            out[rest[found]] = self.ranks[level][at[found]]
            rest = rest[~found]
        return out
