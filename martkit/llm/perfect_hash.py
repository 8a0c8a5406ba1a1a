"""Minimal perfect hashing of distinct 128-bit keys by cascaded bit arrays, built and probed with whole arrays.

Level by level, every key that is still left takes a place in a bit array of as many bits as keys are left; keys that
are alone at their place set its bit, the others go to the next level.  A key's slot is the number of set bits before
its own, so n keys take the slots 0 to n-1, at about three bits a key.  A key that was not built in may get the slot of
another or none (-1); the caller keeps a fingerprint for each slot.
"""

from __future__ import annotations

import numpy as np

from martkit.llm.common import U64, mix64

_MAX_LEVELS = 64


def _place(high: np.ndarray, low: np.ndarray, level: int, words: int) -> np.ndarray:
    """Bit of every key in a level of ``words`` 64-bit words."""
    h = mix64(low ^ mix64(high + U64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)))
    return ((h >> U64(32)) * U64(words * 64) >> U64(32)).astype(np.int64)


class PerfectHash:
    """``PerfectHash.build`` gives the arrays that the constructor takes, so they may lie in a mapped file."""

    NAMES = ("words", "bits", "rank")

    def __init__(self, words: np.ndarray, bits: np.ndarray, rank: np.ndarray):
        """``words``: 64-bit words of every level; ``bits``: all levels; ``rank``: set bits before every word."""
        self.words, self.bits, self.rank = words, bits, rank

    @staticmethod
    def build(high: np.ndarray, low: np.ndarray) -> dict[str, np.ndarray]:
        """Arrays for distinct keys (two 64-bit halves each)."""
        words, levels = [], []
        while len(high):
            if len(words) == _MAX_LEVELS:
                raise ValueError("keys are not distinct")
            size = max(1, -(-len(high) // 64))
            at = _place(high, low, len(words), size)
            alone = np.bincount(at, minlength=size * 64) == 1
            levels.append(np.packbits(alone, bitorder="little").view(U64))
            words.append(size)
            left = ~alone[at]
            high, low = high[left], low[left]
        bits = np.concatenate(levels) if levels else np.zeros(0, U64)
        count = np.bitwise_count(bits).astype(np.int64)
        return {"words": np.array(words, np.int64), "bits": bits, "rank": np.cumsum(count) - count}

    def slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Slot of every key; -1 where no level has a bit for it."""
        out = np.full(len(high), -1, np.int64)
        left, start = np.arange(len(high)), 0
        for level, size in enumerate(self.words.tolist()):
            if not len(left):
                break
            at = _place(high[left], low[left], level, size)
            word, bit = (at >> 6) + start, (at & 63).astype(U64)
            value = self.bits[word]
            hit = (value >> bit) & U64(1) == U64(1)
            below = value[hit] & ((U64(1) << bit[hit]) - U64(1))
            out[left[hit]] = self.rank[word[hit]] + np.bitwise_count(below)
            left, start = left[~hit], start + size
        return out
