"""Elias-Fano sequences: monotone whole numbers in about 2 + log2(universe / n) bits each, read in place.

A value's low bits are packed side by side; its high part is written in unary into a bit vector (the i-th value
sets bit high + i).  A directory holds the ones before every 64 bits, for reads by index, or the zeros, for searches.
All reads take many positions at a time and work on the arrays as they are: of a mapped sequence nothing is copied.
"""

from __future__ import annotations

import numpy as np

from martkit.llm.common import U64

# position of the r-th one in a byte
_SELECT = np.full((256, 8), 8, np.uint8)
for _b in range(256):
    for _r, _p in enumerate(p for p in range(8) if _b >> p & 1):
        _SELECT[_b, _r] = _p
_SELECT = _SELECT.ravel()  # at 8 * byte + r


BLOCK = 1 << 16  # values encoded at a time; a multiple of 64, so a block's low bits begin a word


def _or_into(words: np.ndarray, index: np.ndarray, values: np.ndarray) -> None:
    """Or every value into its word; ``index`` ascends."""
    if len(index):
        new = np.flatnonzero(np.append(True, index[1:] != index[:-1]))
        words[index[new]] |= np.bitwise_or.reduceat(values, new)


_EACH, _TOP = U64(0x0101010101010101), U64(0x8080808080808080)  # the lowest and highest bit of every byte


def _select_in_word(word: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Position of the r-th one (from 0) of each word, all bytes of a word at a time."""
    r = r.astype(U64)
    s = word - ((word >> U64(1)) & U64(0x5555555555555555))
    s = (s & U64(0x3333333333333333)) + ((s >> U64(2)) & U64(0x3333333333333333))
    s = ((s + (s >> U64(4))) & U64(0x0F0F0F0F0F0F0F0F)) * _EACH  # ones up to and with each byte
    past = (((r * _EACH) | _TOP) - s) & _TOP                     # bytes that end before the r-th one
    place = np.bitwise_count(past).astype(U64) << U64(3)
    left = r - (((s << U64(8)) >> place) & U64(0xFF))
    byte = (word >> place) & U64(0xFF)
    return place.view(np.int64) + _SELECT.take(((byte << U64(3)) | left).view(np.int64))


class EliasFano:
    """``EliasFano.encode`` gives the arrays that the constructor takes, so they may lie in a mapped file."""

    ACCESS, SEARCH = ("ones",), ("zeros",)  # directories that reads by index need, and searches

    def __init__(self, head: np.ndarray, low: np.ndarray, high: np.ndarray, ones: np.ndarray | None = None,
                 zeros: np.ndarray | None = None):
        self.n, self.bits = int(head[0]), int(head[1])
        self.low, self.high, self.ones, self.zeros = low, high, ones, zeros

    @staticmethod
    def encode(values: np.ndarray, universe: int, directories: tuple[str, ...] = ACCESS + SEARCH
               ) -> dict[str, np.ndarray]:
        """``values`` ascend (equal ones allowed) and lie below ``universe``."""
        n = len(values)
        bits = max(0, (universe // max(1, n)).bit_length() - 1)
        tops = (universe >> bits) + 1
        words = (n + tops + 64) // 64 + 1
        high, packed = np.zeros(words, U64), np.zeros(n * bits // 64 + 2, U64)
        for a in range(0, n, BLOCK):
            part = values[a:a + BLOCK].astype(U64)
            index = np.arange(a, a + len(part), dtype=np.int64)
            place = (part >> U64(bits)).astype(np.int64) + index
            _or_into(high, place >> 6, U64(1) << (place & 63).astype(U64))
            if bits:
                low = part & U64((1 << bits) - 1)
                word, shift = (index * bits) >> 6, ((index * bits) & 63).astype(U64)
                _or_into(packed, word, low << shift)
                over = np.flatnonzero(shift + U64(bits) > U64(64))
                _or_into(packed, word[over] + 1, low[over] >> (U64(64) - shift[over]))
        ones = np.append(0, np.cumsum(np.bitwise_count(high), dtype=np.int64))
        before = {"ones": ones, "zeros": np.arange(len(ones), dtype=np.int64) * 64 - ones}
        kind = np.uint32 if words * 64 < 1 << 32 else U64
        return {"head": np.array([n, bits], U64), "low": packed, "high": high,
                **{name: before[name].astype(kind) for name in directories}}

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), U64)
        at = i * self.bits
        word, shift = at >> 6, (at & 63).astype(U64)
        out = self.low[word] >> shift
        out |= self.low[word + 1] << U64(1) << (U64(63) - shift)  # nothing for a shift of 0
        out &= U64((1 << self.bits) - 1)
        return out

    def _select(self, k: np.ndarray, before: np.ndarray, flip: bool) -> np.ndarray:
        """Place of the k-th one (zero if ``flip``) of the high bits."""
        word = np.searchsorted(before, k.astype(before.dtype), side="right") - 1  # of another type it copies ``before``
        value = self.high[word]
        return word * 64 + _select_in_word(~value if flip else value, k - before[word].astype(np.int64))

    def access(self, i: np.ndarray) -> np.ndarray:
        """The i-th values."""
        i = i.astype(np.int64)
        if not len(i):
            return np.zeros(0, U64)
        top = self._select(i, self.ones, False) - i
        return (top.astype(U64) << U64(self.bits)) | self._low(i)

    def access_next(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The i-th values and those after them: the next one bit is mostly in the same word."""
        i = i.astype(np.int64)
        if not len(i):
            return np.zeros(0, U64), np.zeros(0, U64)
        at = self._select(i, self.ones, False)
        word = self.high[at >> 6]
        rest = word & (~U64(0) << (at & 63).astype(U64)) & ~(U64(1) << (at & 63).astype(U64))
        low = rest & (~rest + U64(1))
        nxt = (at & ~63) + np.bitwise_count(low - U64(1)).astype(np.int64)
        far = np.flatnonzero(rest == 0)
        nxt[far] = self._select(i[far] + 1, self.ones, False)
        tops = [(x.astype(U64) << U64(self.bits)) | self._low(k) for x, k in ((at - i, i), (nxt - i - 1, i + 1))]
        return tops[0], tops[1]

    def _bucket(self, x: np.ndarray, lo: np.ndarray | None, hi: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Index range of the values that share the high part of each x, within [lo, hi) if given."""
        top = (x >> U64(self.bits)).astype(np.int64)
        at = np.zeros(len(x), np.int64)  # place after the zero that closes the high part before
        some = slice(None) if len(top) and top.min() else np.flatnonzero(top)
        at[some] = self._select(top[some] - 1, self.zeros, True) + 1
        begin = at - top
        inside = at & 63
        run = self.high[at >> 6] >> inside.astype(U64)
        ones = np.bitwise_count(run & ~(run + U64(1))).astype(np.int64)
        end = begin + ones
        far = np.flatnonzero(ones + inside == 64)  # the ones may go on in the next word
        end[far] = self._select(top[far], self.zeros, True) - top[far]
        return (begin, end) if lo is None else (np.maximum(begin, lo), np.minimum(end, hi))

    def find(self, x: np.ndarray, lo: np.ndarray | None = None, hi: np.ndarray | None = None
             ) -> tuple[np.ndarray, np.ndarray]:
        """(index of a value that equals x, whether there is one; else any index), within [lo, hi) if given."""
        x = x.astype(U64, copy=False)
        if not len(x) or not self.n:
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        at, end = self._bucket(x, lo, hi)
        some = at < end
        if self.bits:
            want = x & U64((1 << self.bits) - 1)
            live = np.flatnonzero(end - at > 1)
            left, right, goal = at[live], end[live], want[live]
            while len(live):  # the last value that is not larger
                mid = (left + right) >> 1
                up = self._low(mid) <= goal
                left, right = np.where(up, mid, left), np.where(up, right, mid)
                at[live] = left
                more = np.flatnonzero(right - left > 1)
                live, left, right, goal = live[more], left[more], right[more], goal[more]
            some &= self._low(np.minimum(at, self.n - 1)) == want
        return at, some

    def successor(self, x: np.ndarray, lo: np.ndarray | None = None,
                  hi: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first value >= x, whether it equals x), within the index ranges [lo, hi) if given."""
        x = x.astype(U64)
        if not len(x) or not self.n:
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        begin, end = self._bucket(x, lo, hi)
        want = x & U64((1 << self.bits) - 1) if self.bits else np.zeros(len(x), U64)
        # binary search on the low bits of the values that share the high part
        left, right = begin.copy(), np.maximum(begin, end)
        live = np.flatnonzero(left < right)
        while len(live):
            mid = (left[live] + right[live]) >> 1
            less = self._low(mid) < want[live]
            left[live] = np.where(less, mid + 1, left[live])
            right[live] = np.where(less, right[live], mid)
            live = live[left[live] < right[live]]
        found = left < end
        at = np.flatnonzero(found)
        found[at] = self._low(left[at]) == want[at]
        return left, found
