"""Elias-Fano sequences and a two-level n-gram trie in numpy, memory-mapped.

A sorted sequence is split into low bits, packed one after the other, and high
bits, written in unary as a bit vector.  Looking up a value selects the zero
that ends the previous high part (its bucket starts there) and searches the few
low parts of the bucket.  All look-ups are vectorised.
"""

from __future__ import annotations

import tempfile

import numpy as np

_CHUNK = 1 << 16


class Mapped:
    """Arrays written to one temporary file without a name and mapped back: the
    pages belong to the file cache and the file ends with the mapping."""

    def __init__(self, arrays: list[np.ndarray]):
        with tempfile.TemporaryFile() as f:
            places, at = [], 0
            for a in arrays:
                f.write(a.tobytes())
                f.write(bytes(-a.nbytes % 8 + 8))  # whole words, and one to read over the end
                places.append((at, a.dtype, a.shape))
                at += a.nbytes + (-a.nbytes % 8) + 8
            f.flush()
            self.data = np.memmap(f, np.uint8, "r", shape=(at,))
        self.arrays = [np.ndarray(shape, dtype, self.data, place) for place, dtype, shape in places]


def _nth_bit(words: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Position of the n-th (from 0) set bit of each word."""
    bits = np.unpackbits(words.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return (np.cumsum(bits, axis=1, dtype=np.uint8) == (n[:, None] + 1)).argmax(axis=1)


class EliasFano:
    """A non-decreasing sequence of unsigned 64-bit numbers."""

    def __init__(self, values: np.ndarray):
        values = values.astype(np.uint64)
        self.n = n = len(values)
        span = int(values[-1]) + 1 if n else 1
        self.bits = bits = min(56, max(0, (span // max(n, 1)).bit_length() - 1))
        high = (values >> np.uint64(bits)).astype(np.int64)
        self.top = int(high[-1]) if n else 0
        unary = np.zeros(self.top + n + 1 + 63 >> 6 << 6, np.uint8)
        unary[high + np.arange(n)] = 1
        upper = np.packbits(unary, bitorder="little").view(np.uint64)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(upper).astype(np.int64))])
        packed = [np.empty(0, np.uint8)]
        for at in range(0, n, _CHUNK):
            low = values[at:at + _CHUNK, None] >> np.arange(bits, dtype=np.uint64)[None, :]
            packed.append(np.packbits((low & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little"))
        self._map = Mapped([upper, ones, np.concatenate(packed)])
        self.upper, self.ones, low = self._map.arrays
        # overlapping words, one from every byte on
        self._words = np.ndarray((low.nbytes + 1,), np.uint64, low.base, low.__array_interface__["data"][0]
                                 - self._map.data.__array_interface__["data"][0], (1,))

    def _low(self, i: np.ndarray) -> np.ndarray:
        at = i * self.bits
        word = self._words[at >> 3] >> (at & 7).astype(np.uint64)
        return word & np.uint64((1 << self.bits) - 1)

    def _start(self, high: np.ndarray) -> np.ndarray:
        """Index of the first element whose high part is ``high`` or more."""
        out = np.zeros(len(high), np.int64)
        zeros = np.arange(len(self.ones)) * 64 - self.ones
        at = np.flatnonzero(high > 0)
        for lo in range(0, len(at), _CHUNK):
            part = at[lo:lo + _CHUNK]
            k = high[part] - 1
            w = np.searchsorted(zeros, k, "right") - 1
            p = w * 64 + _nth_bit(~self.upper[w], k - zeros[w])
            out[part] = p - k
        return out

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at the given indexes."""
        out = np.zeros(len(i), np.uint64)
        for lo in range(0, len(i), _CHUNK):
            k = i[lo:lo + _CHUNK]
            w = np.searchsorted(self.ones, k, "right") - 1
            p = w * 64 + _nth_bit(self.upper[w], k - self.ones[w])
            out[lo:lo + _CHUNK] = ((p - k).astype(np.uint64) << np.uint64(self.bits)) | self._low(k)
        return out

    def find(self, x: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
        """Index of each value, -1 where it is not among the elements from ``first`` to before ``last``."""
        if not self.n:
            return np.full(len(x), -1)
        x = x.astype(np.uint64)
        high = (x >> np.uint64(self.bits)).astype(np.int64)
        inside = (high <= self.top) & (high >= 0)
        high = np.where(inside, high, 0)
        low = x & np.uint64((1 << self.bits) - 1)
        lo, hi = self._start(high), self._start_after(high)
        if first is not None:
            lo, hi = np.maximum(lo, first), np.minimum(hi, last)
        end = hi.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) >> 1
            less = self._low(mid) < low[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
        found = inside & (lo < end)
        at = np.flatnonzero(found)
        found[at] = self._low(lo[at]) == low[at]
        return np.where(found, lo, -1)

    def _start_after(self, high: np.ndarray) -> np.ndarray:
        out = np.full(len(high), self.n, np.int64)
        at = np.flatnonzero(high < self.top)
        out[at] = self._start(high[at] + 1)
        return out


# counts up to EXACT have a code of their own, larger ones share codes of equal ratio
EXACT = 4096
RATIO = 1 + 2.0 ** -11


def quantise(counts: np.ndarray) -> np.ndarray:
    c = np.maximum(counts, 1)
    large = EXACT + np.rint(np.log(c / EXACT) / np.log(RATIO))
    return np.where(c <= EXACT, counts, np.minimum(large, 65535)).astype(np.uint16)


def restore(codes: np.ndarray) -> np.ndarray:
    codes = codes.astype(float)
    return np.where(codes <= EXACT, codes, EXACT * RATIO ** (codes - EXACT))


class Trie:
    """Contexts, the words that follow each and a 16-bit code of how often.

    The words of all contexts form one sequence: the pointer of a context says
    where its words begin, and a word is stored as its rank plus the context's
    rank times the number of words, so that the sequence never falls."""

    def __init__(self, context: np.ndarray, word: np.ndarray, count: np.ndarray):
        """Rows sorted by (context, word), each pair once, all counts positive."""
        new = np.concatenate([[True], context[1:] != context[:-1]]) if len(context) else np.zeros(0, bool)
        starts = np.flatnonzero(new)
        words = np.unique(word)
        self.size = max(len(words), 1)
        self.contexts, self.words = EliasFano(context[starts]), EliasFano(words)
        self.pointers = EliasFano(np.concatenate([starts, [len(context)]]))
        rank = np.searchsorted(words, word)
        self.followers = EliasFano((np.cumsum(new) - 1) * self.size + rank if len(context) else np.zeros(0, np.uint64))
        self._codes = Mapped([quantise(count)])
        self.codes = self._codes.arrays[0]

    def lookup(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Codes of the pairs, 0 for unseen ones.  Each context and each word is
        looked up once; a pair is then searched from its context's pointer to the next one's."""
        out = np.zeros(len(context), np.uint16)
        contexts, of_context = np.unique(context, return_inverse=True)
        words, of_word = np.unique(word, return_inverse=True)
        c, w = self.contexts.find(contexts), self.words.find(words)
        first = self.pointers.get(np.maximum(c, 0)).astype(np.int64)
        last = self.pointers.get(np.maximum(c, 0) + 1).astype(np.int64) if len(self.codes) else first
        at = np.flatnonzero((c[of_context] >= 0) & (w[of_word] >= 0))
        if len(at):
            oc, ow = of_context[at], of_word[at]
            i = self.followers.find((c[oc] * self.size + w[ow]).astype(np.uint64), first[oc], last[oc])
            seen = i >= 0
            out[at[seen]] = self.codes[i[seen]]
        return out
