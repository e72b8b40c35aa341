"""Elias-Fano lists and a two-level n-gram trie on them, queried in batches; levels live in one memory-mapped file."""

from __future__ import annotations

import tempfile

import numpy as np

from vitaspan.llm.common import by_value


#: A search for more than 1 / MANY of a list's length reads the list through instead of probing it.
MANY = 8


class EliasFano:
    """A sorted list of n numbers below ``universe`` in about 2 + log2(universe / n) bits each.

    Low bits are packed; high parts are a bit list with a one per number and a zero per step of the high part.
    """

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, zeros: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.zeros = n, low_bits, low, high, zeros

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        bits = max(0, (max(1, int(universe)) // max(1, n)).bit_length() - 1)
        low = np.zeros(n * bits // 64 + 2, dtype=np.uint64)
        if bits and n:
            part = values & np.uint64((1 << bits) - 1)
            at = np.arange(n, dtype=np.uint64) * np.uint64(bits)
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            low[word[first]] = np.bitwise_or.reduceat(part << shift, first)
            # one number at most reaches over the end of a word
            over = shift + np.uint64(bits) > np.uint64(64)
            low[word[over] + 1] |= part[over] >> (np.uint64(64) - shift[over])
        upper = (values >> np.uint64(bits)).astype(np.int64) if n else np.zeros(0, dtype=np.int64)
        size = (int(upper[-1]) if n else 0) + n + 2
        flags = np.zeros(-(-size // 64) * 64, dtype=np.uint8)
        flags[upper + np.arange(n)] = 1
        high = np.packbits(flags, bitorder="little").view(np.uint64)
        zeros = np.concatenate(([0], np.cumsum(64 - np.bitwise_count(high).astype(np.int64))))
        return cls(n, bits, low, high, zeros)

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Positions of the k-th zeros."""
        word = np.searchsorted(self.zeros, k, side="right") - 1
        out = np.empty(len(k), dtype=np.int64)
        for i in range(0, len(k), 1 << 16):
            part = slice(i, i + (1 << 16))
            bits = np.unpackbits(self.high[word[part]].reshape(-1, 1).view(np.uint8), axis=1, bitorder="little") == 0
            seen = np.cumsum(bits, axis=1, dtype=np.uint8)
            out[part] = 64 * word[part] + np.argmax(seen == (k[part] - self.zeros[word[part]] + 1)[:, None], axis=1)
        return out

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), dtype=np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        rest = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return ((self.low[word] >> shift) | rest) & np.uint64((1 << self.low_bits) - 1)

    def _all(self) -> np.ndarray:
        """All numbers in order, read in one go."""
        ones = np.concatenate([np.zeros(0, dtype=np.int64), *(
            64 * i + np.flatnonzero(np.unpackbits(self.high[i:i + (1 << 16)].view(np.uint8), bitorder="little"))
            for i in range(0, len(self.high), 1 << 16))])[:self.n]
        at = np.arange(self.n, dtype=np.int64)
        return ((ones - at).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(at)

    def _range(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every x the first place whose number is x or more, and the end of the numbers that share its high part."""
        upper = (x >> np.uint64(self.low_bits)).astype(np.int64)
        most = int(self.zeros[-1]) - 1
        beyond = upper > most
        upper = np.minimum(upper, most)
        stop = np.minimum(self._zero(upper) - upper, self.n)
        start = np.minimum(np.where(upper > 0, self._zero(np.maximum(upper - 1, 0)) + 1 - upper, 0), stop)
        low = x & np.uint64((1 << self.low_bits) - 1)
        lo, hi = start, stop.copy()
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            middle = (lo[open_] + hi[open_]) // 2
            less = self._low(middle) < low[open_]
            lo[open_[less]] = middle[less] + 1
            hi[open_[~less]] = middle[~less]
            open_ = open_[lo[open_] < hi[open_]]
        lo[beyond], stop[beyond] = self.n, self.n
        return lo, stop

    def search(self, x: np.ndarray) -> np.ndarray:
        """For every x the first place whose number is x or more (n, if there is none)."""
        x = np.asarray(x, dtype=np.uint64)
        if len(x) * MANY >= self.n:
            return np.searchsorted(self._all(), x)
        return self._range(x)[0] if self.n else np.zeros(len(x), dtype=np.int64)

    def find(self, x: np.ndarray) -> np.ndarray:
        """The place of every x, or -1."""
        x = np.asarray(x, dtype=np.uint64)
        out = np.full(len(x), -1, dtype=np.int64)
        if self.n and len(x) * MANY >= self.n:
            values = self._all()
            at = np.searchsorted(values, x)
            same = values[np.minimum(at, self.n - 1)] == x
            out[same] = at[same]
        elif self.n:
            at, stop = self._range(x)
            inside = np.flatnonzero(at < stop)
            same = inside[self._low(at[inside]) == x[inside] & np.uint64((1 << self.low_bits) - 1)]
            out[same] = at[same]
        return out

    def find_each(self, x: np.ndarray) -> np.ndarray:
        """As ``find``, for numbers that come again and again: each is searched once."""
        x = np.asarray(x, dtype=np.uint64)
        top = int(x.max()) + 1 if len(x) else 0
        if top <= 2 * len(x):  # small numbers: all of them are looked up, in order
            return self.find(np.arange(top, dtype=np.uint64))[x.astype(np.int64)]
        keys, back = np.unique(x, return_inverse=True)
        return self.find(keys)[back]

    def get(self, i: np.ndarray) -> np.ndarray:
        """Numbers at the places i."""
        i = np.asarray(i, dtype=np.int64)
        if len(i) * MANY >= self.n:
            return self._all()[i]
        ones = 64 * np.arange(len(self.zeros), dtype=np.int64) - self.zeros
        word = np.searchsorted(ones, i, side="right") - 1
        bit = np.empty(len(i), dtype=np.int64)
        for k in range(0, len(i), 1 << 16):
            part = slice(k, k + (1 << 16))
            bits = np.unpackbits(self.high[word[part]].reshape(-1, 1).view(np.uint8), axis=1, bitorder="little")
            seen = np.cumsum(bits, axis=1, dtype=np.uint8)
            bit[part] = 64 * word[part] + np.argmax(seen == (i[part] - ones[word[part]] + 1)[:, None], axis=1)
        upper = (bit - i).astype(np.uint64)
        return (upper << np.uint64(self.low_bits)) | self._low(i)


#: Quantised probabilities: 65,535 equal steps of the decimal logarithm from 0 down to this.
LOWEST = -16.0


def quantise(p: np.ndarray) -> np.ndarray:
    return (np.clip(np.log10(p) / LOWEST, 0, 1) * 65534 + 1).round().astype(np.uint16)


def dequantise(code: np.ndarray) -> np.ndarray:
    """Probabilities of codes; code 0 stands for no entry and gives 0."""
    return np.where(code == 0, 0.0, 10.0 ** (LOWEST * (code.astype(np.float64) - 1) / 65534))


def _beyond(ordered: np.ndarray) -> int:
    return int(ordered[-1]) + 1 if len(ordered) else 1


class Trie:
    """Contexts, monotone pointers to their successors, and a quantised probability per successor.

    Successors are numbered within the trie; level 2 is one sorted list of ``context number * successors + number``,
    so a context's successors are a range of it and a search is relative to the context.
    """

    def __init__(self, contexts: np.ndarray, words: np.ndarray, p: np.ndarray):
        """Parallel arrays sorted by (context, word), both unsigned 64-bit hashes, without repeats."""
        starts = np.append(True, contexts[1:] != contexts[:-1])[:len(contexts)]
        first = np.flatnonzero(starts)
        keys = contexts[first]
        vocabulary, successor = np.unique(words, return_inverse=True)
        self.n_words = max(1, len(vocabulary))
        pointers = np.append(first, len(words))
        values = (np.cumsum(starts) - 1).astype(np.uint64) * np.uint64(self.n_words) + successor.astype(np.uint64)
        levels = (EliasFano.encode(keys, _beyond(keys)), EliasFano.encode(vocabulary, _beyond(vocabulary)),
                  EliasFano.encode(pointers, len(words) + 1), EliasFano.encode(values, max(1, len(keys) * self.n_words)))
        codes = quantise(np.asarray(p)) if len(words) else np.zeros(0, dtype=np.uint16)
        self.file = tempfile.TemporaryFile()  # has no name, so nothing stays behind
        self.contexts, self.vocabulary, self.pointers, self.successors = (self._mapped(x) for x in levels)
        self.codes = self._map(codes)

    def _map(self, array: np.ndarray) -> np.ndarray:
        if not len(array):
            return array
        at = self.file.seek(0, 2)
        at += -at % 8
        self.file.seek(at)
        self.file.write(np.ascontiguousarray(array).tobytes())
        self.file.flush()
        return np.memmap(self.file, dtype=array.dtype, mode="r", offset=at, shape=array.shape)

    def _mapped(self, x: EliasFano) -> EliasFano:
        return EliasFano(x.n, x.low_bits, self._map(x.low), self._map(x.high), self._map(x.zeros))

    def fan_out(self, contexts: np.ndarray) -> np.ndarray:
        """Number of successors of each context; 0 if it is unknown."""
        at = self.contexts.find(contexts)
        out, known = np.zeros(len(at), dtype=np.int64), at >= 0
        begin, end = np.split(self.pointers.get(np.concatenate([at[known], at[known] + 1])).astype(np.int64), 2)
        out[known] = end - begin
        return out

    def lookup(self, contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Codes of pairs; 0 where there is none."""
        out = np.zeros(len(words), dtype=np.uint16)
        context, word = self.contexts.find_each(contexts), self.vocabulary.find_each(words)
        known = np.flatnonzero((context >= 0) & (word >= 0))
        at = self.successors.find(context[known].astype(np.uint64) * np.uint64(self.n_words) + word[known].astype(np.uint64))
        out[known[at >= 0]] = self.codes[at[at >= 0]]
        return out


by_value(__name__)
