"""A compressed full-text index of word sequences: suffix order, BWT, wavelet matrix, search.

For each symbol the index holds, per binary digit of the alphabet, one bit and half a bit of
running counts, and a thirty-second of a place in the text: with 2^17 different words about 28
bits instead of the 32 of the text alone and the 64 of its suffix order.
"""

from __future__ import annotations

import numpy as np

# Every so many places of the text one place in suffix order is known; others are walked to.
SAMPLE = 16


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Positions sorted by what follows them to the end, by doubling where ranks still tie."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    ordered = text[order]
    firsts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    sizes = np.diff(np.append(firsts, n))
    rank = np.empty(n + 1, np.int64)
    rank[order] = np.repeat(firsts, sizes)
    rank[n] = -1
    open_, width = order[np.repeat(sizes, sizes) > 1], 1
    while open_.size:
        key = rank[open_] << 32 | (rank[np.minimum(open_ + width, n)] + 1)
        turn = np.argsort(key, kind="stable")
        open_, key = open_[turn], key[turn]
        place = np.arange(len(open_))
        fresh = np.append(True, key[1:] != key[:-1])
        head = np.append(True, (key[1:] >> 32) != (key[:-1] >> 32))
        first = np.maximum.accumulate(np.where(fresh, place, 0))
        rank[open_] = (key >> 32) + first - np.maximum.accumulate(np.where(head, place, 0))
        counts = np.diff(np.append(np.flatnonzero(fresh), len(open_)))
        open_ = open_[np.repeat(counts, counts) > 1]
        width *= 2
    out = np.empty(n, np.int64)
    out[rank[:n]] = np.arange(n)
    return out


class Bits:
    """Packed bits with running counts per word of 64."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        ones = np.bitwise_count(words).astype(np.int32)
        self.before = np.cumsum(ones, dtype=np.int32) - ones
        self.total = int(ones.sum())

    def ones(self, at: np.ndarray) -> np.ndarray:
        """How many bits are set before each place."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0


class WaveletMatrix:
    """Ranks of symbols in a sequence: a plane of packed bits per binary digit."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = max(1, int(symbols - 1).bit_length())
        self.planes, self.zeros = [], []
        now = sequence.astype(np.int32)
        for level in range(self.levels - 1, -1, -1):
            bit = (now >> level) & 1 > 0
            plane = Bits(bit)
            self.planes.append(plane)
            self.zeros.append(len(now) - plane.total)
            now = np.concatenate([now[~bit], now[bit]])
        self.first = self._descend(np.arange(symbols), np.zeros(symbols, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for n, level in enumerate(range(self.levels - 1, -1, -1)):
            ones = self.planes[n].ones(at)
            at = np.where((symbol >> level) & 1, self.zeros[n] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before position ``at``, for many of both at once."""
        return self._descend(symbol, at) - self.first[symbol]

    def read(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it occurs before."""
        symbol = np.zeros(len(at), np.int64)
        for n in range(self.levels):
            ones, bit = self.planes[n].ones(at), self.planes[n].get(at)
            at = np.where(bit, self.zeros[n] + ones, at - ones)
            symbol = symbol << 1 | bit
        return symbol, at - self.first[symbol]


class FMIndex:
    """Backward search over a text in which symbol 0 ends every piece, the last one included.

    The text itself is not kept: what is searched for is streamed past the index.
    """

    def __init__(self, text: np.ndarray):
        order = suffix_order(text)
        symbols = int(text.max()) + 1
        self.tree = WaveletMatrix(text[order - 1], symbols)
        counts = np.bincount(text, minlength=symbols)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        # Beginnings of pieces are known too, so no walk leads from one piece into another.
        known = (order % SAMPLE == 0) | (text[order - 1] == 0)
        self.known, self.places = Bits(known), order[known].astype(np.int32)

    def match(self, text: np.ndarray, ends: np.ndarray, longest: int):
        """(matched, low, high) for places of a streamed ``text``: how many symbols up to each of
        ``ends`` occur more than once in the index, at most ``longest``, and for those that reach
        it the range of the occurrences in suffix order.

        This is the matching statistic of every end, cut at ``longest``.
        """
        matched = np.full(len(ends), longest)
        low, high = np.zeros(len(ends), np.int64), np.zeros(len(ends), np.int64)
        which, symbol = np.arange(len(ends)), text[ends - 1]
        a, b = self.before[symbol], self.before[symbol + 1]
        for back in range(2, longest + 2):
            more = b - a > 1
            matched[which[~more]] = back - 2
            which, a, b = which[more], a[more], b[more]
            if back > longest or not which.size:
                break
            symbol = text[ends[which] - back]
            both = self.tree.rank(np.tile(symbol, 2), np.concatenate([a, b]))
            a = self.before[symbol] + both[: len(which)]
            b = self.before[symbol] + both[len(which) :]
        low[which], high[which] = a, b
        return matched, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the text of rows of the suffix order: walks back to a known place."""
        out = np.empty(len(rows), np.int64)
        left, at, steps = np.arange(len(rows)), rows, 0
        while left.size:
            known = self.known.get(at)
            out[left[known]] = self.places[self.known.ones(at[known])] + steps
            left, at = left[~known], at[~known]
            symbol, before = self.tree.read(at)
            at, steps = self.before[symbol] + before, steps + 1
        return out
