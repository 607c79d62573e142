"""A compressed full-text index of word ids: suffix order, wavelet matrix, backward search."""

import numpy as np


class Bits:
    """A bit vector packed in 64-bit words with a running count per word."""

    def __init__(self, bits):
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words), np.int32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def rank(self, i):
        """Set bits before place ``i``."""
        word = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class FMIndex:
    """Backward search over texts of symbols 1..; each text is closed by the symbol 0.

    Suffixes are ordered by their first ``depth`` symbols at least, so intervals of
    patterns up to that length are right. ``weights`` has a number per text: an
    interval counts each text's suffixes that often.
    """

    def __init__(self, ids, lengths, weights, depth):
        count = len(lengths)
        text = np.zeros(len(ids) + count, np.int64)
        owner = np.repeat(np.arange(count), lengths)
        text[np.arange(len(ids)) + owner] = ids + 1
        self.symbols = int(text.max(initial=0)) + 1
        order, owner = self._suffixes(text, depth), np.repeat(np.arange(count), lengths + 1)
        self.weight = np.zeros(len(text) + 1, np.int64)
        np.cumsum(weights[owner[order]], out=self.weight[1:])
        self.first = np.zeros(self.symbols + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=self.symbols), out=self.first[1:])
        self.size = len(text)
        self._wavelet(text[order - 1])

    @staticmethod
    def _suffixes(text, depth):
        rank, reach = text, 1
        while True:
            key = rank * (int(rank.max(initial=0)) + 2)
            key[: len(text) - reach] += rank[reach:] + 1
            order = np.argsort(key, kind="stable")
            if reach * 2 > depth:
                return order
            new = np.zeros(len(text), np.int64)
            new[1:] = key[order[1:]] != key[order[:-1]]
            rank = np.empty(len(text), np.int64)
            rank[order] = np.cumsum(new)
            reach *= 2

    def _wavelet(self, last):
        self.levels = []
        start = np.zeros(self.symbols, np.int64)
        alphabet = np.arange(self.symbols)
        for shift in range(max(1, (self.symbols - 1).bit_length()) - 1, -1, -1):
            bit = (last >> shift) & 1
            bits, zeros = Bits(bit.astype(bool)), int(len(bit) - bit.sum())
            ones = bits.rank(start)
            start = np.where((alphabet >> shift) & 1, zeros + ones, start - ones)
            self.levels.append((shift, bits, zeros))
            last = np.concatenate([last[bit == 0], last[bit == 1]])
        self.offset = self.first[:-1] - start

    def extend(self, symbol, low, high):
        """The intervals of ``symbol`` followed by the patterns of the given intervals."""
        for shift, bits, zeros in self.levels:
            one = ((symbol >> shift) & 1).astype(bool)
            a, b = bits.rank(low), bits.rank(high)
            low = np.where(one, zeros + a, low - a)
            high = np.where(one, zeros + b, high - b)
        return self.offset[symbol] + low, self.offset[symbol] + high


def repeated_in_shard(ids, lengths, copies, at, size):
    """Engine of ``repeats``: matching statistics of each run, read against the index of all runs.

    From an end, a match is extended to the left while it occurs twice. A match
    of ``size`` words or more is an interval of repeated windows; the search goes
    on with the window before it, else with the next end to the left.
    """
    lengths = np.asarray(lengths, np.int64)
    index = FMIndex(ids, lengths, np.asarray(copies, np.int64), int(lengths.max(initial=0)))
    base = np.cumsum(lengths) - lengths
    mask = np.zeros(len(lengths), np.int64)
    who = np.flatnonzero(lengths >= size)
    end = lengths[who].copy()
    left = end.copy()
    low, high = np.zeros(len(who), np.int64), np.full(len(who), index.size)
    while len(who):
        symbol = ids[base[who] + left - 1] + 1
        new_low, new_high = index.extend(symbol, low, high)
        good = index.weight[new_high] - index.weight[new_low] >= 2
        low, high, left = np.where(good, new_low, low), np.where(good, new_high, high), left - good
        stop = ~good | (left == 0)
        if stop.any():
            s = np.flatnonzero(stop)
            long = s[end[s] - left[s] >= size]
            windows = end[long] - left[long] - size + 1
            mask[who[long]] |= ((np.int64(1) << windows) - 1) << left[long]
            end[s] = np.where(end[s] - left[s] >= size, left[s] + size - 1, end[s] - 1)
            left[s], low[s], high[s] = end[s], 0, index.size
            keep = ~stop | (end >= size)
            who, end, left, low, high = who[keep], end[keep], left[keep], low[keep], high[keep]
    return mask
