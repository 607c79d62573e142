"""Elias-Fano code of a rising sequence: low bits as they are, high bits in unary, with select samples."""

import struct

import numpy as np

HEAD = struct.Struct("<QQB")
SAMPLE = 256


class EliasFano:
    """``n`` numbers that never fall, the last at most ``top``, in about 2 + log2(top / n) bits each."""

    def __init__(self, n, top, width, high, low):
        self.n, self.top, self.width, self.high, self.low = n, top, width, high, low
        counts = np.bitwise_count(self.high).astype(np.int64)
        # select samples: the byte in which each SAMPLE-th set bit lies, and the set bits before that byte
        self.before = np.append(0, np.cumsum(counts))
        self.samples = np.searchsorted(self.before, np.arange(0, n, SAMPLE), side="right") - 1

    @classmethod
    def of(cls, values):
        values = np.asarray(values, np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        width = max(0, (top // n).bit_length() - 1) if n else 0
        places = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(places[-1]) // 8 + 1 if n else 0) * 8, np.uint8)
        high[places] = 1
        bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        return cls(n, top, width, np.packbits(high, bitorder="little"), low)

    def to_bytes(self):
        return HEAD.pack(self.n, self.top, self.width) + struct.pack("<Q", len(self.high)) + (
            self.high.tobytes() + self.low.tobytes()
        )

    @classmethod
    def from_bytes(cls, raw):
        n, top, width = HEAD.unpack_from(raw)
        (size,) = struct.unpack_from("<Q", raw, HEAD.size)
        data = np.frombuffer(raw, np.uint8, offset=HEAD.size + 8)
        return cls(n, top, width, data[:size], data[size:])

    def select(self, i):
        """The numbers at places ``i`` (an array), without decoding the rest."""
        i = np.asarray(i, np.int64)
        lo = self.samples[i // SAMPLE] if self.n else i
        hi = np.append(self.samples[1:], len(self.high) - 1)[i // SAMPLE] if self.n else i
        while np.any(lo < hi):  # the last byte with at most i set bits before it
            mid = (lo + hi + 1) // 2
            up = self.before[mid] <= i
            lo, hi = np.where(up, mid, lo), np.where(up, hi, mid - 1)
        rest = i - self.before[lo]
        bits = (self.high[lo][:, None] >> np.arange(8, dtype=np.uint8)) & 1
        place = np.argmax(np.cumsum(bits, axis=1) == rest[:, None] + 1, axis=1)
        value = (lo * 8 + place - i) << self.width
        for b in range(self.width):
            at = i * self.width + b
            value = value | (((self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.int64) << b)
        return value
