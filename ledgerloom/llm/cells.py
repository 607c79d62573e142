"""Columns of numbers as binary cells, one per slice and shard, so that shuffles move few large rows in place of many small ones.

A shard is a range of a 64-bit key; there are as many as the amount of text calls for, so that one fits a task.
"""

import numpy as np
import pyarrow as pa

SCHEMA = "shard int, payload binary"


def deal(shards, key, columns, tail=None, ordered=False):
    """A batch (shard, payload) of the columns, with their rows in the order of ``key``; ``tail`` makes other columns of a part."""
    if not ordered:
        order = np.argsort(key)
        key, columns = key[order], [c[order] for c in columns]
    shard = ((key >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
    cuts = np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))
    own = np.flatnonzero(np.diff(cuts))
    payload = []
    for s in own:
        part = [c[cuts[s] : cuts[s + 1]] for c in columns]
        part = tail(part) if tail else part
        payload.append(b"".join(np.ascontiguousarray(c).tobytes() for c in part))
    return pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(payload, pa.binary())], names=["shard", "payload"])


def read(cell, kinds, start=0, n=None):
    """Columns of the numpy types ``kinds``, ``n`` rows long (all there is by default), and the byte after them."""
    n = (len(cell) - start) // sum(np.dtype(k).itemsize for k in kinds) if n is None else n
    out = []
    for kind in kinds:
        out.append(np.frombuffer(cell, kind, n, start))
        start += n * np.dtype(kind).itemsize
    return out, start


def planes(column):
    """The bytes of a column of numbers, all first ones, then all second ones and so on: what numbers have in common is then packed well."""
    return np.ascontiguousarray(column.view(np.uint8).reshape(len(column), column.itemsize).T).tobytes()


def from_planes(cell, kind, n, start):
    """A column that ``planes`` wrote, and the byte after it."""
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(cell, np.uint8, n * size, start).reshape(size, n)
    return np.ascontiguousarray(raw.T).view(kind).ravel(), start + n * size


def steps(column):
    """The differences of a sorted column, the first one from zero; sums give it back."""
    return np.diff(column, prepend=column.dtype.type(0))


def together(payload, kinds):
    """The columns of all cells of an Arrow column, one after another."""
    parts = [read(cell.as_buffer(), kinds)[0] for cell in payload]
    return [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, k) for k in kinds]
