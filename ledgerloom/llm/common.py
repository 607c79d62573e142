"""What the operators of this subpackage share: tables, Arrow batches, hashes of words.

Words are the maximal runs of bytes outside the six ASCII white-space bytes,
``[^\\x20\\x09-\\x0D]+``; UTF-8 never has those bytes inside another character.
"""

import ctypes
import functools
import tempfile
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerloom.catalogue.registry import table
from ledgerloom.sources.staging import staged

__all__ = ["documents", "hash_words", "keyed", "mix", "ship", "slices", "span_hashes", "split_words", "staged", "table"]

#: Bytes of text handled at a time inside a task, which bounds the memory of a task.
SLICE_BYTES = 1 << 20
#: Values up to which tables of powers are kept.
USUAL = 5 << 18
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True


def ship(spark):
    """Send this library to the executors, once per context, as ``--py-files`` would."""
    context = spark.sparkContext
    if getattr(context, "_ledgerloom_sent", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / "ledgerloom.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._ledgerloom_sent = True


def documents(df, text="text", key="doc_id"):
    """The two columns an operator works on, null text as empty, under fixed names."""
    ship(df.sparkSession)
    return df.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def keyed(df):
    """Documents with ``dig``, so that rows that share a doc_id stay apart unless texts are equal."""
    return documents(df).withColumn("dig", F.xxhash64("text"))


def slices(batches, column="text", limit=SLICE_BYTES, kept=()):
    """Record batches cut so that each holds about ``limit`` bytes of ``column``, one row at least.

    At the end of a task what its worker remembers goes, but for the tables named ``kept``.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        for lo, hi in spans(text_buffers(batch.column(column))[1], limit):
            yield batch.slice(lo, hi - lo)
    release(kept)


def spans(offsets, limit):
    """First and last row (exclusive) of runs of texts that hold about ``limit`` bytes each."""
    cuts = np.flatnonzero(np.diff(np.cumsum(np.diff(offsets)) // limit)) + 1
    return zip([0, *cuts.tolist()], [*cuts.tolist(), len(offsets) - 1])


#: What workers remember from task to task, by name: functions whose ``cache_clear`` forgets it.
REMEMBERED = {}


def remembered(name):
    """Let a cached function be forgotten by the tasks of other operators."""

    def register(fn):
        REMEMBERED[name] = fn
        return fn

    return register


def release(kept=()):
    """Give back what a task leaves in its worker, which the next stage's task may run in too."""
    for name, fn in REMEMBERED.items():
        if name not in kept:
            fn.cache_clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_buffers(column):
    """Bytes and offsets of an Arrow text column without nulls; offsets start at zero."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split_words(data, offsets):
    """Start and end byte of each word, and for each text the index of its first word (one more at the end)."""
    inside = ~WHITE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x):
    """Spread the bits of 64-bit integers (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _make_powers(base, size):
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(size, b, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64, out=p))
    return out


_kept_powers = remembered("powers")(functools.lru_cache(maxsize=4)(_make_powers))


def _powers(base, size):
    """Powers of an odd base and of its inverse modulo 2**64; one table per base is kept for the usual size."""
    return _kept_powers(base, USUAL) if size <= USUAL else _make_powers(base, size)


def span_hashes(values, starts, ends, base):
    """A 64-bit hash of each run ``values[start:end]``, equal for equal runs at any place."""
    power, inverse = _powers(base, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=total[1:])
    spans = (total[ends] - total[starts]) * inverse[starts]
    return mix(spans ^ ((ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
WORD_BASE, GRAM_BASE, SPAN_BASE = 0x5851F42D4C957F2D, 0xD1342543DE82EF95, 0xDA942042E4DD58B5


def hash_words(data, starts, ends):
    return span_hashes(BYTE_VALUES[data], starts, ends, WORD_BASE)
