"""Best-fit packing (4): bounded-space online best-fit of token pieces into sequences.

Each task packs the pieces of its documents as they come, those of one batch longest first. A fixed number of bins
is open, found by a bitset whose bit ``f`` says that a bin has ``f`` free places; a
piece goes to the smallest free space that takes it, and where a new bin would be
one too many, the fullest is closed. What is still open when a task ends is packed
again as whole blocks, so tasks leave no half-empty sequences behind.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from ledgerloom.llm import common, tokens
from ledgerloom.llm.common import staged

LENGTH = 2048
OPEN_BINS = 1024
#: Left-over bins of all tasks that one task packs again, and its open bins.
AGAIN, AGAIN_OPEN = 200_000, 16_384
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, ids binary"


class Packer:
    def __init__(self, length=LENGTH, open_bins=OPEN_BINS):
        self.length, self.most = length, open_bins
        self.free = 0  # the bitset
        self.bins = [[] for _ in range(length + 1)]  # open bins by free space
        self.n_open = self.n_bins = 0

    def _take(self, space):
        bins = self.bins[space]
        found = bins.pop()
        if not bins:
            self.free ^= 1 << space
        return found

    def place(self, size):
        """The bin and the offset for a piece of ``size`` tokens."""
        fitting = self.free >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            which = self._take(space)
        else:
            if self.n_open == self.most:
                self._take((self.free & -self.free).bit_length() - 1)
                self.n_open -= 1
            which, space = self.n_bins, self.length
            self.n_bins += 1
            self.n_open += 1
        left = space - size
        if left:
            self.bins[left].append(which)
            self.free |= 1 << left
        else:
            self.n_open -= 1
        return which, self.length - space

    def left_over(self):
        """Open bins with what they hold."""
        return [(b, self.length - space) for space, bins in enumerate(self.bins) for b in bins]


def pack(df, tokenizer, end, text="text", key="doc_id", length=LENGTH, open_bins=OPEN_BINS, with_ids=False):
    """Pieces of all documents with their place: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset and ids (binary, little-endian unsigned 32-bit; null unless ``with_ids``).

    A document is its ids and then ``end``; one longer than ``length`` is cut into pieces. Null
    text is empty: one piece with ``end`` alone. Keys may be null or repeat, since each row is
    packed by itself; other columns do not matter; an empty table gives no pieces.
    """

    def first(batches):
        packer, task = Packer(length, open_bins), TaskContext.get().partitionId() << 40
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = [f.split()[0] for f in PIECES.split(", ")]

        def rows(cols):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

        for batch, ids, offsets in tokens.encoded(batches, tokenizer, end):
            sizes = np.diff(offsets)
            count = -(-sizes // length)
            doc = np.repeat(np.arange(len(sizes)), count)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * length
            size = np.minimum(length, sizes[doc] - start)
            raw = ids.astype("<u4").tobytes()
            begin = (offsets[doc] + start) * 4
            cut = [raw[a:b] for a, b in zip(begin.tolist(), (begin + size * 4).tolist())]
            placed = [None] * len(size)
            for i in np.argsort(-size, kind="stable").tolist():  # what is at hand goes in longest first
                placed[i] = packer.place(int(size[i]))
            yield rows(
                [
                    batch.column("doc_id").take(pa.array(doc)), piece, start, size, [zlib.crc32(c) for c in cut],
                    [task + b for b, _ in placed], [o for _, o in placed], cut if with_ids else [None] * len(cut),
                ]
            )
        rest = packer.left_over()
        n = len(rest)
        yield rows([[None] * n, [-1] * n, [0] * n, [f for _, f in rest], [0] * n, [task + b for b, _ in rest], [0] * n, [None] * n])

    placed = staged(common.documents(df, text, key).mapInArrow(first, PIECES), "pieces")
    rest = placed.where("piece = -1").select("bin", F.col("length").alias("held"))
    tasks = -(-max(1, rest.count()) // AGAIN)

    def again(batches):
        packer, task = Packer(length, AGAIN_OPEN), -1 - TaskContext.get().partitionId()
        for batch in batches:
            where = [packer.place(h) for h in batch.column("held").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("bin"), pa.array([(task << 40) + b for b, _ in where], pa.int64()),
                 pa.array([o for _, o in where], pa.int64())],
                names=["bin", "sequence", "shift"],
            )

    moved = staged(
        rest.repartition(tasks, "bin")
        .sortWithinPartitions(F.desc("held"), "bin")
        .mapInArrow(again, "bin long, sequence long, shift long"),
        "moved",
    )
    return placed.where("piece >= 0").join(moved, "bin", "left").select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.coalesce("sequence", "bin").alias("sequence_id"),
        (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
        "ids",
    )


def sequences(pieces):
    """Whole sequences of ``pack(..., with_ids=True)``: sequence_id, ids (binary) and the pieces in them."""
    joined = F.expr("aggregate(parts, cast('' as binary), (a, p) -> concat(a, p.ids))")
    return (
        pieces.groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "ids"))).alias("parts"))
        .select("sequence_id", joined.alias("ids"), F.expr("transform(parts, p -> struct(p.doc_id, p.piece, p.offset, p.length))").alias("pieces"))
    )
