"""Token-ID output (3): shards of concatenated ids with Elias-Fano document boundaries.

Documents are dealt to shards by ranges of their key, so shard after shard is
ascending order. A shard is a run of blocks; a block holds some million ids as
one binary value (little-endian, 16 bits where the vocabulary allows), the keys of
its documents, and their boundaries in an Elias-Fano code. Blocks are rows of
Parquet, so Spark's commit protocol keeps half-written shards of lost executors out.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.llm import common, tokens
from ledgerloom.llm.elias_fano import EliasFano

#: Ids and documents after which a block is closed.
BLOCK_IDS, BLOCK_DOCS = 2_000_000, 50_000
FILE = (
    "shard int, block int, before long, n_docs long, n_ids long, id_bytes int, doc_ids array<long>, bounds binary, ids binary"
)


def write_token_files(df, path, tokenizer, end=None, text="text", key="doc_id", shards=None):
    """Encode all texts and write them below ``path`` in ascending order of the key.

    Null text has no ids of its own; a null key comes first; equal keys are ordered by a
    hash of their texts, equal rows stand side by side; other columns do not matter. An
    empty table gives no blocks.
    """
    spark = df.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(batches):
        shard, block, before = TaskContext.get().partitionId(), 0, 0
        keys, ids, bounds = [], [], [0]

        def row():
            all_ids = np.concatenate(ids)
            width = 2 if code.size <= 1 << 16 and (end or 0) < 1 << 16 else 4
            values = [
                [shard], [block], [before], [len(bounds) - 1], [len(all_ids)], [width], [pa.concat_arrays(keys).to_pylist()],
                [EliasFano.of(bounds).to_bytes()], [all_ids.astype(f"<u{width}").tobytes()],
            ]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()),
                     pa.binary(), pa.binary()]
            names = [f.split()[0] for f in FILE.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=names)

        code = tokens.encoder(tokenizer)
        for batch, new, offsets in tokens.encoded(batches, tokenizer, end):
            keys.append(batch.column("doc_id"))
            ids.append(new)
            bounds.extend((bounds[-1] + offsets[1:]).tolist())
            if bounds[-1] >= BLOCK_IDS or len(bounds) > BLOCK_DOCS:
                yield row()
                before, block = before + bounds[-1], block + 1
                keys, ids, bounds = [], [], [0]
        if keys:
            yield row()

    (
        common.keyed(common.documents(df, text, key))
        .repartitionByRange(shards, "doc_id", "dig")
        .sortWithinPartitions("doc_id", "dig")
        .select("doc_id", "text")
        .mapInArrow(write, FILE)
        .write.option("compression", "zstd")
        .parquet(path)
    )


def read_token_files(spark, path):
    """Each document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, ids.

    ``ids`` is binary, little-endian unsigned 32-bit. The number of shards bounds what is broadcast.
    """
    common.ship(spark)
    blocks = spark.read.parquet(path)
    sums = blocks.groupBy("shard").agg(F.max(F.col("before") + F.col("n_ids")).alias("in_shard"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = sums.select("shard", F.coalesce(F.sum("in_shard").over(earlier), F.lit(0)).alias("shard_start"))

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                bounds = EliasFano.from_bytes(row["bounds"]).select(np.arange(row["n_docs"] + 1))
                raw = np.frombuffer(row["ids"], f"<u{row['id_bytes']}").astype("<u4").tobytes()
                cut = [raw[4 * a : 4 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["shard_start"] + row["before"] + bounds[:-1], pa.int64()),
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.array([zlib.crc32(c) for c in cut], pa.int64()),
                        pa.array(cut, pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    return blocks.join(F.broadcast(shards), "shard").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"
    )
