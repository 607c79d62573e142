"""SHA-256 of the lines of a group in order, read as a stream: a digest is taken one line after the other."""

import hashlib

import pyarrow as pa
from pyspark.sql import functions as F

from ledgerloom.llm import common


def stream_digests(df, key, order, line, separator, name):
    """(key, name): lowercase hex SHA-256 of ``line`` of all rows of each key, by ``order``, joined by ``separator``.

    A group's rows come sorted to one task, which holds a batch of them at a time and the state of the
    hash, never the group. Keys may be null; lines may not.
    """
    common.ship(df.sparkSession)
    kind = df.select(key).schema[0].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), *[F.col(c).alias(f"order{i}") for i, c in enumerate(order)], line.alias("line"))
    by = [f"order{i}" for i in range(len(order))]
    sep = separator.encode()

    def work(batches):
        now, state = None, None
        for batch in common.slices(batches, "line"):
            done, kind_of = [], batch.schema.field("key").type
            for key, line in zip(batch.column("key").to_pylist(), batch.column("line").to_pylist()):
                if state is None or key != now:
                    if state is not None:
                        done.append((now, state.hexdigest()))
                    now, state = key, hashlib.sha256()
                else:
                    state.update(sep)
                state.update(line.encode())
            yield packed(done, kind_of)
        if state is not None:
            yield packed([(now, state.hexdigest())], kind_of)

    def packed(done, kind_of):
        return pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in done], kind_of), pa.array([d for _, d in done], pa.string())], names=[key, name]
        )

    dealt = rows.repartition("key").sortWithinPartitions("key", *by).select("key", "line")
    return dealt.mapInArrow(work, f"`{key}` {kind}, `{name}` string")
