"""Substring dedup (6): windows of words that occur elsewhere, by an FM-index per shard.

``repeats`` brings together all windows that could be equal; ``fm_index`` finds
those that are by backward search over a wavelet matrix of the words themselves.
"""

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm import common, fm_index, repeats

WINDOW = 35
GRAM = 14


def remove_repeats(df, text="text", key="doc_id", size=WINDOW, gram=GRAM, engine=fm_index.repeated_in_shard, keep=None):
    """Each row of ``df`` with its words outside repeated windows of ``size`` words.

    doc_id, n_words, n_removed, ``kept`` (the words left, joined by a blank) and
    ``row``, a struct of the columns named in ``keep``; windows are judged on the input. Null text counts as empty and has no words; a
    null key is an ordinary key; repeated rows repeat each other and so lose their
    windows; other columns do not matter. Texts of any length are handled whole.
    """
    common.ship(df.sparkSession)
    docs = df.select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in (keep or ())], F.lit(0).alias("_")).alias("row"),
    ).withColumn("dig", F.xxhash64("text"))
    found = repeats.repeated_windows(docs.select("doc_id", "text", "dig"), size, gram, engine)
    with_row = T.StructType(
        [T.StructField(c, T.LongType()) for c in ("doc_id", "n_words", "n_removed")]
        + [T.StructField("kept", T.StringType()), docs.schema["row"]]
    )

    def cut(batches):
        for batch in common.slices(batches):
            _, _, first = common.split_words(*common.text_buffers(batch.column("text")))
            keep = ~repeats.covered(first, batch.column("found"), size)
            kept = []
            for text, lo, hi in zip(batch.column("text").to_pylist(), first.tolist(), first[1:].tolist()):
                kept.append(b" ".join(compress(text.encode().split(), keep[lo:hi].tolist())))
            n = np.diff(first)
            staying = np.append(0, np.cumsum(keep))[first]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(n - np.diff(staying), pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()), batch.column("row"),
                ],
                names=["doc_id", "n_words", "n_removed", "kept", "row"],
            )

    return repeats.with_found(docs, found).mapInArrow(cut, with_row)


def shortened_rows(df, text="text", key="doc_id", **options):
    """The rows of ``df`` with repeated words taken out of their texts; texts without any are as they were.

    Rows of which no word is left go, as do rows that had none.
    """
    out = remove_repeats(df, text, key, keep=df.columns, **options).where("n_words > n_removed")
    own = {c: F.col("row").getField(c) for c in df.columns}
    own[text] = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(own[text])
    return out.select(*[column.alias(c) for c, column in own.items()])


def digests(removed):
    """doc_id, n_words, n_removed and kept_sha256."""
    return removed.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
