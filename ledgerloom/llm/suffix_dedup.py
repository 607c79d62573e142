"""Suffix-array dedup (9): long repeated passages, by sparse suffix arrays at minimiser positions."""

import numpy as np
import pyarrow as pa

from ledgerloom.llm import common, repeats, suffixes

WINDOW = 50
GRAM = 20


def repeated_passages(df, text="text", key="doc_id", size=WINDOW, gram=GRAM):
    """Maximal word spans of documents in which every window of ``size`` words occurs elsewhere too.

    One row per span: doc_id, first_word, end_word (exclusive), n_words, start_byte,
    end_byte (UTF-8) and passage. Documents without such a span have no row. Null text
    is empty; a null key is an ordinary key; repeated rows are each other's repeats;
    other columns do not matter. Spans that meet or overlap are one.
    """
    docs = common.keyed(common.documents(df, text, key))
    found = repeats.repeated_windows(docs, size, gram, suffixes.repeated_in_shard)

    def spans(batches):
        for batch in common.slices(batches):
            data, offsets = common.text_buffers(batch.column("text"))
            starts, ends, first = common.split_words(data, offsets)
            hit = repeats.covered(first, batch.column("found"), size)
            out, raw = [], data.tobytes()
            for doc, byte, lo, hi in zip(
                batch.column("doc_id").to_pylist(), offsets.tolist(), first.tolist(), first[1:].tolist()
            ):
                edge = np.flatnonzero(np.diff(np.concatenate([[0], hit[lo:hi].astype(np.int8), [0]])))
                for x, y in edge.reshape(-1, 2).tolist():
                    a, b = int(starts[lo + x]), int(ends[lo + y - 1])
                    out.append((doc, x, y, y - x, a - byte, b - byte, raw[a:b]))
            cols = list(zip(*out)) or [()] * 7
            arrays = [pa.array(c, pa.int64()) for c in cols[:6]] + [pa.array(cols[6], pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(
                arrays, names=["doc_id", "first_word", "end_word", "n_words", "start_byte", "end_byte", "passage"]
            )

    return repeats.with_found(docs, found).mapInArrow(
        spans,
        "doc_id long, first_word long, end_word long, n_words long, start_byte long, end_byte long, passage string",
    )
