"""Word windows that occur more than once in a corpus, found shard by shard.

A window is ``size`` consecutive words of a document. Its anchor is the first of
its smallest ``gram``-word hashes, so equal windows have equal anchors at equal
places. Consecutive windows with one anchor make a *run* of words; every window
of the corpus lies in exactly one run, as a window of it. Equal windows therefore
meet where runs are brought together by anchor, and there each window of the text
that is compared stands for one place of the corpus.

1. Runs are cut per document and anchors counted; only runs of anchors that occur
   twice or more go on. Nothing but hashes has been moved.
2. Equal runs are counted before the shuffle and become one run with a number of
   copies, so a passage copied into a third of all rows is one row.
3. The words of each distinct run are taken from one of its documents and dealt to
   shards by anchor. An anchor with more than ``HOT_RUNS`` distinct runs (a line
   in many surroundings) is dealt window by window instead, each distinct window
   once with its copies; both ways lead to the same result.
4. The ``engine`` says for each run of a shard which windows occur twice. It reads
   the words themselves.
5. Results go back to all places by (anchor, run), and are gathered per document.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from ledgerloom.llm import common
from ledgerloom.llm.common import staged

#: Distinct runs of one anchor that are compared in one shard; more are dealt window by window.
HOT_RUNS = 512
#: Words that an engine indexes at a time; a shard is cut only between anchors.
SHARD_WORDS = 400_000

RUNS = "doc_id long, dig long, anchor long, run long, start int, n int, at int"
SHARD = "anchor long, run long, sub int, copies long, n int, at int, words string"


def first_smallest(values, width):
    """For each place, where the first smallest of the next ``width`` values is."""
    where = np.arange(len(values))
    best, reach = values, 1
    while reach < width:
        step = min(reach, width - reach)
        a, b = best[: len(best) - step], best[step:]
        left = a <= b
        where = np.where(left, where[: len(where) - step], where[step:])
        best = np.where(left, a, b)
        reach += step
    return where


def runs_of(hashes, first, size, gram):
    """Runs of all windows: document, first word, windows, anchor place, anchor and run hash.

    ``hashes`` has a value per word, ``first`` the first word of each document.
    """
    none = np.zeros(0, np.int64)
    if len(hashes) < size:
        return none, none, none, none, none, none
    begin = np.arange(len(hashes) - gram + 1)
    grams = common.span_hashes(hashes, begin, begin + gram, common.GRAM_BASE)
    place = first_smallest(grams, size - gram + 1)
    doc = np.searchsorted(first, np.arange(len(place)), side="right") - 1
    whole = np.arange(len(place)) + size <= first[doc + 1]
    windows = np.flatnonzero(whole)
    if not len(windows):
        return none, none, none, none, none, none
    place, doc = place[windows], doc[windows]
    new = np.ones(len(windows), bool)
    new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(new)
    n = np.diff(np.append(head, len(windows)))
    start, place, doc = windows[head], place[head], doc[head]
    run = common.span_hashes(hashes, start, start + n + size - 1, common.SPAN_BASE)
    run = common.mix(run ^ (place - start).astype(np.uint64))
    return doc, start - first[doc], n, place - start, grams[place].view(np.int64), run.view(np.int64)


def cut_runs(docs, size, gram):
    def cut(batches):
        for batch in common.slices(batches):
            data, offsets = common.text_buffers(batch.column("text"))
            starts, ends, first = common.split_words(data, offsets)
            doc, start, n, at, anchor, run = runs_of(common.hash_words(data, starts, ends), first, size, gram)
            rows = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(rows), batch.column("dig").take(rows), pa.array(anchor, pa.int64()),
                    pa.array(run, pa.int64()), pa.array(start, pa.int32()), pa.array(n, pa.int32()),
                    pa.array(at, pa.int32()),
                ],
                names=["doc_id", "dig", "anchor", "run", "start", "n", "at"],
            )

    return docs.mapInArrow(cut, RUNS)


def take_words(rows, size):
    """The words of the chosen runs of each document; of hot anchors every window alone."""

    def take(batches):
        for batch in common.slices(batches):
            out = []
            runs = batch.column("runs")
            cuts = runs.offsets.to_numpy().tolist()
            flat = runs.values
            fields = [flat.field(c).to_pylist() for c in ("anchor", "run", "copies", "start", "n", "at", "hot")]
            for text, lo, hi in zip(batch.column("text").to_pylist(), cuts, cuts[1:]):
                words = text.encode().split()
                for anchor, run, copies, start, n, at, hot in zip(*(f[lo:hi] for f in fields)):
                    if hot:
                        for sub in range(n):
                            window = b" ".join(words[start + sub : start + sub + size])
                            out.append((anchor, run, sub, copies, 1, 0, window))
                    else:
                        out.append((anchor, run, -1, copies, n, at, b" ".join(words[start : start + n + size - 1])))
            cols = list(zip(*out)) or [()] * 7
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]
            arrays = [pa.array(c, t) for c, t in zip(cols, types)] + [pa.array(cols[6], pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["anchor", "run", "sub", "copies", "n", "at", "words"])

    return rows.mapInArrow(take, SHARD)


def search_shards(shards, size, engine):
    """Rows of whole anchors, some hundred thousand words at a time, through the engine: (anchor, run, mask)."""

    def search(batches):
        held, words, last = [], 0, None

        def result():
            rows = pa.Table.from_batches(held)
            anchor, run = (rows[c].to_numpy() for c in ("anchor", "run"))
            once = np.ones(len(anchor), bool)  # repeated rows of a document bring a run twice
            once[1:] = (anchor[1:] != anchor[:-1]) | (run[1:] != run[:-1])
            rows, anchor, run = rows.filter(pa.array(once)), anchor[once], run[once]
            tokens = pc.split_pattern(rows["words"].combine_chunks(), " ")
            lengths = np.diff(tokens.offsets.to_numpy())
            ids = tokens.flatten().dictionary_encode().indices.to_numpy().astype(np.int64)
            mask = engine(ids, lengths, rows["copies"].to_numpy(), rows["at"].to_numpy(), size)
            keep = mask != 0
            return pa.RecordBatch.from_arrays(
                [pa.array(c[keep], pa.int64()) for c in (anchor, run, mask)], names=["anchor", "run", "mask"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            anchors = batch.column("anchor").to_numpy()
            total = np.append(0, np.cumsum(batch.column("n").to_numpy() + size - 1))
            borders = (np.flatnonzero(anchors[1:] != anchors[:-1]) + 1).tolist()
            if held and anchors[0] != last:
                borders.insert(0, 0)
            lo = 0
            for border in borders:
                if words + total[border] - total[lo] >= SHARD_WORDS:
                    if border > lo:
                        held.append(batch.slice(lo, border - lo))
                    yield result()
                    held, words, lo = [], 0, border
            held.append(batch.slice(lo))
            words += total[-1] - total[lo]
            last = anchors[-1]
        if held:
            yield result()

    return (
        shards.repartition(F.col("anchor"))
        .sortWithinPartitions("anchor", "run")
        .mapInArrow(search, "anchor long, run long, mask long")
    )


def repeated_windows(docs, size, gram, engine, hot_runs=HOT_RUNS):
    """Per document (doc_id, dig) with repeated windows: ``found``, an array of (start, mask).

    Bit ``i`` of a mask says that the window of ``size`` words that begins at
    word ``start + i`` occurs at another place too. ``docs`` is ``common.keyed``.
    """
    if not size - 63 < gram < size:
        raise ValueError("a run must have fewer than 64 windows")
    runs = cut_runs(docs, size, gram)
    # a table of its own: where a join reads an aggregate of its key directly, Spark can't split a hot anchor
    twice = staged(
        runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("places")).where("places > 1").select("anchor"), "twice"
    )
    places = staged(runs.join(twice, "anchor"), "places")
    distinct = staged(
        places.groupBy("anchor", "run").agg(
            F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "dig", "start", "n", "at")).alias("one")
        ),
        "runs",
    )
    hot = staged(
        distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("runs"))
        .where(F.col("runs") > hot_runs).select("anchor", F.lit(True).alias("hot")),
        "hot",
    )
    chosen = (
        distinct.join(hot, "anchor", "left")
        .groupBy(F.col("one.doc_id").alias("key"), F.col("one.dig").alias("dig"))
        .agg(
            F.collect_list(
                F.struct(
                    "anchor", "run", "copies", F.col("one.start").alias("start"), F.col("one.n").alias("n"),
                    F.col("one.at").alias("at"), F.coalesce("hot", F.lit(False)).alias("hot"),
                )
            ).alias("runs")
        )
    )
    words = staged(
        take_words(
            docs.join(chosen, docs["doc_id"].eqNullSafe(chosen["key"]) & (docs["dig"] == chosen["dig"])).select(
                "text", "runs"
            ),
            size,
        ),
        "words",
    )
    windows = (
        words.where("sub >= 0")
        .dropDuplicates(["anchor", "run", "sub"])
        .withColumn("window", F.xxhash64("words"))
        .withColumn("window_too", F.xxhash64("words", F.lit(1)))
    )
    alone = (
        windows.groupBy("window", "window_too", "words")
        .agg(F.sum("copies").alias("copies"))
        .select(
            F.col("window").alias("anchor"), F.col("window_too").alias("run"), F.lit(-1).alias("sub"),
            "copies", F.lit(1).alias("n"), F.lit(0).alias("at"), "words",
        )
    )
    searched = staged(search_shards(words.where("sub < 0").unionByName(alone), size, engine), "repeated")
    by_window = (
        windows.select("anchor", "run", "sub", "window", "window_too")
        .join(searched.select(F.col("anchor").alias("window"), F.col("run").alias("window_too")), ["window", "window_too"])
        .groupBy("anchor", "run")
        .agg(F.expr("bit_or(shiftleft(1L, sub))").alias("mask"))
    )
    masks = searched.unionByName(by_window)
    return (
        places.join(masks, ["anchor", "run"])
        .groupBy("doc_id", "dig")
        .agg(F.collect_set(F.struct("start", "mask")).alias("found"))
    )


def covered(first, found, size):
    """Which words of a batch lie in a repeated window; ``first`` has each document's first word."""
    edge = np.zeros(first[-1] + size + 1, np.int64)
    counts = np.diff(found.offsets.to_numpy())
    lists = found.values.slice(found.offsets[0].as_py(), int(counts.sum()))
    start, mask = (lists.field(c).to_numpy() for c in ("start", "mask"))
    start = start + np.repeat(first[:-1], counts)
    for bit in range(int(mask.max(initial=0)).bit_length()):
        begin = start[(mask >> bit) & 1 == 1] + bit
        edge += np.bincount(begin, minlength=len(edge)) - np.bincount(begin + size, minlength=len(edge))
    return np.cumsum(edge[: first[-1]]) > 0


def with_found(docs, found):
    """Documents with what was found in them."""
    f = found.select(F.col("doc_id").alias("key"), F.col("dig").alias("key_dig"), "found")
    return docs.join(f, docs["doc_id"].eqNullSafe(f["key"]) & (docs["dig"] == f["key_dig"]), "left").select(
        *docs.columns, F.coalesce("found", F.expr("cast(array() as array<struct<start: int, mask: bigint>>)")).alias("found")
    )
