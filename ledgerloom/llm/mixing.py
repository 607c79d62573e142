"""Mixing sources to target weights (11) by a low-discrepancy schedule of equal blocks of words.

1. A source's documents, shuffled by a hash of their keys, are one stream of words, which starts again
   at its end. The stream is cut into blocks of ``BLOCK`` words; the mix takes as many as the
   source's target calls for, the last one cut short.
2. Slots 0, 1, 2, ... of the mix go to sources by van der Corput points: the slot's bits in reverse.
   The first 2**k points are a permutation of 0 .. 2**k - 1, of which a source owns
   an interval as long as its share of blocks. So slots of a source are spread evenly over
   the mix, their numbers are exact, and each source has one for each of its blocks.
3. The j-th slot of a source holds the j-th block. Blocks are pieces of documents: key, first word, words.

Places in the streams and ranks of slots are running sums in two levels (``running_sum``), so a source
with a third of all rows is never in one task.
"""

from pyspark.sql import functions as F

from ledgerloom.llm.common import staged
from ledgerloom.operators.batch import in_order, running_sum
from ledgerloom.operators.joins import small_side

WORD = r"[^\x20\x09-\x0D]+"
BLOCK, SEED = 2048, 42
WEIGHTS, MOST = (1, 2, 3), 3
#: Slots listed by one row, and leading bits of a slot that number the parts of their order.
RUN, PART_BITS = 1 << 16, 12


def sized(df, text="text", key="doc_id", source="source", seed=SEED):
    """doc_id, source, size in words, dig of the text and h, the hash by which documents are shuffled; staged."""
    own = F.coalesce(F.col(text), F.lit(""))
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    return staged(
        df.select(
            F.col(key).alias("doc_id"), F.col(source).alias("source"),
            F.regexp_count(own, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(own).alias("dig"),
            F.md5(named).alias("h"),
        ),
        "sizes",
    )


def targets(docs, weights=WEIGHTS, most=MOST):
    """One row per source: src (its rank by code point, null last), source_size, target and words to take.

    The sources' weights repeat in that order and share all words. A target stops at ``most`` times
    the source's size; what is over is shared by weight among the others until none is above.
    """
    by_source = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = in_order(by_source, [F.col("source").asc_nulls_last()], "sources").withColumn("one", F.lit(1))
    ranked = running_sum(ranked, "one", "part", ["place"], name="src").drop("one")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("src") % len(weights) + 1).cast("int"))
    sources = staged(
        ranked.withColumns({"weight": weight.cast("long"), "most": (F.col("source_size") * most).cast("long")}), "weights"
    )
    words, shares = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    left, among = words, shares
    while among:
        above = F.col("weight").cast("decimal(38,0)") * F.lit(left) > F.col("most").cast("decimal(38,0)") * F.lit(among)
        held, out = sources.where(above).agg(
            F.coalesce(F.sum("most"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))
        ).first()
        if (words - held, shares - out) == (left, among):
            break
        left, among = words - held, shares - out
    share = (F.col("weight") * F.lit(left)).cast("double") / F.lit(float(among or 1))
    aimed = sources.withColumn("target", F.least(F.col("most").cast("double"), share))
    return staged(
        aimed.select("source", "src", "part", "place", "source_size", "target", F.floor(F.col("target") + 0.5).alias("take")),
        "targets",
    )


def schedule(aimed, block=BLOCK):
    """(slot, src, k): the slot that holds block k of source src, for all blocks of all sources."""
    needs = aimed.withColumn("need", F.ceil(F.col("take") / block).cast("long"))
    needs = staged(running_sum(needs, "need", "part", ["place"], name="earlier").where("need > 0"), "needs")
    total = needs.agg(F.coalesce(F.sum("need"), F.lit(0))).first()[0]
    bits = max(1, (total - 1).bit_length())
    edge = lambda c: F.expr(f"(cast({c} as decimal(38, 0)) * {1 << bits}) div {max(total, 1)}")
    # intervals of a grid with 2**bits >= total points hold at least as many points as their sources need
    spans = needs.select(
        "src", "need", edge("earlier").alias("lo"), edge("earlier + need").alias("hi")
    )
    runs = spans.select("*", F.explode(F.sequence("lo", F.col("hi") - 1, F.lit(RUN))).alias("first"))
    points = runs.repartition("src", "first").select(
        "src", "need", F.explode(F.sequence("first", F.least(F.col("first") + RUN, "hi") - 1)).alias("point")
    )
    reverse = F.conv(F.reverse(F.lpad(F.bin("point"), bits, "0")), 2, 10).cast("long")
    slots = points.select("src", "need", reverse.alias("slot"), F.lit(1).alias("one"))
    slots = staged(slots.withColumn("part", F.shiftright("slot", max(0, bits - PART_BITS))), "slots")
    ranked = running_sum(slots, "one", "part", ["slot"], ["src"], "k").where("k < need")
    return ranked.select("slot", "src", F.col("k").cast("long").alias("k"))


def placed(docs, aimed):
    """The documents with their source's columns and ``start``, their place in its stream."""
    own = aimed.select(F.col("source").alias("of"), "src", "source_size", "target", "take")
    rows = docs.join(small_side(own), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rows = rows.withColumn("part", F.substring("h", 1, 3))
    return running_sum(rows, "size", "part", ["h", "doc_id", "size", "dig"], ["src"], "start").drop("part")


def mix(df, block=BLOCK, weights=WEIGHTS, most=MOST, **columns):
    """The pieces of the mix and the documents that it does not take.

    Pieces have slot and offset (the place in the mix), doc_id, dig, source, first (word of the
    document) and words, besides size, source_size and target; documents without a piece come
    once, with null slot and words 0. Null text has no words; a null source is a source, the
    last one; null keys, empty texts and repeated rows are documents like any other (which of
    two equal rows comes first does not show). Sources without words have target 0. No document
    is taken more than ``most`` times. Other columns do not matter.
    """
    docs = sized(df, **columns)
    aimed = targets(docs, weights, most)
    rows = staged(placed(docs, aimed), "streams")
    slots = schedule(aimed, block)
    turns = rows.where("size > 0").withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    turns = turns.withColumn("begin", F.col("start") + F.col("turn") * F.col("source_size")).where("begin < take")
    end = F.least(F.col("begin") + F.col("size"), "take")
    blocks = F.sequence(F.expr(f"begin div {block}"), F.expr(f"(least(begin + size, take) - 1) div {block}"))
    pieces = turns.withColumn("end", end).withColumn("k", F.explode(blocks))
    pieces = pieces.withColumns({
        "from": F.greatest(F.col("begin"), F.col("k") * block), "to": F.least(F.col("end"), (F.col("k") + 1) * block)
    })
    pieces = pieces.join(slots.hint("merge"), ["src", "k"]).select(
        "slot", (F.col("from") - F.col("k") * block).alias("offset"), "doc_id", "dig", "source", "start",
        (F.col("from") - F.col("begin")).alias("first"), (F.col("to") - F.col("from")).alias("words"),
        "size", "source_size", "target",
    )
    none = F.lit(None).cast("long")
    untaken = rows.where("size = 0 or start >= take").select(
        none.alias("slot"), none.alias("offset"), "doc_id", "dig", "source", "start", none.alias("first"),
        F.lit(0).cast("long").alias("words"), "size", "source_size", "target",
    )
    return pieces.unionByName(untaken)


def taken(mixed):
    """One row per document of ``mix``: doc_id, size, source_size, target and the words that the mix takes of it."""
    some = mixed.where("words > 0").groupBy("source", "start", "doc_id", "size", "source_size", "target")
    some = some.agg(F.sum("words").alias("taken")).drop("source", "start")
    none = mixed.where("words = 0").select("doc_id", "size", "source_size", "target", F.col("words").alias("taken"))
    return some.unionByName(none)


def block_texts(df, mixed, text="text", key="doc_id"):
    """(slot, text): each block's words, in order, joined by a space."""
    texts = df.select(F.col(key).alias("_key"), F.col(text).alias("_text")).where("_text is not null")
    texts = texts.withColumn("_dig", F.xxhash64("_text")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_key")) & (F.col("dig") == F.col("_dig"))
    words = F.slice(F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)), F.col("first") + 1, F.col("words"))
    parts = mixed.where("words > 0").join(texts, same).select("slot", "offset", F.array_join(words, " ").alias("part"))
    held = F.sort_array(F.collect_list(F.struct("offset", "part")))
    return parts.groupBy("slot").agg(F.array_join(F.transform(held, lambda x: x["part"]), " ").alias("text"))
