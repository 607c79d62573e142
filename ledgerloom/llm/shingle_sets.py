"""Near copies by SimHash and the exact similarity of their sets of word shingles, for the near-dedup stage of the pipeline.

Fingerprints of the sets meet in the index of ``simhash``; a pair that it links is checked by the sets themselves (0). Near
sets whose fingerprints differ in more bits than the index allows are found exactly by what they share (1 to 4), where
pairs that are known already are not compared again.

0. A bit of a set's fingerprint is 1 if it is set in over half of its shingles' hashes. Sets of one fingerprint meet
   its smallest node, a fingerprint's node meets that of the smallest fingerprint the index links it to.
1. Each text becomes the set of hashes of its ``SHINGLE``-word shingles; equal sets are one, told by two sums.
2. In the order of the hashes, two sets with a similarity t = ``LEAST`` or more share shingles among their first ones:
   of the first n - t n + k of a set, k are common to both. So only that head of each set is kept
   and counted, and a set whose head shares too little with others is near none. The rest, few, are read again whole.
3. Two sets with similarity t = ``LEAST`` or more have t/(1+t) of their sizes' sum in common: at least t of
   the larger one, and 2t/(1+t) of the smaller one. So a set can be the larger (smaller) one of a pair only if that
   many of its shingles occur elsewhere.
4. In an order from rare to common, the first shingle that two such sets share is among the first of either
   one's shared shingles, as many as it may lack and one. Sets meet there. Each is compared with the smallest
   set that may be the smaller one of a pair there; sets that are not near it are compared with all there, of
   which one may be the smaller one. So members that are linked already make no pairs, pages of one template
   whose own parts are too long to be near make none either, and components are still those of all pairs.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerloom.llm import common, simhash
from ledgerloom.llm.common import staged
from ledgerloom.llm.components import components
from ledgerloom.llm.simhash import lower_ascii
from ledgerloom.llm.survivors import one_per_group
from ledgerloom.operators.joins import small_side

SHINGLE, LEAST = 5, 0.8
#: Shingles that the heads of near sets share, as a share of a set's size.
SHARED = 0.1
SET_BASES = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def shingle_hashes(data, offsets, shingle=SHINGLE):
    """Text and hash of each distinct shingle of each text, by text; a text of fewer words is one shingle."""
    starts, ends, first = common.split_words(data, offsets)
    words = common.hash_words(lower_ascii(data), starts, ends)
    counts = np.diff(first)
    number = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    doc = np.repeat(np.arange(len(counts)), number)
    begin = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
    hashes = common.span_hashes(words, begin, np.minimum(begin + shingle, first[doc + 1]), common.GRAM_BASE)
    order = np.lexsort([hashes, doc])
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    return doc[new], hashes[new]


def set_prints(hashes, cuts):
    """The fingerprint of each set: bits set in over half of its hashes, zero for an empty set."""
    out = np.zeros(len(cuts) - 1, np.uint64)
    some = np.flatnonzero(np.diff(cuts))
    if len(some):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.add.reduceat(bits, cuts[some], axis=0, dtype=np.int32)
        major = sums * 2 > np.diff(cuts)[some][:, None]
        out[some] = np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()
    return out


def shingle_sets(docs, shingle=SHINGLE, least=None):
    """doc_id, sig and check (two sums over the whole set), n and shingles of each text, by hash.

    With ``least`` the shingles are the set's head alone, and ``fp`` is the fingerprint of the whole set.
    """

    def work(batches):
        for batch in common.slices(batches):
            doc, hashes = shingle_hashes(*common.text_buffers(batch.column("text")), shingle)
            cuts = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            sizes = np.diff(cuts)
            own = []
            for base in SET_BASES:
                sums = np.append(np.uint64(0), np.cumsum(common.mix(hashes ^ base), dtype=np.uint64))
                own.append(common.mix(sums[cuts[1:]] - sums[cuts[:-1]] + np.diff(cuts).astype(np.uint64)))
            prints = []
            if least is not None:
                prints = [pa.array(set_prints(hashes, cuts).view(np.int64))]
                first = np.minimum(sizes, sizes - np.ceil(sizes * least - 1e-9) + np.ceil(sizes * SHARED)).astype(np.int64)
                hashes = hashes[np.arange(len(hashes)) - cuts[doc] < first[doc]]
                cuts = np.append(0, np.cumsum(first))
            lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(x.view(np.int64)) for x in own], pa.array(sizes, pa.int32()), lists, *prints],
                names=["doc_id", "sig", "check", "n", "shingles", *(["fp"] if prints else [])],
            )

    schema = "doc_id long, sig long, check long, n int, shingles array<long>"
    return docs.mapInArrow(work, schema if least is None else f"{schema}, fp long")


def print_pairs(prints):
    """Pairs (a, b) of nodes whose fingerprints the SimHash index links, one at most for each node; ``prints`` has node and fp."""
    heads = staged(prints.groupBy("fp").agg(F.min("node").alias("head")), "prints")
    same = prints.join(heads.hint("merge"), "fp").where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    linked = simhash.links(heads.select("fp")).groupBy(F.col("a").alias("fp")).agg(F.min("b").alias("to"))
    ends = heads.select(F.col("fp").alias("to"), F.col("head").alias("b"))
    near = linked.join(heads.withColumnRenamed("head", "a"), "fp").join(ends, "to").select("a", "b")
    return same.unionByName(near)


def near_links(sets, least=LEAST, known=None):
    """Edges (a, b) whose components are those of all pairs of sets with a similarity of ``least``.

    ``sets`` has node, n and shingles, one row per distinct set; ``known`` has edges (a, b) that were found before.
    """
    if known is None:
        known = sets.sparkSession.createDataFrame([], "a long, b long")
    both_ways = known.unionByName(known.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = 2 * least / (1 + least)
    as_larger, as_smaller = (F.ceil(F.col("n") * share - 1e-9) for share in (least, both))
    rows = sets.select("node", "n", F.explode("shingles").alias("shingle"))
    often = staged(rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1"), "often")
    shared = rows.join(often.hint("merge"), "shingle")
    ranked = (
        shared.groupBy("node", "n")
        .agg(F.sort_array(F.collect_list(F.struct("sets", "shingle"))).alias("s"))
        .withColumn("met", F.size("s")).where(F.col("met") >= as_larger)
        .withColumns({"first": (F.col("met") - as_larger + 1).cast("int"), "small": (F.col("met") - as_smaller + 1).cast("int")})
        .select("node", "n", "small", F.posexplode(F.slice("s", F.lit(1), F.col("first"))).alias("at", "s"))
    )
    met = ranked.select("node", "n", F.col("s.shingle").alias("shingle"), (F.col("at") < F.col("small")).alias("small"))
    met = staged(met, "met")
    size = F.struct("n", "node")
    heads = met.where("small").groupBy("shingle").agg(F.min(size).alias("head"))
    heads = staged(heads, "heads")
    at = met.join(heads.hint("merge"), "shingle").where(size > F.col("head"))
    at = staged(at.select("shingle", "node", "n", "small", F.col("head.node").alias("head"), F.col("head.n").alias("m")), "at")
    near_size = F.col("m") >= F.ceil(F.col("n") * least - 1e-9)
    of = sets.join(staged(met.select("node").distinct(), "able").hint("merge"), "node", "left_semi")
    of = staged(of.select("node", "shingles"), "able-sets")
    first = at.where(near_size).select(F.col("node").alias("a"), F.col("head").alias("b")).distinct()
    first = first.join(both_ways, ["a", "b"], "left_anti")
    linked = staged(_near(first, of, least), "linked")
    there = linked.unionByName(both_ways).select(F.col("a").alias("node"), F.col("b").alias("head"))
    alone = staged(at.join(there.hint("merge"), ["node", "head"], "left_anti"), "alone")
    if alone.isEmpty():
        return linked.unionByName(known)
    other = at.select("shingle", F.col("node").alias("other"), F.col("n").alias("o"), F.col("small").alias("other_small"))
    mine, its = F.struct("n", "node"), F.struct(F.col("o").alias("n"), F.col("other").alias("node"))
    apart = F.when(mine < its, F.col("small")).otherwise(F.col("other_small")) & (F.col("node") != F.col("other"))
    close = F.least("n", "o") >= F.ceil(F.greatest("n", "o") * least - 1e-9)
    pairs = alone.join(other.hint("merge"), "shingle").where(apart & close)
    pairs = pairs.select(F.greatest("node", "other").alias("a"), F.least("node", "other").alias("b")).distinct()
    return linked.unionByName(known).unionByName(_near(pairs, of, least))


def _near(pairs, of, least):
    a = of.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    b = of.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(a.hint("merge"), "a").join(b.hint("merge"), "b")
        .where(both >= least * (F.size("x") + F.size("y") - both) - 1e-9).select("a", "b")
    )


def able_nodes(heads, least=LEAST):
    """The nodes of sets whose head (node, n, shingles) shares so many shingles with others as it must with a near one.

    A near set is of at least ``least`` of its size, and so is the number of shingles that both heads share.
    """
    rows = heads.select("node", "n", F.explode("shingles").alias("shingle"))
    often = staged(rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1").select("shingle"), "often")
    met = rows.join(often.hint("merge"), "shingle").groupBy("node", "n").agg(F.count(F.lit(1)).alias("met"))
    return met.where(F.col("met") >= F.ceil(F.col("n") * (SHARED * least) - 1e-9)).select("node")


def near_groups(df, text="text", key="doc_id", shingle=SHINGLE, least=LEAST):
    """Each row's set and component: doc_id, sig (its two sums) and component.

    Null text is empty; texts without words are equal; null keys, repeated rows and equal texts take part.
    """
    docs = common.documents(df, text, key)
    found = shingle_sets(docs, shingle, least).withColumn("row", F.monotonically_increasing_id())
    rows = staged(found, "shingle-heads")
    firsts = staged(rows.groupBy("sig", "check").agg(F.min("row").alias("node")), "firsts")
    named = staged(rows.select("doc_id", "sig", "check", "row").join(firsts.hint("merge"), ["sig", "check"]), "signatures")
    copies = staged(named.where("row <> node").select("row"), "copies")
    heads = rows.join(small_side(copies), "row", "left_anti").select(F.col("row").alias("node"), "n", "shingles")
    prints = rows.join(small_side(copies), "row", "left_anti").select(F.col("row").alias("node"), "fp")
    able = staged(able_nodes(heads, least), "able")
    met = staged(print_pairs(prints), "print-pairs")
    of = staged(named.join(able.hint("merge"), "node", "left_semi").select("doc_id", "sig", "check", "node"), "able-rows")
    wanted = small_side(staged(of.select(F.col("doc_id").alias("_key")).distinct(), "able-keys"))
    again = shingle_sets(docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("_key")), "left_semi"), shingle)
    nodes = of.select("sig", "check", "node").distinct()
    sets = again.join(small_side(staged(nodes, "able-nodes")), ["sig", "check"]).dropDuplicates(["node"])
    sets = staged(sets.select("node", "n", "shingles"), "shingle-sets")
    known = staged(_near(met, sets.select("node", "shingles"), least), "known")
    labels = staged(components(near_links(sets, least, known)), "labels")
    out = named.join(labels.hint("merge"), "node", "left").withColumn("component", F.coalesce("root", "node"))
    return staged(out.select("doc_id", F.struct("sig", "check").alias("sig"), "component"), "groups")


def kept_rows(df, text="text", key="doc_id", shingle=SHINGLE, least=LEAST):
    """The rows of ``df`` that are the first of their component, with all their columns; see ``one_per_group``."""
    def sign(docs):
        return shingle_sets(docs, shingle).select("doc_id", F.struct("sig", "check").alias("sig"))

    return one_per_group(df, near_groups(df, text, key, shingle, least), sign, text, key)
