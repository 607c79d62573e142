"""SimHash near-dedup (8) with a Gray-order hierarchical index.

1. Each text becomes a 64-bit fingerprint of its word shingles; only distinct
   fingerprints go on.
2. Fingerprints that differ in at most ``DISTANCE`` bits agree on one of
   ``DISTANCE + 1`` fields of the word, and within the rest again on one of as many
   parts. These shared masked bit patterns are the upper nodes: a fingerprint goes to
   each node that it matches, and all that could link meet in one. A node with
   more than ``NODE`` fingerprints is divided by parts of the bits still free, until
   the nodes are small.
3. Below its upper node, fingerprints stand in Gray order in nodes of ``FAN``, these
   again in nodes of ``FAN``; each keeps the bits that all its members share. Pairs of
   nodes are followed from the top; the differences of their shared bits bound
   those of the members from below, so whole groups are pruned.
4. A node of the index gives a forest, not its pairs, so its output has fewer rows than
   members; components are found on tables.
"""

import numpy as np
import pyarrow as pa
import xxhash

from pyspark.sql import functions as F

from ledgerloom.llm import common
from ledgerloom.llm.common import staged
from ledgerloom.llm.components import components
from ledgerloom.llm.survivors import one_per_group

SHINGLE, SEED, DISTANCE = 3, 42, 3
NODE, FAN = 2048, 8
#: Node pairs followed at a time in a task.
PAIRS = 1 << 20


def lower_ascii(data):
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def fingerprints(data, offsets, shingle=SHINGLE, seed=SEED):
    """A fingerprint per text of a byte array: bits set in over half of the shingles' hashes."""
    starts, ends, first = common.split_words(data, offsets)
    counts = np.diff(first)
    out = np.zeros(len(counts), np.uint64)
    if not len(starts):
        return out
    # words of all texts one after another, each followed by a blank
    length = ends - starts
    at = np.append(0, np.cumsum(length + 1))
    joined = np.full(at[-1], 32, np.uint8)
    place = np.arange(length.sum())
    within = place - np.repeat(np.cumsum(length) - length, length)
    joined[np.repeat(at[:-1], length) + within] = lower_ascii(data)[np.repeat(starts, length) + within]
    number = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    doc = np.repeat(np.arange(len(counts)), number)
    begin = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
    end = np.minimum(begin + shingle, first[doc + 1])
    raw, digest = joined.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(raw[a:b], seed) for a, b in zip(at[begin].tolist(), (at[end] - 1).tolist())), np.uint64, len(doc)
    )
    some = np.flatnonzero(number)
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.add.reduceat(bits, (np.cumsum(number) - number)[some], axis=0, dtype=np.int32)
    major = sums * 2 > number[some][:, None]
    out[some] = np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()
    return out


def gray_rank(x):
    """The place of a word in the Gray code."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


def masks(fields):
    """Masks of ``DISTANCE + 1`` runs of the given bit places."""
    cuts = [round(i * len(fields) / (DISTANCE + 1)) for i in range(DISTANCE + 2)]
    return [sum(1 << f for f in fields[a:b]) for a, b in zip(cuts, cuts[1:])]


def divided(mask):
    """The masks that divide a node further: its own bits and a part of the free ones."""
    return [mask | m for m in masks([b for b in range(64) if not mask >> b & 1])]


def levels(depth):
    found = masks(list(range(64)))
    for _ in range(depth - 1):  # two ways may lead to one mask
        found = list(dict.fromkeys(m for mask in found for m in divided(mask)))
    return found


def signed(x):
    return x - (1 << 64) if x >> 63 else x


class Forest:
    """Sets joined by pairs; the smallest member names a set."""

    def __init__(self, size):
        self.root = np.arange(size)

    def join(self, a, b):
        while len(a):
            a, b = self.root[a], self.root[b]
            differ = a != b
            a, b = a[differ], b[differ]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up


def linked(group, prints, distance=DISTANCE):
    """For each fingerprint the first one of its set within its group; sorted by group and Gray rank."""
    forest = Forest(len(prints))
    # levels of the index, leaves first: shared ones, any ones, first child, group
    one, any_, owner = prints, prints, group
    tree = []
    while True:
        tree.append((one, any_, owner))
        _, first, size = np.unique(owner, return_index=True, return_counts=True)
        if (size == 1).all():
            break
        within = np.arange(len(owner)) - np.repeat(first, size)
        heads = np.flatnonzero(within % FAN == 0)
        one, any_ = np.bitwise_and.reduceat(one, heads), np.bitwise_or.reduceat(any_, heads)
        tree[-1] += (np.append(heads, len(owner)),)
        owner = owner[heads]
    top = np.arange(len(tree[-1][2]))
    stack = [(len(tree) - 1, top, top)]
    while stack:
        level, a, b = stack.pop()
        if len(a) > PAIRS:
            half = len(a) // 2
            stack += [(level, a[:half], b[:half]), (level, a[half:], b[half:])]
            continue
        one, any_ = tree[level][:2]
        # bits that all members of a have and none of b, or the other way round
        least = np.bitwise_count((one[a] & ~any_[b]) | (one[b] & ~any_[a]))
        near = least <= distance
        a, b = a[near], b[near]
        if not level:
            forest.join(a[a != b], b[a != b])
            continue
        heads = tree[level - 1][3]
        na, nb = heads[a + 1] - heads[a], heads[b + 1] - heads[b]
        size = na * nb
        pair = np.repeat(np.arange(len(a)), size)
        k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        x, y = heads[a][pair] + k // nb[pair], heads[b][pair] + k % nb[pair]
        keep = x <= y
        stack.append((level - 1, x[keep], y[keep]))
    return forest.root


def _nodes(prints, at_masks):
    """Each fingerprint with the upper nodes (mask, pattern) that it matches."""
    each = F.explode(F.array(*[F.lit(signed(m)) for m in at_masks])).alias("mask")
    return prints.select("fp", each).select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("pattern"))


def _search(nodes):
    """Links within each upper node: (a, b), one less than the fingerprints of each set."""

    def search(batches):
        held, last = [], None

        def result():
            mask, pattern, fp = (np.concatenate(c) for c in zip(*held))
            group = np.cumsum(np.append(0, (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])))
            prints = fp.view(np.uint64)
            order = np.lexsort([gray_rank(prints), group])
            group, fp, prints = group[order], fp[order], prints[order]
            root = linked(group, prints)
            child = np.flatnonzero(root != np.arange(len(root)))
            return pa.RecordBatch.from_arrays([pa.array(fp[child]), pa.array(fp[root[child]])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy() for c in ("mask", "pattern", "fp")]
            key = cols[0] ^ common.mix(cols[1].view(np.uint64)).view(np.int64)
            cut = 0
            if sum(len(h[0]) for h in held) > PAIRS // 16:  # search what is whole so far
                new = np.flatnonzero(np.append(key[0] != last, key[1:] != key[:-1]))
                if len(new):
                    cut = int(new[0])
                    if cut:
                        held.append([c[:cut] for c in cols])
                    yield result()
                    held = []
            held.append([c[cut:] for c in cols])
            last = key[-1]
        if held:
            yield result()

    return (
        nodes.repartition("mask", "pattern").sortWithinPartitions("mask", "pattern").mapInArrow(search, "a long, b long")
    )


def links(prints, node=NODE):
    """Edges (a, b) between distinct fingerprints whose components are those of all pairs within ``DISTANCE`` bits."""
    depth, found = 2, []
    nodes = _nodes(prints, levels(depth))
    while True:
        sizes = nodes.groupBy("mask", "pattern").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        small = nodes.join(sizes.where(F.col("n") <= node).drop("n"), ["mask", "pattern"])
        found.append(staged(_search(small), "links"))
        large = staged(nodes.join(sizes.where(F.col("n") > node).drop("n"), ["mask", "pattern"]), "large")
        if large.isEmpty():
            break
        parts = F.create_map(
            *[x for m in levels(depth) for x in (F.lit(signed(m)), F.array(*[F.lit(signed(d)) for d in divided(m)]))]
        )
        depth += 1
        nodes = large.select("fp", F.explode(parts[F.col("mask")]).alias("mask")).select(
            "fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("pattern")
        ).distinct()
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()


def prints_of(docs):
    """doc_id and fp, the fingerprint, of documents (doc_id, text)."""

    def work(batches):
        for batch in common.slices(batches):
            found = fingerprints(*common.text_buffers(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fp"]
            )

    return docs.mapInArrow(work, "doc_id long, fp long")


def near_groups(df, text="text", key="doc_id", node=NODE):
    """Each row's fingerprint (long) and component: doc_id, fp, component_id, the smallest doc_id reachable.

    Null text is empty; a text without words has fingerprint zero, which links like any
    other; a null key takes part but names no component unless all keys in it are null.
    Repeated rows and equal texts share a fingerprint. Other columns do not matter.
    """
    rows = staged(prints_of(common.documents(df, text, key)), "fingerprints")
    prints = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    labels = components(links(prints.select("fp"), node)).select(F.col("node").alias("fp"), "root")
    named = staged(prints.join(labels, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "named")
    names = staged(named.groupBy("root").agg(F.min("least").alias("component_id")), "names")
    by_print = staged(named.join(names.hint("merge"), "root").select("fp", "root", "component_id"), "components")
    return rows.join(by_print, "fp").select("doc_id", "fp", "component_id", "root")


def kept_rows(df, text="text", key="doc_id"):
    """The rows of ``df`` that are the first of their component, with all their columns; see ``one_per_group``."""
    groups = near_groups(df, text, key).select("doc_id", F.col("fp").alias("sig"), F.col("root").alias("component"))
    return one_per_group(df, staged(groups, "groups"), lambda docs: prints_of(docs).withColumnRenamed("fp", "sig"), text, key)
