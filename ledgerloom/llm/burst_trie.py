"""Prefix trie of conversations (13) as a burst trie over turn identifiers.

A turn is a record of 24 bytes: 128 bits of the SHA-256 of role and text, and the text's length. A path is
the records of a conversation; equal paths are one with a count.

1. All paths start in one container under the root. A container of more than ``LIMIT`` paths or ``SIZE``
   bytes bursts: what its paths have in common becomes a chain of nodes, and each next turn the head of a
   container of the remaining suffixes. Copies are one path, so what bursts has a branch to burst at.
2. Containers that are small enough are dealt to tasks, sorted, and swept into nodes.
3. Totals of subtrees go up from heads to the chains they hang on, round by round.

Rows of a container are counted and bounded by aggregates, so a first turn that a third of all
conversations share costs no single task; one row per head goes up.
"""

import pyarrow as pa
from pyspark.sql import functions as F

from ledgerloom.llm import common
from ledgerloom.llm.common import staged
from ledgerloom.llm.digests import stream_digests
from ledgerloom.operators.joins import small_side

#: Paths and bytes of suffixes that one container may hold; a single path may be longer.
LIMIT, SIZE = 1024, 16 << 20
RECORD, NAME = 24, 16
#: Conversations whose first turns others begin with, by ``rebuilt``, and how many turns that are at most.
FAMILY, BORROWED = 100, 6
ROOT = "root"
NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "sig string, head string"
)
NAMES = [c.split()[0] for c in NODE.split(", ")]


def paths(df, conv="conv_id", turn="turn", role="role", text="text"):
    """conv_id and path, the records of its turns, of each conversation of ``df``."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    name = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    record = F.concat(F.substring(name, 1, 2 * NAME), F.lpad(F.hex(F.length(text).cast("long")), 2 * (RECORD - NAME), "0"))
    rows = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.struct(F.col(turn), role.alias("role"), record.alias("record")).alias("row")
    )
    held = F.transform(F.sort_array(F.collect_list("row")), lambda x: x["record"])
    return rows.groupBy("conv_id").agg(F.unhex(F.array_join(held, "")).alias("path"))


def rebuilt(convs):
    """Conversations that begin with the first turns of their family's first one; see the contract of the query."""
    own = staged(convs, "own-paths")
    cut = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(BORROWED))
    heads = own.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("_first"), F.expr(f"substring(path, 1, {(BORROWED - 1) * RECORD})").alias("_head")
    )
    named = own.withColumns({"_family": F.col("conv_id") - F.col("conv_id") % FAMILY, "_cut": (cut * RECORD).cast("int")})
    both = named.join(heads, F.col("_family") == F.col("_first"), "left")
    return both.select(
        "conv_id", F.expr("concat(substring(coalesce(_head, X''), 1, _cut), substring(path, _cut + 1))").alias("path")
    )


def common_records(a, b):
    """Bytes of the records that two paths have in common at their start."""
    most, at = min(len(a), len(b)), 0
    while at < most and a[at : at + RECORD] == b[at : at + RECORD]:
        at += RECORD
    return at


def length_of(record):
    return int.from_bytes(record[NAME:RECORD], "big")


def sweep(rows, head, depth, above, own):
    """Nodes of a container: its head first. ``rows`` are (suffix, n, least, sig), sorted by suffix."""
    level, size, parent, n, least, sigs = [depth], [own], [-1], [0], [None], [None]
    stack, before = [0], b""
    for suffix, count, smallest, sig in rows:
        shared = common_records(before, suffix)
        del stack[shared // RECORD + 1 :]
        for at in range(shared, len(suffix), RECORD):
            level.append(depth + at // RECORD + 1)
            size.append(length_of(suffix[at : at + RECORD]))
            parent.append(stack[-1])
            n.append(0)
            least.append(None)
            sigs.append(None)
            stack.append(len(level) - 1)
        top = stack[-1]
        n[top], least[top], sigs[top] = n[top] + count, smallest, sig
        before = suffix
    children, leaves, saved = [0] * len(level), [0] * len(level), [0] * len(level)
    for i in range(len(level) - 1, -1, -1):  # children come after their parent
        leaves[i] += not children[i]
        saved[i] += (n[i] - 1) * size[i]
        p = parent[i]
        if p >= 0:
            n[p], children[p], leaves[p], saved[p] = n[p] + n[i], children[p] + 1, leaves[p] + leaves[i], saved[p] + saved[i]
            least[p] = least[i] if least[p] is None else min(least[p], least[i])
    for i in range(len(level)):
        yield (least[i], level[i], least[parent[i]] if i else above, n[i], children[i], leaves[i], saved[i], sigs[i],
               None if i else head)


def chain_nodes(row):
    """Nodes of a container that burst: its head, then what its paths have in common."""
    sizes = [row["own"]] + [length_of(row["chain"][at : at + RECORD]) for at in range(0, len(row["chain"]), RECORD)]
    saved, out = row["saved"], []
    for j in range(len(sizes) - 1, -1, -1):
        saved += (row["n"] - 1) * sizes[j]
        last = j == len(sizes) - 1
        out.append((row["least"], row["depth"] + j, row["least"] if j else row["above"], row["n"],
                    row["children"] if last else 1, row["leaves"], saved, row["sig"] if last else None,
                    None if j else row["head"]))
    return out


def _batches(rows, schema, limit=10_000):
    """Rows (tuples) in record batches."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) == limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _schema():
    return pa.schema([(name, pa.string() if name in ("sig", "head") else pa.int64()) for name in NAMES])


def swept(settled):
    """Nodes of all settled containers; each container comes sorted to one task, which holds one at a time."""
    common.ship(settled.sparkSession)

    def rows_of(batches):
        for batch in common.slices(batches, "suffix"):
            yield from zip(*(batch.column(c).to_pylist() for c in ("head", "suffix", "n", "least", "sig", "depth", "above", "own")))

    def nodes(batches):
        now, rows, top = None, [], None
        for head, suffix, n, least, sig, *rest in rows_of(batches):
            if head != now and rows:
                yield from sweep(rows, now, *top)
                rows = []
            now, top = head, rest
            rows.append((suffix, n, least, sig))
        if rows:
            yield from sweep(rows, now, *top)

    dealt = settled.repartition("head").sortWithinPartitions("head", "suffix")
    dealt = dealt.select("head", "suffix", "n", "least", "sig", "depth", "above", "own")
    return dealt.mapInArrow(lambda batches: _batches(nodes(batches), _schema()), NODE)


def _chains(bounds):
    """bounds with ``chain``, what the first and the last of a container's sorted paths have in common."""
    common.ship(bounds.sparkSession)

    def work(batches):
        for batch in batches:
            ends = zip(batch.column("low").to_pylist(), batch.column("high").to_pylist())
            chain = pa.array([a[: common_records(a, b)] for a, b in ends], pa.binary())
            kept = [batch.column(c) for c in ("head", "n", "least")]
            yield pa.RecordBatch.from_arrays([*kept, chain], names=["head", "n", "least", "chain"])

    return bounds.mapInArrow(work, "head string, n long, least long, chain binary")


def _chain_rows(branches):
    def work(batches):
        rows = (node for batch in batches for row in batch.to_pylist() for node in chain_nodes(row))
        yield from _batches(rows, _schema())

    return branches.mapInArrow(work, NODE)


def trie(convs, limit=LIMIT, size=SIZE):
    """The nodes of the trie of ``convs`` (conv_id, path), one row each.

    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves and
    saved_tokens of the subtree, ends_sha256 of the members that end there. Conversations without a turn are
    members of the root; equal conversations share all nodes; an empty table has no node. A path is one
    cell (24 bytes a turn), and the digest of ends is taken by one task, an id at a time; all else is split.
    """
    spark = convs.sparkSession
    convs = staged(convs.withColumn("sig", F.sha2("path", 256)), "paths")
    distinct = convs.groupBy("sig", "path").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"))
    live = staged(distinct.select(F.lit(ROOT).alias("head"), F.col("path").alias("suffix"), "n", "least", "sig"), "live")
    none = F.lit(None).cast("long")
    heads = staged(
        spark.range(1).select(
            F.lit(ROOT).alias("head"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"),
            none.alias("above"), F.lit(0).cast("long").alias("own"),
        ),
        "root",
    )
    settled, rounds = [], []
    while True:
        sizes = live.groupBy("head").agg(F.count(F.lit(1)).alias("paths"), F.sum(F.length("suffix")).alias("bytes"))
        big = staged(sizes.where((F.col("paths") > limit) | ((F.col("bytes") > size) & (F.col("paths") > 1))).select("head"), "big")
        if big.isEmpty():
            settled.append(live.join(heads.hint("merge"), "head"))
            break
        settled.append(live.join(small_side(big), "head", "left_anti").join(heads.hint("merge"), "head"))
        hot = live.join(small_side(big), "head")
        bounds = hot.groupBy("head").agg(
            F.sum("n").alias("n"), F.min("least").alias("least"), F.min("suffix").alias("low"), F.max("suffix").alias("high")
        )
        branches = staged(_chains(bounds).join(heads.hint("merge"), "head"), "branches")
        cut = branches.select("head", F.length("chain").alias("cut"), F.col("least").alias("top"), (
            F.col("depth") + F.length("chain") / RECORD + 1).cast("long").alias("level"))
        rest = hot.join(small_side(cut), "head").withColumn("rest", F.expr("substring(suffix, cut + 1)"))
        rest = rest.withColumn("next", F.expr(f"substring(rest, 1, {RECORD})"))
        child = F.when(F.length("rest") > 0, F.sha2(F.concat(F.col("head").cast("binary"), "next"), 256))
        rest = staged(
            rest.select(
                child.alias("head"), F.col("head").alias("parent"), "level", "top", "next",
                F.expr(f"substring(rest, {RECORD + 1})").alias("suffix"), "n", "least", "sig",
            ),
            "burst",
        )
        ends = rest.where("head is null").select(F.col("parent").alias("head"), "sig")
        live = rest.where("head is not null").select("head", "suffix", "n", "least", "sig")
        own = F.conv(F.substring(F.hex("next"), 2 * NAME + 1, 2 * (RECORD - NAME)), 16, 10).cast("long")
        heads = staged(
            rest.where("head is not null").groupBy("head", "parent", "level", "top", "next").agg(F.count(F.lit(1)).alias("_"))
            .select("head", "parent", F.col("level").alias("depth"), F.col("top").alias("above"), own.alias("own")),
            "heads",
        )
        rounds.append((branches, ends, heads))
    containers = settled[0]
    for more in settled[1:]:
        containers = containers.unionByName(more)
    found = [staged(swept(containers), "nodes")]
    tops = found[0].where("head is not null").select("head", "n_leaves", "saved_tokens")
    for branches, ends, heads in reversed(rounds):
        up = heads.join(tops.hint("merge"), "head").groupBy("parent").agg(
            F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.count(F.lit(1)).alias("children")
        )
        up = staged(up.withColumnRenamed("parent", "head"), "up")
        whole = branches.drop("parent").join(up.hint("merge"), "head").join(ends.hint("merge"), "head", "left")
        found.append(staged(_chain_rows(whole), "nodes"))
        tops = tops.unionByName(found[-1].where("head is not null").select("head", "n_leaves", "saved_tokens"))
    nodes = found[0]
    for more in found[1:]:
        nodes = nodes.unionByName(more)
    digests = stream_digests(convs, "sig", ["conv_id"], F.col("conv_id").cast("string"), ",", "ends_sha256")
    ended = nodes.where("sig is not null").join(digests.hint("merge"), "sig")
    inner = nodes.where("sig is null").withColumn("ends_sha256", F.sha2(F.lit("").cast("binary"), 256))
    columns = [c for c in NAMES if c not in ("sig", "head")] + ["ends_sha256"]
    return ended.select(columns).unionByName(inner.select(columns))


def conversation_trie(df, rebuild=False, **columns):
    """The trie of the conversations of ``df``: see ``trie``.

    Turns come by turn, null first, ties by role and record; null role or text is empty. Rows without
    a conversation's id belong to none and take no part; repeated rows are turns like any other; other
    columns do not matter. With ``rebuild`` conversations first take their family's first turns.
    """
    convs = paths(df, **columns)
    return trie(rebuilt(convs) if rebuild else convs)
