"""Structure repair of conversations (12) by a run-length min-plus programme over role and fault symbols.

Each row is one symbol: its role's initial and whether it must go, is cut short or is sound. The cheapest
edits that lead to ``(s?(ua)+)?`` are a shortest path over four states: nothing yet, after s, after u, after a.

1. Rows are sorted over all tasks; the rows of a conversation within ``SEGMENT`` places are a segment, so a
   conversation of any length is in many. Equal consecutive symbols of a segment are a run, which
   is advanced by cached binary powers of its symbol's 4 x 4 min-plus transition.
2. The products of the segments are folded per conversation, backwards: what is left to pay behind each
   segment, from each state.
3. With that, each segment unrolls its choices for each state it may be entered in, the ASCII-least of the
   cheapest at every step; which state it is entered in follows from the segments before it.

Only 16 numbers a segment meet per conversation, never its rows.
"""

from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerloom.llm import common
from ledgerloom.llm.common import staged
from ledgerloom.llm.digests import stream_digests
from ledgerloom.operators.batch import in_order

INK = r"[^\x20\x09-\x0D]"
ENDS = ".!?"
REROLE, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3
#: Places, a power of two, whose rows of one conversation are a segment.
SEGMENT = 1 << 12
INITIALS = "sua"
SOUND, CUT, GONE = range(3)
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a role's initial, where that is allowed, and the role that may come next.
AFTER = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
NEXT_ROLE = ("user", "user", "assistant", "user")
#: What is left to pay, and the edits, when no row is left.
END, END_EDITS = (0, 2 * INSERT, INSERT, 0), ("", "II", "I", "")
NEVER = 1 << 60
#: Symbol strings up to this length are remembered with their transition.
USUAL = 64


def symbol(initial, fault):
    return chr(ord("a") + 3 * (INITIALS + "o").index(initial) + fault)


def parts(sym):
    """Initial (o: any other) and fault of a symbol."""
    code = ord(sym) - ord("a")
    return (INITIALS + "o")[code // 3], code % 3


def edits_of(sym, state):
    """(letter, cost, state after it) of the edits that take a row, by letter."""
    initial, fault = parts(sym)
    out = [("D", DELETE, state)]
    if fault != GONE:
        extra = UNFINISHED if fault == CUT else 0
        if initial in AFTER[state]:
            out.append(("K", extra, AFTER[state][initial]))
        out.append(("R", REROLE + extra, inserted(state)))
    return out


def inserted(state):
    """The state after the one role that may come next."""
    return AFTER[state][NEXT_ROLE[state][0]]


def chained(a, b):
    """The min-plus product of two transitions."""
    return np.minimum((a[:, :, None] + b[None]).min(axis=1), NEVER)


@lru_cache(maxsize=None)
def power(sym, k):
    """The transition of 2**k equal rows, insertions before each row included."""
    if k:
        half = power(sym, k - 1)
        return chained(half, half)
    insert, take = np.full((4, 4), NEVER), np.full((4, 4), NEVER)
    for state in range(4):
        at, cost = state, 0
        for _ in range(3):  # a third insertion leads back to where one has been
            insert[state, at] = min(insert[state, at], cost)
            at, cost = inserted(at), cost + INSERT
        for _, cost, to in edits_of(sym, state):
            take[state, to] = min(take[state, to], cost)
    return chained(insert, take)


def transition(symbols):
    """The transition of a segment, run by run."""
    out = None
    for sym, run in groupby(symbols):
        length = sum(1 for _ in run)
        for k in range(length.bit_length()):
            if length >> k & 1:
                out = power(sym, k) if out is None else chained(out, power(sym, k))
    return tuple(map(int, out.ravel()))


usual_transition = lru_cache(maxsize=1 << 14)(transition)


@lru_cache(maxsize=1 << 14)
def step(sym, after):
    """What is left to pay before a row, given the same behind it (less its least), that least, and for each
    state the edits up to this row, ASCII-least of the cheapest, with the state they lead to.
    """
    taken = [min(cost + after[to] for _, cost, to in edits_of(sym, s)) for s in range(4)]
    pay = []
    for s in range(4):
        at, cost, best = s, 0, NEVER
        for _ in range(3):
            best = min(best, cost + taken[at])
            at, cost = inserted(at), cost + INSERT
        pay.append(best)
    moves = []
    for s in range(4):
        letters, at, over = "", s, False
        while not over:
            own = [("I", INSERT + pay[inserted(at)], inserted(at), False)]
            own += [(letter, cost + after[to], to, True) for letter, cost, to in edits_of(sym, at)]
            letter, at, over = next((e, to, o) for e, cost, to, o in sorted(own) if cost == pay[at])
            letters += letter
        moves.append((letters, at))
    least = min(pay)
    return tuple(p - least for p in pay), least, tuple(moves)


def unrolled(symbols, after, last):
    """Edits of a segment and the state behind it, for each state it may be entered in."""
    low = min(after)
    now, steps = tuple(a - low for a in after), []
    for sym in reversed(symbols):
        now, _, moves = step(sym, now)
        steps.append(moves)
    out = []
    for state in range(4):
        letters = []
        for moves in reversed(steps):
            more, state = moves[state]
            letters.append(more)
        out.append(("".join(letters) + (END_EDITS[state] if last else ""), state))
    return out


def backwards(matrices):
    """What is left to pay behind each segment, by state, and from the start on."""
    now, out = np.array(END), []
    for m in reversed(matrices):
        out.append(now)
        now = np.minimum((np.array(m).reshape(4, 4) + now[None]).min(axis=1), NEVER)
    return out[::-1], int(now[START])


def legal(a, b):
    return parts(a)[0] + parts(b)[0] in ("su", "ua", "au")


def damaged(df):
    """Conversations with faults put in by crc32 of ``conv_id:turn``; null keys there, roles and texts read as one space."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
    return (
        df.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), kind.alias("kind"))
        .where("kind <> 0")
        .withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select(
            "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
            text.otherwise(F.col("text")).alias("text"),
        )
    )


def faults(df, conv="conv_id", turn="turn", role="role", text="text"):
    """The rows in order, each with its first fault: conv_id, turn, role, text, place, part, blank, duplicate, truncated; staged."""
    own = df.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    rows = in_order(own, [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"], "turns")
    blank = ~F.col("text").rlike(INK)
    last = F.regexp_extract("text", rf"(?s)({INK})[\x20\x09-\x0D]*\z", 1)
    marked = rows.select(
        "conv_id", "place", "role", F.sha2("text", 256).alias("dig"), blank.alias("blank"),
        (~blank & ~last.isin(*ENDS)).alias("cut"),
    )
    # the first of equal rows is told by its place, which is no one else's: that join has no hot key
    first = marked.where("not blank").groupBy("conv_id", "role", "dig").agg(F.min("place").alias("first"))
    first = staged(first.select("first"), "firsts")
    seen = marked.drop("dig").join(first.hint("merge"), F.col("place") == F.col("first"), "left")
    duplicate = ~F.col("blank") & F.col("first").isNull()
    flags = seen.select(
        "conv_id", "place", "role", "blank", duplicate.alias("duplicate"), (F.col("cut") & ~duplicate).alias("truncated")
    )
    return rows, staged(flags, "faults")


def segments(flags):
    """One row per conversation and segment: at (its first place), symbols, counts of faults."""
    initial = F.substring("role", 1, 1)
    fault = F.when(F.col("blank") | F.col("duplicate"), GONE).when(F.col("truncated"), CUT).otherwise(SOUND)
    kind = F.coalesce(*[F.when(initial == c, 3 * i) for i, c in enumerate(INITIALS)], F.lit(3 * len(INITIALS)))
    count = lambda c: F.sum(F.col(c).cast("long")).alias(c)
    held = F.sort_array(F.collect_list(F.struct("place", "sym")))
    return (
        flags.withColumn("sym", F.char(F.lit(ord("a")) + kind + fault))
        .withColumn("segment", F.shiftright("place", SEGMENT.bit_length() - 1))
        .groupBy("conv_id", "segment")
        .agg(
            F.min("place").alias("at"), count("blank"), count("duplicate"), count("truncated"),
            F.array_join(F.transform(held, lambda x: x["sym"]), "").alias("symbols"),
        )
        .drop("segment")
    )


def _mapped(df, fn, schema):
    """``fn`` of each row (a dict) gives rows (dicts) of ``schema``."""
    common.ship(df.sparkSession)
    empty = df.sparkSession.createDataFrame([], schema)
    wanted = pa.schema([(f.name, _arrow(f.dataType)) for f in empty.schema.fields])

    def work(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                rows = [out for row in batch.slice(lo, 512).to_pylist() for out in fn(row)]
                yield pa.RecordBatch.from_pylist(rows, wanted)

    return df.mapInArrow(work, empty.schema)


def _arrow(kind):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _with_transition(row):
    symbols = row["symbols"]
    matrix = usual_transition(symbols) if len(symbols) <= USUAL else transition(symbols)
    bad = sum(not legal(a, b) for a, b in zip(symbols, symbols[1:]))
    yield {"conv_id": row["conv_id"], "at": row["at"], "matrix": matrix, "illegal": bad, "edge": symbols[0] + symbols[-1]}


def _folded(row):
    held = row["held"]
    after, cost = backwards([x["matrix"] for x in held])
    illegal = sum(x["illegal"] for x in held) + sum(not legal(a["edge"][1], b["edge"][0]) for a, b in zip(held, held[1:]))
    for i, x in enumerate(held):
        yield {"conv_id": row["conv_id"], "at": x["at"], "after": [int(v) for v in after[i]], "last": i == len(held) - 1,
               "cost": cost, "illegal": illegal}


def _ways(row):
    ways = unrolled(row["symbols"], row["after"], row["last"])
    yield {"conv_id": row["conv_id"], "at": row["at"], "edits": [w for w, _ in ways], "ends": [s for _, s in ways]}


def _entered(row):
    state = START
    for x in row["held"]:
        yield {"at": x["at"], "state": state}
        state = x["ends"][state]


def _listed(row):
    """A row per edit but deletions: the place of its row (null: inserted), its number in the segment, its new role (null: as it is)."""
    state, place = row["state"], row["at"]
    for number, letter in enumerate(row["audit"]):
        role = None
        if letter == "K":
            state = AFTER[state][row["symbols_initials"][place - row["at"]]]
        elif letter != "D":
            role, state = NEXT_ROLE[state], inserted(state)
        if letter != "D":
            yield {"conv_id": row["conv_id"], "at": row["at"], "number": number, "new_role": role,
                   "place": None if letter == "I" else place}
        place += letter != "I"


def _unrolled_rows(row):
    return _listed(row | {"symbols_initials": [parts(s)[0] for s in row["symbols"]]})


class Repair:
    """The cheapest repair of conversations; see ``repair``."""

    def __init__(self, df, **columns):
        conv = columns.get("conv", "conv_id")
        kind = df.select(conv).schema[0].dataType.simpleString()
        self.rows, self.flags = faults(df, **columns)
        segs = staged(segments(self.flags), "segments")
        matrices = _mapped(
            segs.select("conv_id", "at", "symbols"), _with_transition,
            f"conv_id {kind}, at long, matrix array<long>, illegal long, edge string",
        )
        held = F.sort_array(F.collect_list(F.struct("at", "matrix", "illegal", "edge"))).alias("held")
        folded = _mapped(
            matrices.groupBy("conv_id").agg(held), _folded,
            f"conv_id {kind}, at long, after array<long>, last boolean, cost long, illegal long",
        )
        self.folded = staged(folded, "folded")
        ahead = segs.select("conv_id", "at", "symbols").join(self.folded.select("at", "after", "last").hint("merge"), "at")
        ways = staged(_mapped(ahead, _ways, f"conv_id {kind}, at long, edits array<string>, ends array<int>"), "ways")
        chain = ways.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "ends"))).alias("held"))
        entered = staged(_mapped(chain, _entered, "at long, state int"), "entered")
        audits = ways.join(entered.hint("merge"), "at").select("conv_id", "at", "state", F.expr("edits[state]").alias("audit"))
        self.audits = staged(audits, "audits")
        self.segments, self.kind = segs, kind

    def conversations(self):
        """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of each conversation that has rows."""
        turns = self.rows.groupBy("conv_id").agg(
            (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).cast("long").alias("gaps")
        )
        counts = self.segments.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
        paid = self.folded.where("last").select("conv_id", "illegal", "cost")
        held = F.sort_array(F.collect_list(F.struct("at", "audit")))
        audit = self.audits.groupBy("conv_id").agg(F.array_join(F.transform(held, lambda x: x["audit"]), "").alias("audit"))
        out = turns
        for more in (counts, paid, audit):
            out = _beside(out, more)
        return out.withColumn("gaps", F.coalesce("gaps", F.lit(0).cast("long")))

    def turns(self):
        """The repaired turns: conv_id, at and number (their order), place (null where inserted), role, text."""
        whole = self.audits.join(self.segments.select("at", "symbols").hint("merge"), "at")
        listed = _mapped(whole, _unrolled_rows, f"conv_id {self.kind}, at long, number long, new_role string, place long")
        edits = staged(listed, "edits")
        kept = edits.where("place is not null").join(self.rows.select("place", "role", "text").hint("merge"), "place")
        kept = kept.select("conv_id", "at", "number", "place", F.coalesce("new_role", "role").alias("role"), "text")
        new = edits.where("place is null").select(
            "conv_id", "at", "number", "place", F.col("new_role").alias("role"), F.lit("").alias("text")
        )
        return kept.unionByName(new)


def _beside(df, more):
    """``more``, one row per conversation, at the rows of ``df``; null is a conversation like any other."""
    return df.join(more.withColumnRenamed("conv_id", "_of"), F.col("conv_id").eqNullSafe(F.col("_of")), "left").drop("_of")


def repair(df, **columns):
    """The repair of all conversations of ``df`` (columns conv, turn, role, text may be named otherwise).

    Rows of a conversation come by turn, nulls first, ties by role and text. A row's first fault counts:
    blank, duplicate (role and text seen earlier), truncated. Null roles and texts read as one
    space; a null conv_id is a conversation; repeated rows are duplicates; an empty table
    gives empty results; other columns do not matter. The audit of a conversation is one cell, and
    its digest is taken by one task, a line at a time; all else is split.
    """
    return Repair(df, **columns)


def report(original, repaired, conv="conv_id"):
    """One row per conversation of ``original``, with the digest of its repaired turns; zeros where no row is left."""
    turns = repaired.turns()
    line = F.concat("role", F.lit(":"), "text")
    digests = stream_digests(turns, "conv_id", ["at", "number"], line, "\n", "repaired_sha256")
    out = original.select(F.col(conv).alias("conv_id")).distinct()
    out = _beside(_beside(out, repaired.conversations()), digests)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return out.select(
        "conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
