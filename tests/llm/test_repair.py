"""Structure repair against exhaustive search over all edits."""

import hashlib
import random
import re
import sys
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from ledgerloom.llm import repair
from ledgerloom.llm.queries import ORACLES, QUERIES
from tests.checker import connect, difference

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def brute_damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        read = [" " if x is None else x for x in (conv, turn, role, text)]
        kind = zlib.crc32(f"{read[0]}:{read[1]}".encode()) % 20
        role, text = read[2:]
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def brute_repair(rows):
    """rows: (turn, role, text) of one conversation, in order. Counts, cost, audit and repaired lines."""
    seen, marks, counts = set(), [], [0, 0, 0]
    for _, role, text in rows:
        ink = text.strip(" \t\n\x0b\x0c\r")
        mark = None
        if not ink:
            mark = 0
        elif (role, text) in seen:
            mark = 1
        elif ink[-1] not in ".!?":
            mark = 2
        seen.add((role, text))
        marks.append(mark)
        if mark is not None:
            counts[mark] += 1
    first = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
    allowed = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}

    @lru_cache(None)
    def best(i, last, fresh):
        """Least (cost, audit, lines) from row i on, when the output ends with ``last``; ``fresh`` insertions in a row so far."""
        ways = []
        if i == len(rows) and last in ("", "a"):
            ways.append((0, "", ()))
        if fresh < 3:
            for role in ("user", "assistant"):
                if (last, role[0]) in allowed:
                    cost, audit, lines = best(i, role[0], fresh + 1)
                    ways.append((cost + 3, "I" + audit, (f"{role}:", *lines)))
        if i < len(rows):
            _, role, text = rows[i]
            cost, audit, lines = best(i + 1, last, 0)
            ways.append((cost + 4, "D" + audit, lines))
            if marks[i] not in (0, 1):
                extra = 3 * (marks[i] == 2)
                for new, letter, paid in ((role, "K", 0), ("user", "R", 3), ("assistant", "R", 3)):
                    if (last, new[:1]) in allowed:
                        cost, audit, lines = best(i + 1, new[:1], 0)
                        ways.append((cost + extra + paid, letter + audit, (f"{new}:{text}", *lines)))
        return min(ways) if ways else (10**9, "", ())

    cost, audit, lines = best(0, "", 0)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def expected(original, rows):
    held = defaultdict(list)
    for conv, *rest in rows:
        held[conv].append(rest)
    out = []
    for conv in {r[0] for r in original}:
        own = sorted(held[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        out.append((conv, *brute_repair(own)))
    return sorted(out, key=repr)


def collected(df):
    names = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def some_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "usher", None])
            text = rng.choice(["Yes.", "No!", "cut off", " \t\n", "", None, "Why? ", "é.", "Yes.", f"own {turn}.", f"own {turn}"])
            rows.append((conv, rng.choice([turn, turn, turn, None, turn + 2]), role, text))
    return rows


@pytest.mark.parametrize("segment", [repair.SEGMENT, 2])
def test_cheapest_repair_of_odd_conversations(spark, monkeypatch, segment):
    monkeypatch.setattr(repair, "SEGMENT", segment)
    rows = some_rows(60, 1) + [(None, 3, "user", "Hm."), (None, 3, "user", "Hm."), (None, None, None, None)]
    rows += [(99, 2**40, "user", "Late."), (99, -5, "assistant", "x" * 100_000)]
    read = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as place", "2 as part", "3 as at").repartition(7)
    got = collected(repair.report(df, repair.repair(df)))
    assert got == expected(rows, read)


def test_damage(spark):
    rows = some_rows(60, 2) + [(None, None, None, None), (None, 4, "user", "Hm.")]
    got = sorted((tuple(r) for r in repair.damaged(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == sorted(brute_damaged(rows), key=repr)


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.report(none, repair.repair(none)).count() == 0
    some = spark.createDataFrame([(1, 1, "user", "Hm.")], SCHEMA)
    gone = hashlib.sha256(b"").hexdigest()
    assert collected(repair.report(some, repair.repair(none))) == [(1, 0, 0, 0, 0, 0, 0, "", gone)]


def test_transitions_of_runs():
    rng = random.Random(4)
    symbols = "".join(repair.symbol(rng.choice("suao"), rng.randrange(3)) * rng.randrange(1, 40) for _ in range(30))
    slow = None
    for sym in symbols:
        slow = repair.power(sym, 0) if slow is None else repair.chained(slow, repair.power(sym, 0))
    assert repair.transition(symbols) == tuple(slow.ravel())
    matrices = [repair.transition(symbols[i : i + 50]) for i in range(0, len(symbols), 50)]
    assert repair.backwards(matrices)[1] == repair.backwards([repair.transition(symbols)])[1]


def test_one_conversation_over_many_segments(spark, monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT", 16)
    sys.setrecursionlimit(max(20_000, sys.getrecursionlimit()))  # of the brute force
    rng = random.Random(9)
    rows = [(7, t, rng.choice(["user", "assistant", "user"]), rng.choice([f"{t}.", f"{t}", "Again."])) for t in range(250)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert collected(repair.report(df, repair.repair(df))) == expected(rows, rows)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = QUERIES["op12_structure_repair"](spark, SF_DIR)
    assert collected(found) == expected(rows, brute_damaged(rows))
    assert difference(found, connect(SF_DIR), ORACLES["op12_structure_repair"]) is None
