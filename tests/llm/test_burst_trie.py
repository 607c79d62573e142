"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from ledgerloom.llm import burst_trie
from ledgerloom.llm.queries import ORACLES, QUERIES
from tests.checker import connect, difference

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, rebuild):
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            held[conv].append((turn is not None, turn or 0, role.encode(), name, role, text))
    own = {c: [r[4:] for r in sorted(turns)] for c, turns in held.items()}
    convs = own
    if rebuild:
        cut = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
        convs = {c: own.get(c - c % 100, [])[: cut[c]] + own[c][cut[c] :] for c in own}
    members, ends, children = defaultdict(set), defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, own_members in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(own_members) - 1) * len(node[-1][1]) if node else 0
    out = []
    for node, own_members in members.items():
        digest = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        up = min(members[node[:-1]]) if node else None
        out.append((min(own_members), len(node), up, len(own_members), len(children[node]), leaves[node], saved[node], digest))
    return sorted(out, key=repr)


def collected(df):
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def some_rows(seed, n=160):
    rng = random.Random(seed)
    rows = [(None, 1, "user", "of no conversation"), (None, None, None, None)]
    for conv in [*range(n), 300, 305, 1200, 1250]:
        turns = [("user", "Hello."), ("assistant", "Hi!")] * rng.randrange(4)
        turns += [(rng.choice(["user", "assistant", "", None]), rng.choice(["a", "bb", "", None, "é🙂"])) for _ in range(rng.randrange(5))]
        rows += [(conv, rng.choice([t, t, t, None]), *turn) for t, turn in enumerate(turns)]
        rows += [rows[-1]] * (rng.random() < 0.1 and rows[-1][0] == conv)
    return rows


@pytest.mark.parametrize("limit, size", [(1, 1 << 20), (7, 1 << 20), (1000, 200), (1000, 1 << 20)])
def test_trie_of_odd_conversations(spark, limit, size):
    rows = some_rows(limit)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as head", "2 as path", "3 as n").repartition(5)
    convs = burst_trie.rebuilt(burst_trie.paths(df))
    assert collected(burst_trie.trie(convs, limit, size)) == brute(rows, True)


def test_trie_without_rebuilding(spark):
    rows = some_rows(11, 40)
    assert collected(burst_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows, False)


def test_copies_and_long_conversations(spark):
    """Copies are one path whatever their number; conversations that share a long beginning burst once."""
    long = [("user", f"turn {t}") for t in range(300)]
    rows = [(c, t, *turn) for c in range(30) for t, turn in enumerate(long + [("user", f"own {c % 7}")] * (c % 3))]
    df = spark.createDataFrame(rows, SCHEMA)
    assert collected(burst_trie.trie(burst_trie.paths(df), 2)) == brute(rows, False)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert burst_trie.conversation_trie(none, rebuild=True).count() == 0
    assert burst_trie.conversation_trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).count() == 0


def test_query(spark):
    columns = SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select(*columns).collect()]
    found = QUERIES["op13_prefix_trie"](spark, SF_DIR)
    assert collected(found) == brute(rows, True)
    assert difference(found, connect(SF_DIR), ORACLES["op13_prefix_trie"]) is None
