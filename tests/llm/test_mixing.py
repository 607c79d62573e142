"""The mix of sources against a plain restatement, and its schedule against its promises."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

from ledgerloom.llm import mixing
from ledgerloom.llm.queries import ORACLES, QUERIES
from tests.checker import connect, difference

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water(sizes, weights=(1, 2, 3), most=3):
    """Targets by sharing again and again, in exact fractions."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, held = dict.fromkeys(order, Fraction(0)), set()
    left = Fraction(sum(sizes.values()))
    while left and len(held) < len(order):
        share = left / sum(weight[s] for s in order if s not in held)
        left = Fraction(0)
        for s in order:
            if s not in held:
                target[s] += share * weight[s]
                if target[s] >= most * sizes[s]:
                    left += target[s] - most * sizes[s]
                    target[s] = Fraction(most * sizes[s])
                    held.add(s)
    return target


def expected(rows):
    size = [len(WORD.findall(r[1] or "")) for r in rows]
    sizes = defaultdict(int)
    for r, n in zip(rows, size):
        sizes[r[3]] += n
    target = water(sizes)
    out = []
    for source in sizes:
        own = [i for i, r in enumerate(rows) if r[3] == source]
        own.sort(key=lambda i: (hashlib.md5(f"42:{'' if rows[i][0] is None else rows[i][0]}".encode()).hexdigest(), size[i]))
        take, place = int(target[source] + Fraction(1, 2)), 0
        stream = [i for i in own for _ in range(size[i])]
        got = Counter(stream[p % len(stream)] for p in range(take)) if stream else Counter()
        out += [(rows[i][0], size[i], sizes[source], float(target[source]), got[i]) for i in own]
    return sorted(out, key=repr)


def collected(df):
    return sorted((tuple(r) for r in df.select("doc_id", "size", "source_size", "target", "taken").collect()), key=repr)


def rounded(rows):
    return [(*r[:3], round(r[3], 6), r[4]) for r in rows]


def some_rows(seed=7):
    rng = random.Random(seed)
    names = ["b", "a", None, "ä", "z", "", "B", "hot", "tiny", "none"]
    rows = []
    for i in range(400):
        source = "hot" if rng.random() < 0.4 else rng.choice(names)
        n = 0 if source == "none" else 1 if source == "tiny" else rng.choice([0, 1, 5, 40, 300])
        rows.append((i, " ".join(f"w{rng.randrange(99)}" for _ in range(n)), "en", source, n))
    return rows


def test_targets_and_taken_words(spark):
    rows = some_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    assert rounded(collected(mixing.taken(mixing.mix(docs, block=64)))) == rounded(expected(rows))


def test_odd_rows_and_empty_tables(edge_docs, edge_rows, empty_docs):
    assert rounded(collected(mixing.taken(mixing.mix(edge_docs)))) == rounded(expected(edge_rows))
    assert mixing.taken(mixing.mix(empty_docs)).count() == 0
    blank = edge_docs.where("doc_id in (3, 4, 5)")
    assert [(r.target, r.taken) for r in mixing.taken(mixing.mix(blank)).collect()] == [(0, 0)] * 3


def test_schedule_is_whole_and_even(spark):
    rows = some_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    block = 32
    mixed = mixing.mix(docs, block=block).where("words > 0").collect()
    slots = defaultdict(list)
    for r in mixed:
        slots[r.slot].append(r)
    short = Counter()
    for parts in slots.values():
        parts.sort(key=lambda r: r.offset)
        ends = [0]
        for r in parts:
            assert r.offset == ends[-1] and 0 <= r.first and r.first + r.words <= r.size
            ends.append(r.offset + r.words)
        assert len({r.source for r in parts}) == 1 and ends[-1] <= block
        short[parts[0].source] += ends[-1] < block
    assert max(short.values()) <= 1  # only a source's last block is cut
    order = [slots[s][0].source for s in sorted(slots)]
    whole = Counter(order)
    for n in range(0, len(order), 10):
        seen = Counter(order[:n])
        for source, k in whole.items():
            assert abs(seen[source] - n * k / len(order)) < 8
    again = mixing.mix(docs.repartition(3), block=block).where("words > 0").collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, mixed))


def test_texts_of_blocks(spark):
    rows = some_rows(3)[:60]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    mixed = mixing.mix(docs, block=50)
    texts = {r[0]: r[1].split(" ") for r in mixing.block_texts(docs, mixed).collect()}
    words = {r[0]: r[1].split() for r in rows}
    for r in mixed.where("words > 0").collect():
        assert texts[r.slot][r.offset : r.offset + r.words] == words[r.doc_id][r.first : r.first + r.words]


def test_query_equals_sql(spark):
    assert difference(QUERIES["op11_source_mix"](spark, SF_DIR), connect(SF_DIR), ORACLES["op11_source_mix"]) is None
