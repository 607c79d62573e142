"""The near-dedup stage against brute force over all pairs."""

import random

import pytest

import corpus_pipeline
from ledgerloom.llm import shingle_sets, simhash


def brute_kept(rows):
    def shingles(text):
        w = text.lower().split()
        return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    pairs = 0
    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                pairs += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {rows[find(i)][0] for i in range(len(rows))}, pairs


def test_near_stage_drops_all_that_brute_force_drops(spark):
    rng = random.Random(5)
    rows = []
    for family in range(12):
        words = [f"w{family}x{rng.randrange(300)}" for _ in range(120)]
        for _ in range(8 if family else 60):  # one large group of near copies
            own = list(words)
            for k in rng.sample(range(120), rng.randrange(5)):
                own[k] = f"z{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(own) + " under the usual licence of all these texts"))
    rng.shuffle(rows)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    want, pairs = brute_kept(rows)
    assert pairs > 200 and len(want) < len(rows) // 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    near = dict(corpus_pipeline.STAGES)["near_dedup"]
    assert {r.doc_id for r in near(spark, docs, None).collect()} == want


def sentence(seed, n=60):
    rng = random.Random(seed)
    return " ".join(f"w{seed}x{rng.randrange(400)}" for _ in range(n))


X, Y, Z = sentence(1), sentence(2), sentence(3)
ODD = {
    "a null key goes without other rows of null keys": ([(1, X), (None, X), (None, Y)], [(None, Y), (1, X)]),
    "a repeated key goes by row": ([(1, X), (2, X), (2, Y)], [(1, X), (2, Y)]),
    "of groups of null keys one row stays": ([(None, X), (None, X), (None, Y), (None, Y)], [(None, X), (None, Y)]),
    "equal rows leave one": ([(5, X), (5, X), (5, X), (6, Z)], [(5, X), (6, Z)]),
    "a key in two groups": ([(3, X), (3, Y), (4, Y), (2, X)], [(2, X), (3, Y)]),
    "null and empty texts are equal": ([(7, None), (8, ""), (9, " \t"), (None, None)], [(7, None)]),
    "no rows": ([], []),
}


@pytest.mark.parametrize("case", list(ODD))
@pytest.mark.parametrize("way", [shingle_sets.kept_rows, simhash.kept_rows])
def test_rows_go_one_by_one(spark, case, way):
    rows, want = ODD[case]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as sig", "2 as id", "3 as row", "4 as n")
    got = way(df.repartition(3))
    assert got.columns == df.columns
    assert sorted(map(repr, got.select("doc_id", "text").toLocalIterator())) == sorted(map(repr, spark.createDataFrame(want, "doc_id long, text string").collect()))


@pytest.mark.parametrize("own", [14, 18, 24, "mixed"])
def test_pages_of_one_template_make_few_candidates(spark, monkeypatch, own):
    """Candidates grow with the number of pages, not with its square, whether pages are near or not."""
    measured = []
    near = shingle_sets._near
    monkeypatch.setattr(shingle_sets, "_near", lambda pairs, of, least: measured.append(pairs.count()) or near(pairs, of, least))
    rng = random.Random(6)
    template = sentence(9, 100)
    for n in (100, 400):
        rows = [(i, template + " " + " ".join(f"o{i}x{k}" for k in range(rng.randrange(40) if own == "mixed" else own))) for i in range(n)]
        want, _ = brute_kept(rows)
        measured.clear()
        df = spark.createDataFrame(rows, "doc_id long, text string")
        assert {r.doc_id for r in shingle_sets.kept_rows(df).collect()} == want
        assert sum(measured) <= 4 * n


def test_near_stage_goes_through_the_simhash_index(spark, monkeypatch):
    """Near copies whose fingerprints are within 3 bits are found by the index and confirmed by their sets; the rest is not lost."""
    asked, known = [], []
    links, near_links = simhash.links, shingle_sets.near_links
    monkeypatch.setattr(simhash, "links", lambda prints, *more: asked.append(prints.count()) or links(prints, *more))

    def kept(sets, least, found):
        known.extend(map(tuple, found.collect()))
        return near_links(sets, least, found)

    monkeypatch.setattr(shingle_sets, "near_links", kept)
    rows = []
    for family in range(6):
        words = sentence(100 + family, 400).split()
        for copy in range(3):
            rows.append((len(rows), " ".join([*words[:-1], f"end{copy}"])))  # near by fingerprint
        rows.append((len(rows), " ".join([*words, *[f"more{family}x{k}" for k in range(80)]])))  # near by shingles
    want, _ = brute_kept(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, df, None).collect()} == want
    assert asked and asked[0] >= 12 and len(known) >= 12
