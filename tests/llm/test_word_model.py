"""The word model of the classifier against its recursive definition."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import common, kneser_ney
from ledgerloom.sources import staging

TEXTS = [f"the cat sat on the mat {i}, a dog and the cat ran. The {w} sat!" for i, w in enumerate("one two three four five six seven".split())]
ASKED = ["the cat sat on the mat", "mat the on sat cat the", "the the the the the the", "unseen wörds, cat!", ""]


def tokens(text):
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = kneser_ney.split_tokens(data, np.array([0, len(data)]))
    return [data[a:b].tobytes() for a, b in zip(starts, ends)]


def spelled(table, word):
    data = np.frombuffer(word, np.uint8)
    return kneser_ney.spelling(table, data, np.array([0]), np.array([len(data)]))[0]


def losses(texts, asked, table):
    """-log p of each text by the recursive definition."""
    counts = {3: Counter()}
    for t in texts:
        s = ["<s>", "<s>", *tokens(t), "</s>"]
        counts[3].update(tuple(s[i : i + 3]) for i in range(len(s) - 2))
    for k in (2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    off, contexts = {}, {k: {} for k in counts}
    for k, c in counts.items():
        n1, n2, n3, n4 = (sum(v == x for v in c.values()) for x in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        d = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1, 3 - 4 * y * n4 / n3 if n3 else 1.5]
        off[k] = [min(max(x, 0.1), i - 0.1) for i, x in enumerate(d, 1)]
        for g, v in c.items():
            t = contexts[k].setdefault(g[:-1], [0, 0.0])
            t[0] += v
            t[1] += off[k][min(v, 3) - 1]

    def p(g):
        if not g:
            return None
        k = len(g)
        if g[:-1] not in contexts[k]:
            return p(g[1:])
        total, left = contexts[k][g[:-1]]
        v = counts[k].get(g, 0)
        below = p(g[1:]) if k > 1 else math.exp(-spelled(table, g[0])) if g[0] != "</s>" else 1.0
        return (v - off[k][min(v, 3) - 1] if v else 0) / total + left / total * below

    out = []
    for t in asked:
        s = ["<s>", "<s>", *tokens(t), "</s>"]
        out.append(-sum(math.log(p(tuple(s[i : i + 3]))) for i in range(len(s) - 2)))
    return out


def test_losses_are_those_of_the_recursive_definition(spark):
    common.ship(spark)
    docs = spark.createDataFrame([(t,) for t in TEXTS], "text string").withColumn("half", F.lit(0)).repartition(3)
    table = kneser_ney.fit(kneser_ney.text_of_tokens(docs))
    found, weights = kneser_ney.values(kneser_ney.count_words(docs, table))
    asked = [(t, i, 1) for i, t in enumerate(ASKED)]
    rows = spark.createDataFrame(asked, "text string, dig long, half int")  # half 1 is judged by the texts of half 0
    got = {r.dig: r.loss for r in kneser_ney.text_losses(rows, table, found, weights).collect()}
    want = losses(TEXTS, ASKED, table)
    for i, loss in enumerate(want):
        assert got[i] == pytest.approx(loss, rel=1e-4), ASKED[i]
    assert got[1] > got[0] + 3  # the same words in disorder


def test_model_grows_with_trusted_text(spark):
    def grams(n):
        docs = spark.createDataFrame([(" ".join(f"w{i}x{j}" for j in range(40)),) for i in range(n)], "text string")
        docs = docs.withColumn("half", kneser_ney.half())
        table = kneser_ney.fit(kneser_ney.text_of_tokens(docs))
        return kneser_ney.values(kneser_ney.count_words(docs, table))[0].count()

    assert grams(200) > 1.9 * grams(100) > 10_000


def test_quantiles_are_exact(spark):
    import math
    import random

    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "a", None, "b"]), round(rng.random(), 2)) for _ in range(700)] + [("one", 5.0)]
    df = spark.createDataFrame(rows, "lang string, own double").repartition(5)
    placed = kneser_ney.in_order(df, ["lang", "own"]).withColumn("one", kneser_ney.F.lit(1))
    for q in (0.0, 0.5, 0.995, 1.0):
        want = {}
        for lang in {r[0] for r in rows}:
            own = sorted(r[1] for r in rows if r[0] == lang)
            want[lang] = own[max(math.ceil(len(own) * q), 1) - 1], len(own)
        got = {r["lang"]: (r["own"], r["n"]) for r in kneser_ney.quantiles(placed, ["lang"], q).collect()}
        assert got == want


def test_rounds_and_shards_change_no_loss(spark, monkeypatch):
    common.ship(spark)
    docs = spark.createDataFrame([(t,) for t in TEXTS], "text string").withColumn("half", kneser_ney.half()).repartition(3)
    table = kneser_ney.fit(kneser_ney.text_of_tokens(docs))
    asked = [(t, i, half) for i, t in enumerate(ASKED + TEXTS) for half in [i % 2]]
    rows = spark.createDataFrame(asked, "text string, dig long, half int")
    got = []
    for size in (kneser_ney.SHARD_BYTES, 30):
        monkeypatch.setattr(kneser_ney, "SHARD_BYTES", size)
        found, weights = kneser_ney.values(kneser_ney.count_words(docs, table))
        got.append({r.dig: r.loss for r in kneser_ney.text_losses(rows, table, found, weights).collect()})
    assert weights.rounds == kneser_ney.ROUNDS > 1
    assert got[1] == pytest.approx(got[0], rel=1e-6)


def test_training_removes_its_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda spark: str(tmp_path))
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(len(TEXTS))], "doc_id long, quality int, toxic int")
    assert len(kneser_ney.classify(docs, labels).collect()) == len(TEXTS)
    left = {p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()}
    assert left and not left & {"texts", "runs", "vocabulary", "words2", "words1", "seen", "weights", "values", "below", "contexts"}


def test_one_round_of_values_stands_at_a_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda spark: str(tmp_path))
    monkeypatch.setattr(kneser_ney, "SHARD_BYTES", 30)
    monkeypatch.setattr(kneser_ney, "ROUNDS", 2)
    standing = []

    def watched(df, name="stage", **options):
        out = staging.staged(df, name, **options)
        if name == "part-losses":
            standing.append(sum(p.name.startswith("values-") and p.is_dir() and any(p.iterdir()) for p in tmp_path.iterdir()))
        return out

    monkeypatch.setattr(kneser_ney, "staged", watched)
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(len(TEXTS))], "doc_id long, quality int, toxic int")
    kneser_ney.classify(docs, labels)
    assert standing == [1] * 4  # of 2 models and 2 rounds


def test_tokens_of_all_lengths_have_hashes_of_their_own():
    words = [b"a" * n + end for n in range(140) for end in (b"x", b"y")] * 2
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    keys = kneser_ney.hash_tokens(data, ends - [len(w) for w in words], ends)
    half = len(words) // 2
    assert (keys[:half] == keys[half:]).all() and len(set(keys.tolist())) == half


def test_questions_are_read_as_they_were_packed():
    rng = np.random.default_rng(3)
    key = np.unique(rng.integers(0, 2**64, 500, np.uint64))
    n = rng.integers(1, 4, len(key))
    missed, whose = rng.random(len(key)).astype(np.float32), rng.integers(0, 30, n.sum()).astype(np.uint32)
    dig, copies = np.arange(30, dtype=np.int64) * -7, np.arange(30, dtype=np.int64) + 1
    batch = kneser_ney.dealt_questions(5, key, missed, n, whose, dig, copies)
    read = [kneser_ney.questions_in(cell.as_buffer()) for cell in batch.column("payload")]
    assert batch.column("shard").to_pylist() == [0, 1, 2, 3, 4]
    assert (np.concatenate([r[0] for r in read]) == key).all() and (np.concatenate([r[1] for r in read]) == missed).all()
    assert (np.concatenate([r[4][r[3]] for r in read]) == dig[whose]).all() and (np.concatenate([r[5][r[3]] for r in read]) == copies[whose]).all()
