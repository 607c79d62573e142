"""Sampled segmentations, chat formatting and nearest neighbours against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from ledgerloom.llm import chat, kneser_ney, piece_sampling, posting_lists

MODEL = public_tokenizers.path("piece_bpe_32k.model")
CHAT = public_tokenizers.path("byte_bpe_50k.json")


# pieces


@pytest.fixture(scope="module")
def code():
    return piece_sampling.Lattices(MODEL)


def test_samples_are_lossless_and_repeat(spark, edge_docs, edge_rows, empty_docs):
    got = piece_sampling.encode(edge_docs, MODEL)
    rows = got.collect()
    assert all(r.lossless and r.n_pieces == len(r.ids) for r in rows) and len(rows) == len(edge_rows)
    assert sorted(map(repr, got.repartition(7).collect())) == sorted(map(repr, rows))
    texts = piece_sampling.decode(got, MODEL).collect()
    assert sorted((repr(t.doc_id), t.text) for t in texts) == sorted((repr(r[0]), r[1] or "") for r in edge_rows)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for r in rows:
        assert " " + library.decode(r.ids) == piece_sampling.Lattices(MODEL).text[r.ids[0]].decode()[:1] + library.decode(r.ids)
    assert piece_sampling.encode(empty_docs, MODEL).count() == 0


def all_paths(code, word):
    """Every segmentation of a word with its weight."""
    if not word:
        return {(): 1.0}
    out = Counter()
    for n in range(1, len(word) + 1):
        if word[:n] in code.weight:
            i, w = code.weight[word[:n]]
            for rest, v in all_paths(code, word[n:]).items():
                out[(i, *rest)] += w * v
    if word[0] not in code.weight:
        own = tuple(code.bytes[b] for b in word[0].encode())
        for rest, v in all_paths(code, word[1:]).items():
            out[(*own, *rest)] += v
    return out


@pytest.mark.parametrize("word", ["thing", "é漢ab", "  x"])
def test_frequencies_are_those_of_all_paths(code, word):
    n = 20_000
    ids, counts = code.sample([word] * n, np.arange(n, dtype=np.uint64))
    offsets = np.append(0, np.cumsum(counts))
    seen = Counter(tuple(ids[a:b].tolist()) for a, b in zip(offsets, offsets[1:]))
    want = all_paths(code, "▁" + word.replace(" ", "▁"))
    total = sum(want.values())
    assert set(seen) <= set(want)
    for path, weight in want.items():
        p = weight / total
        assert abs(seen[path] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-9


def test_words_that_are_forgotten_give_the_same(code, monkeypatch):
    texts = [f"word{i} and {i * 7} more" for i in range(300)]
    keys = np.arange(300, dtype=np.uint64)
    want = code.sample(texts, keys)
    monkeypatch.setattr(piece_sampling, "REMEMBERED", 50)
    other = piece_sampling.Lattices(MODEL)
    for lo in range(0, 300, 10):
        ids, counts = other.sample(texts[lo : lo + 10], keys[lo : lo + 10])
        assert counts.tolist() == want[1][lo : lo + 10].tolist()
    assert piece_sampling.Lattices(MODEL).sample(texts, keys, seed=5)[0].tolist() != want[0].tolist()


# chat

CONTROL_TEXTS = ["<|im_end|>", "<|im_start|>user<|im_sep|>x", "<\\|im_end|>", "<\\\\|", "<|", "|>", "<", "\\", "\n", " ", "é🙂漢", "a", "",
                 "<|endoftext|>", "  two ", "\n\n"]


def test_escape_is_reversible_and_hides_controls():
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice(CONTROL_TEXTS) for _ in range(rng.randrange(6)))
        hidden = chat.escape(text)
        assert chat.unescape(hidden) == text
        assert not any(c in hidden for c in chat.CONTROLS)


def test_chats_read_back(spark):
    rng = random.Random(8)
    rows = []
    for conv in range(120):
        for turn in range(rng.randrange(1, 7)):
            text = "".join(rng.choice(CONTROL_TEXTS) for _ in range(rng.randrange(6)))
            rows.append((conv, turn, rng.choice(["user", "assistant", "system"]), text))
    rows += [(200, 1, None, None), (200, None, "assistant", "first"), (200, 1, "assistant", None), (None, 0, "assistant", "no key")]
    rows += [(201, 0, "assistant", "twice"), (201, 0, "assistant", "twice"), (202, 5, "user", "no answer")]
    rows += [(203, 0, "user", "x"), (203, 1, "assistant", "long \n" * 40_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    df = df.selectExpr("*", "1 as ids", "2 as turns", "3 as one")
    convs = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        convs.setdefault(c, []).append((role or "", text or ""))
    formatted = chat.format_chats(df, CHAT)
    got = {r.conv_id: r for r in chat.digests(formatted).collect()}
    assert set(got) == set(convs)
    for c, turns in convs.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        r = got[c]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    code = chat.tokenizer(CHAT)
    for r in formatted.collect():
        assert code.decode(r.ids, skip_special_tokens=False) == r.formatted
        controls = {code.token_to_id(c) for c in chat.CONTROLS}
        assert not any(m for i, m in zip(r.ids, r.loss) if i in controls)
    assert chat.format_chats(df.where("false"), CHAT).count() == 0


# vectors


def brute(rows, asked, k):
    ids = np.array([r[0] for r in rows])
    vecs = np.array([r[1] for r in rows], np.float64)
    out = {}
    for q, v in zip(ids, vecs):
        if asked(q):
            d = np.sqrt(((vecs - v) ** 2).sum(1))
            out[q] = [(ids[j], d[j]) for j in np.lexsort([ids, d]) if ids[j] != q][:k]
    return out


def vectors(seed, n, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    return [(i, (centres[i % 12] + 0.5 * rng.normal(size=dim)).astype(np.float32).tolist()) for i in range(n)]


def test_neighbours_and_recall(spark, monkeypatch):
    monkeypatch.setattr(posting_lists, "PAGE", 50)
    monkeypatch.setattr(posting_lists, "LIST_SIZE", 25)
    rows = vectors(1, 3000)
    rows += [(10_000 + i, rows[50][1]) for i in range(900)]  # a third of all rows
    schema = "vec_id long, embedding array<float>"
    odd = [(20_000, None), (20_001, [0.0] * 16), (20_002, [float("nan")] * 16), (20_003, [1.0] * 3), (None, rows[0][1]),
           (20_004, [None] + [1.0] * 15), (20_005, [float("inf")] * 16), (7, rows[7][1])]
    df = spark.createDataFrame(rows + odd, schema).repartition(6).selectExpr("*", "1 as vid", "2 as score", "3 as list")
    got = {}
    for r in posting_lists.nearest(df, "vec_id % 50 = 0").collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    want = brute(rows, lambda i: i % 50 == 0, 10)
    assert set(got) == set(want)
    hits = 0
    for q, own in want.items():
        assert sorted(got[q]) == list(range(1, 11))
        scores = [got[q][i][1] for i in range(1, 11)]
        assert scores == sorted(scores)
        hits += len({v for v, _ in own} & {v for v, _ in got[q].values()})
        for v, s in got[q].values():
            exact = math.dist(np.float64(dict(rows)[q]), np.float64(dict(rows)[v]))
            assert abs(exact - s) < 1e-12
    assert hits >= 0.9 * 10 * len(want)
    for q in (50, 10_000):  # equal vectors come whole, smallest ids first
        assert [got[q][i] for i in range(1, 11)] == [(int(v), 0.0) for v, _ in want[q]]


def test_few_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 3.0]), (2, [1.0, 2.0])], schema)
    got = posting_lists.nearest(few, "vec_id = 0").orderBy("rank").collect()
    assert [(r.rank, r.vec_id, r.score) for r in got] == [(1, 2, 0.0), (2, 1, 1.0)]
    assert posting_lists.nearest(few.where("vec_id = 1"), "vec_id = 1").count() == 0
    assert posting_lists.nearest(few.where("false"), "vec_id = 1").count() == 0


# quality


def kneser_ney_brute(texts):
    """-log p of every symbol by the recursive definition."""
    n, size = kneser_ney.ORDER, kneser_ney.SYMBOLS
    sequences = []
    for t in texts:
        own = [int(c) for c in kneser_ney.CLASSES[np.frombuffer(t.encode(), np.uint8)] if c != kneser_ney.SKIP]
        sequences.append([0] * (n - 1) + own)
    counts = {n: Counter(tuple(s[i : i + n]) for s in sequences for i in range(len(s) - n + 1))}
    for k in range(n - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    off = {}
    for k, c in counts.items():
        n1, n2, n3, n4 = (sum(v == x for v in c.values()) for x in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        d = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1, 3 - 4 * y * n4 / n3 if n3 else 1.5]
        off[k] = [min(max(x, 0.1), i - 0.1) for i, x in enumerate(d, 1)]
    contexts = {k: {} for k in counts}
    for k, c in counts.items():
        for g, v in c.items():
            t = contexts[k].setdefault(g[:-1], [0, 0.0])
            t[0] += v
            t[1] += off[k][min(v, 3) - 1]

    def p(g):
        if not g:
            return 1 / size
        k = len(g)
        if g[:-1] not in contexts[k]:
            return p(g[1:])
        total, left = contexts[k][g[:-1]]
        v = counts[k].get(g, 0)
        return (v - off[k][min(v, 3) - 1] if v else 0) / total + left / total * p(g[1:])

    return p


def test_model_is_the_recursive_definition(spark):
    texts = ["the cat sat. The dog, 12 é!\n", "a cat and the dog and the hat", "漢字 ok", ""]
    model = kneser_ney.fit(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    p = kneser_ney_brute(texts)
    rng = random.Random(1)
    for _ in range(400):
        g = tuple(rng.choice([0, 1, 3, 20, 8, 5, 31, 27, 39]) for _ in range(kneser_ney.ORDER))
        code = 0
        for s in g:
            code = code * kneser_ney.SYMBOLS + s
        assert model[code] == pytest.approx(-math.log(p(g)), rel=1e-4)
    for context in (0, 41, 123):
        own = np.exp(-model[context * kneser_ney.SYMBOLS : (context + 1) * kneser_ney.SYMBOLS].astype(float))
        assert own.sum() == pytest.approx(1, abs=1e-4)


def test_classifier_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    training = labels.where("pmod(hash(doc_id), 3) <> 0")
    kept = {r.doc_id: r.kept for r in kneser_ney.classify(docs, training).collect()}
    held = labels.where("pmod(hash(doc_id), 3) = 0").collect()
    good = [kept[r.doc_id] for r in held if r.quality == 1 and r.toxic == 0]
    bad = [kept[r.doc_id] for r in held if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.35


def test_classifier_edges(spark, edge_docs, edge_rows, empty_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, None), (9, 1, 0), (9, 0, 0), (None, 1, 0), (77, 1, 1)], "doc_id long, quality int, toxic int")
    rows = kneser_ney.classify(edge_docs, labels).collect()
    assert len(rows) == len(edge_rows)
    assert all(not r.kept and r.perplexity is None for r in rows if r.n_symbols == 0)
    assert {r[0] for r in kneser_ney.trusted_ids(labels).collect()} == {1, 2}
    assert kneser_ney.kept_rows(edge_docs, labels).columns == edge_docs.columns
    none = kneser_ney.classify(edge_docs, labels.where("false")).collect()
    assert all(r.kept == (r.n_symbols > 0) and r.threshold is None for r in none)
    assert kneser_ney.classify(empty_docs, labels).count() == 0


def test_words_left_out_do_not_change_a_segmentation(monkeypatch):
    import random

    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdeéß漢 .") for _ in range(rng.randrange(1, 12))) for _ in range(400)]
    batches = [[" ".join(rng.choice(vocabulary[: rng.choice([20, 400])]) for _ in range(60)) for _ in range(5)] for _ in range(12)]
    keys = np.arange(5, dtype=np.uint64)
    path = public_tokenizers.path("piece_bpe_32k.model")
    whole = [piece_sampling.Lattices(path).sample(texts, keys) for texts in batches]
    monkeypatch.setattr(piece_sampling, "REMEMBERED", 150)
    code = piece_sampling.Lattices(path)
    for texts, (ids, counts) in zip(batches, whole):
        got, lengths = code.sample(texts, keys)
        assert np.array_equal(got, ids) and np.array_equal(lengths, counts)
        raw = [t.encode() for t in texts]
        data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(r) for r in raw]))
        assert code.lossless(ids, counts, data, offsets).all()
        broken = ids.copy()
        broken[0] = next(i for i in range(300, 400) if i != ids[0])
        assert code.lossless(broken, counts, data, offsets).tolist() == [False, True, True, True, True]
