"""Operators on documents against plain restatements of their contracts."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm import (
    components, elias_fano, exact_dedup, fm_index, packing, repeats, simhash, substring, suffix_dedup, suffixes,
    token_files, tokens,
)
from ledgerloom.sources.staging import new_location

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# exact dedup


def exact_expected(rows):
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r[1] or ""), []).append(i)
    out = []
    for norm, members in groups.items():
        best = min(members, key=lambda i: (-len(rows[i][1] or ""), rows[i][0] is None, rows[i][0] or 0, i))
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(rows[i][0], rows[best][0], len(members), i == best, sha) for i in members]
    return sorted(out, key=repr)


def weak(column):
    return F.length(column).cast("long") % 3


@pytest.mark.parametrize("fingerprint", [F.xxhash64, weak])
def test_exact_groups(edge_docs, edge_rows, fingerprint):
    got = exact_dedup.exact_groups(edge_docs, fingerprint=fingerprint)
    assert collected(got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")) == exact_expected(edge_rows)


def test_exact_kept_rows(edge_docs, edge_rows, empty_docs):
    kept = exact_dedup.kept_rows(edge_docs)
    assert kept.columns == edge_docs.columns
    want = sorted([r[0] for r in exact_expected(edge_rows) if r[3]], key=repr)
    assert sorted([r[0] for r in kept.select("doc_id").collect()], key=repr) == want
    assert exact_dedup.kept_rows(empty_docs).count() == 0


# tokens


def test_ids_are_those_of_whole_texts(tokenizer, edge_rows):
    import pyarrow as pa

    rng = random.Random(5)
    pieces = ["The", "the", "don't", "'s", "a.", "b,", ",", ".", "..", "x.,", "é", "é", "12", "3a", "Ab", " ", "ß",
              "<|endoftext|>", "<|startoftext|>x", "漢", "Σ", "İ", "́", "🙂", "L'", "we'll.", "ÀÖ,"]
    texts = [r[1] or "" for r in edge_rows]
    texts += ["".join(rng.choice(pieces) + rng.choice(["", " ", "\n", "  "]) for _ in range(30)) for _ in range(200)]
    code = tokens.Encoder(TOKENIZER)
    assert code.apart
    for part in (texts, texts[::-1]):
        ids, counts = code.encode(pa.array(part))
        want = [e.ids for e in tokenizer.encode_batch(part, add_special_tokens=False)]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == sum(want, [])
    code.apart = False
    ids, counts = code.encode(pa.array(texts))
    assert ids.tolist() == sum((e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)), [])


def test_elias_fano():
    rng = np.random.default_rng(3)
    for n, top in [(0, 0), (1, 0), (1, 9), (5, 0), (300, 5), (1000, 10**6), (4000, 2**40), (70000, 10**7)]:
        values = np.sort(rng.integers(0, top + 1, n))
        again = elias_fano.EliasFano.from_bytes(elias_fano.EliasFano.of(values).to_bytes())
        assert again.select(np.arange(n)).tolist() == values.tolist()
    size = len(elias_fano.EliasFano.of(values).to_bytes())
    assert size < len(values) * (3 + np.log2(10**7 / 70000)) / 8 + 64


def test_token_files(spark, edge_docs, edge_rows, empty_docs, tokenizer, monkeypatch):
    for shards, block in ((1, 2_000_000), (4, 7)):
        monkeypatch.setattr(token_files, "BLOCK_IDS", block)
        path = new_location(spark, "test")
        token_files.write_token_files(edge_docs, path, TOKENIZER, end=1, shards=shards)
        got = token_files.read_token_files(spark, path).orderBy("start").collect()
        rows = sorted(edge_rows, key=lambda r: (r[0] is not None, r[0] or 0))
        assert [r.doc_id for r in got] == [r[0] for r in rows]
        start = 0
        for r, g in zip(rows, got):
            ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1]
            assert np.frombuffer(g.ids, "<u4").tolist() == ids
            assert (g.start, g.n_tokens, g.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
            start += len(ids)
    path = new_location(spark, "test")
    token_files.write_token_files(empty_docs, path, TOKENIZER)
    assert token_files.read_token_files(spark, path).count() == 0


def test_packing(edge_docs, edge_rows, empty_docs, tokenizer):
    pieces = packing.pack(edge_docs, TOKENIZER, 0, with_ids=True)
    got = pieces.collect()
    want = Counter()
    for r in edge_rows:
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            want[r[0], k // 2048, k, tuple(ids[k : k + 2048])] += 1
    assert Counter((g.doc_id, g.piece, g.start, tuple(np.frombuffer(g.ids, "<u4").tolist())) for g in got) == want
    bins = {}
    for g in got:
        assert g.length * 4 == len(g.ids) and g.ids_crc32 == zlib.crc32(g.ids)
        bins.setdefault(g.sequence_id, []).append((g.offset, g.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.sequences(pieces).count() == len(bins)
    assert packing.pack(empty_docs, TOKENIZER, 0).count() == 0


def test_packer_is_bounded_and_takes_the_best_fit():
    rng = random.Random(2)
    packer, free, opened = packing.Packer(100, 5), {}, 0
    for _ in range(5000):
        size = rng.choice([1, 7, 30, 55, 100, 99])
        fits = {b: f for b, f in free.items() if f >= size}
        which, offset = packer.place(size)
        if fits:
            assert free[which] == min(fits.values())
        else:
            assert which not in free
            if len(free) == 5:
                least = min(free.values())
                del free[next(b for b, f in free.items() if f == least and b not in dict(packer.left_over()))]
            free[which] = 100
            opened += 1
        assert offset == 100 - free[which]
        free[which] -= size
        if not free[which]:
            del free[which]
        assert sorted(packer.left_over()) == sorted((b, 100 - f) for b, f in free.items())
        assert packer.n_open == len(free) <= 5


def test_left_over_bins_are_packed_again(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "repeat('cat ', cast(pmod(hash(id), 900) as int)) as text").repartition(16)
    got = packing.pack(docs, TOKENIZER, 0).agg(F.sum("length"), F.countDistinct("sequence_id")).first()
    assert got[1] <= 1.01 * got[0] / 2048 + 1


# repeats


def brute_windows(texts, size):
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for w in words:
        hit = [False] * len(w)
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                hit[i : i + size] = [True] * size
        out.append((w, hit))
    return out


def salad(seed, n=120):
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(40)]
    docs = []
    for _ in range(n):
        w = [rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(rng.randrange(0, 60))]
        if rng.random() < 0.5:
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage[rng.randrange(5) : 40 - rng.randrange(5)]
        docs.append(rng.choice([" ", "\n", "  "]).join(w))
        if rng.random() < 0.2:
            docs.append(docs[-1])
    return docs


@pytest.mark.parametrize("hot", [2, 512])
@pytest.mark.parametrize("engine", [fm_index.repeated_in_shard, suffixes.repeated_in_shard])
def test_repeated_windows_are_those_of_brute_force(spark, edge_rows, engine, hot, monkeypatch):
    monkeypatch.setattr(repeats, "SHARD_WORDS", 300)
    monkeypatch.setattr(repeats, "HOT_RUNS", hot)
    monkeypatch.setattr(repeats.repeated_windows, "__defaults__", (hot,))
    rows = [(r[0], r[1]) for r in edge_rows] + [(100 + i, t) for i, t in enumerate(salad(7))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = substring.digests(substring.remove_repeats(df, size=9, gram=4, engine=engine))
    want = []
    for (key, _), (w, hit) in zip(rows, brute_windows([t for _, t in rows], 9)):
        kept = " ".join(x for x, h in zip(w, hit) if not h)
        want.append((key, len(w), sum(hit), hashlib.sha256(kept.encode()).hexdigest()))
    assert collected(got) == sorted(want, key=repr)


def test_repeated_passages(spark, edge_docs, empty_docs):
    rows = [(i, t) for i, t in enumerate(salad(11))]
    got = suffix_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), size=12, gram=5)
    want = set()
    for (key, text), (w, hit) in zip(rows, brute_windows([t for _, t in rows], 12)):
        marks = "".join("x" if h else "." for h in hit)
        want |= {(key, m.start(), m.end()) for m in re.finditer("x+", marks)}
    found = got.collect()
    assert {(r.doc_id, r.first_word, r.end_word) for r in found} == want and len(found) == len(want)
    texts = dict(rows)
    for r in found:
        assert texts[r.doc_id].encode()[r.start_byte : r.end_byte].decode() == r.passage
        assert len(WORD.findall(r.passage)) == r.n_words
    assert {r.doc_id for r in suffix_dedup.repeated_passages(edge_docs).collect()} == {6, 7}
    assert suffix_dedup.repeated_passages(empty_docs).count() == 0
    assert substring.remove_repeats(empty_docs).count() == 0


# SimHash


def print_of(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORD.findall(text)
    parts = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def near_expected(keys, prints):
    distinct = sorted(set(prints))
    root = {p: p for p in distinct}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for k, p in zip(keys, prints):
        if k is not None:
            least[find(p)] = min(k, least.get(find(p), k))
    return [least.get(find(p)) for p in prints]


def test_near_groups(spark, edge_docs, edge_rows, empty_docs):
    prints = [print_of(r[1]) for r in edge_rows]
    want = near_expected([r[0] for r in edge_rows], prints)
    got = simhash.near_groups(edge_docs).selectExpr("doc_id", "hex(fp)", "component_id")
    assert collected(got) == sorted(((r[0], f"{p:X}", c) for r, p, c in zip(edge_rows, prints, want)), key=repr)
    assert simhash.near_groups(empty_docs).count() == 0
    assert simhash.kept_rows(edge_docs).columns == edge_docs.columns


@pytest.mark.parametrize("node", [4, 2048])
def test_links_keep_all_components(spark, node):
    rng = random.Random(4)
    prints = [rng.getrandbits(64) for _ in range(150)]
    for _ in range(350):
        p = rng.choice(prints)
        for _ in range(rng.randrange(1, 5)):
            p ^= 1 << rng.randrange(64)
        prints.append(p)
    prints = sorted(set(prints))
    df = spark.createDataFrame([(simhash.signed(p),) for p in prints], "fp long")
    edges = simhash.links(df, node)
    for e in edges.collect():
        assert e.a != e.b
    label = {r.node: r.root for r in components.components(edges).collect()}
    want = near_expected(list(range(len(prints))), prints)
    sets = {}
    for p, c in zip(prints, want):
        sets.setdefault(c, set()).add(simhash.signed(p))
    got = {}
    for p in prints:
        got.setdefault(label.get(simhash.signed(p), simhash.signed(p)), set()).add(simhash.signed(p))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, sets.values()))


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(1000, 1200)]
    star = [(5, i) for i in range(10, 500)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(path + star, "a long, b long")).collect()}
    assert {got[n] for n in range(1000, 1201)} == {1000} and {got[n] for n in [5, *range(10, 500)]} == {5}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
