"""Quality classifier (2): perplexity under an interpolated modified Kneser-Ney model of trusted text.

1. The n-grams are of ``WORDS`` words or runs of signs, all that trusted text has, counted in shards by
   context, then by their shorter n-gram. Discounts, continuation counts and back-off weights come from those
   shards and stay tables; nothing of them is gathered. N-grams travel as ``cells``, in rounds by their middle word, and what
   a round has shuffled and staged goes when it ends, so that the disk holds a part of them at a time.
2. A word's probability rests on that of its spelling, so unknown words have one too. Spellings are of
   ``SYMBOLS`` character classes and ``ORDER`` symbols: at most SYMBOLS ** ORDER numbers however much
   text there is, the proven bound for which that table alone may be broadcast.
3. The log-probability of a text is a sum over its n-grams of all orders (``values``), so each
   distinct n-gram of a text meets the table once, with its count, and sums are taken by text.
4. There are two models, each of the trusted texts of one half by a hash of the text, and a text is judged by
   that of the other half. So no text is judged by a model that has seen it, and the
   quantiles of trusted texts are those of unseen text.
"""

import math
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm import cells, common
from ledgerloom.llm.common import staged
from ledgerloom.operators.batch import in_order, running_sum
from ledgerloom.operators.joins import small_side
from ledgerloom.sources.staging import shuffles_removed, unstage

SYMBOLS, ORDER = 40, 4
START, UPPER, ACCENTED, OTHER, DIGIT, SPACE, LINE = 0, 27, 28, 29, 30, 31, 32
SKIP = 255
#: A document's mean is drawn to that of its language as if it had so many more symbols.
PRIOR = 40
#: The share of a language's trusted documents, each judged as unseen, below its threshold, and the factor on top.
QUANTILE, MARGIN = 0.995, 1.25
#: Length of the longest word n-grams, the models, and words that stand before and after a text.
WORDS, MODELS = 3, 2
BEFORE, AFTER = np.uint64(1), np.uint64(2)
STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of text of a slice, of what is split at once, and of a round and shard at least; the least number of shards, rounds at most.
SLICE_BYTES, PART_BYTES, SHARD_BYTES, LEAST_SHARDS, ROUNDS = 4 << 20, 1 << 18, 16 << 20, 8, 8
#: Bytes from which a word is hashed byte by byte.
LONG = 64
#: Columns of cells: n-grams of text; 2-grams; those with their discounted part and weight; a key with a number or two.
RUN, PAIR, HEADED, SEEN = ["u8", "u8", "u8", "u4"], ["u8", "u8"], ["u8", "u8", "f4", "f4"], ["u8", "u8", "f4", "f4"]
NUMBER, BELOW, BELOW2 = ["u8", "u4"], ["u8", "f4"], ["u8", "f4", "f4"]
SPELLED, WORD = ["u8", "f8"], ["u8", "u4", "f8"]
#: Languages with fewer trusted documents take the threshold of all.
LEAST_TRUSTED = 50


def _classes():
    c = np.full(256, 39, np.uint8)
    c[ord("a") : ord("z") + 1] = np.arange(1, 27)
    c[ord("A") : ord("Z") + 1] = UPPER
    c[ord("0") : ord("9") + 1] = DIGIT
    for chars, n in ((" \t", SPACE), ("\n\r\x0b\x0c", LINE), (".", 33), (",", 34), ("!?;:", 35), ("'\"-`", 36),
                     ("()[]{}<>", 37), ("$%&#*@|^~\\/_=+", 38)):
        for x in chars:
            c[ord(x)] = n
    c[0x80:0xC0] = SKIP  # later bytes of a character
    c[0xC0:0xC6] = ACCENTED
    c[0xC6:] = OTHER
    return c


CLASSES = _classes()


def grams(data, offsets):
    """The code of the ``ORDER`` symbols that end at each symbol, and the first code of each text (one more at the end).

    Before a text stand ORDER - 1 start symbols.
    """
    symbols = CLASSES[data]
    own = symbols != SKIP
    counts = np.append(0, np.cumsum(own))[offsets]
    size = np.diff(counts)
    lead = ORDER - 1
    padded = np.zeros(counts[-1] + lead * len(size), np.int32)
    place = np.arange(counts[-1]) + np.repeat(np.arange(1, len(size) + 1) * lead, size)
    padded[place] = symbols[own]
    code = np.zeros(len(place), np.int32)
    for back in range(lead, -1, -1):
        code = code * SYMBOLS + padded[place - back]
    return code, counts


def _kinds():
    """Of each byte: 0 white space, 1 part of a word, 2 any other sign."""
    k = np.full(256, 2, np.uint8)
    k[common.WHITE] = 0
    for lo, hi in (("0", "9"), ("A", "Z"), ("a", "z")):
        k[ord(lo) : ord(hi) + 1] = 1
    k[0x80:] = 1
    return k


KINDS = _kinds()
#: What is lost on a byte once its class is known, all bytes of a class being alike.
WITHIN = np.log(np.bincount(CLASSES)[CLASSES])


def split_tokens(data, offsets):
    """Start and end byte of each word or run of signs, and the index of each text's first one (one more at the end)."""
    kind = np.frombuffer(data.tobytes().translate(KINDS.tobytes()), np.uint8)
    edge = np.ones(len(data) + 1, bool)
    np.not_equal(kind[1:], kind[:-1], out=edge[1:-1])
    edge[offsets] = True
    own = kind > 0
    starts, ends = np.flatnonzero(edge[:-1] & own), np.flatnonzero(edge[1:] & own) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def apart(data, starts, ends):
    """The tokens as texts of their own, each with a blank at its end."""
    size = ends - starts
    offsets = np.append(0, np.cumsum(size + 1))
    joined = np.full(offsets[-1], 32, np.uint8)
    within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    joined[np.repeat(offsets[:-1], size) + within] = data[np.repeat(starts, size) + within]
    return joined, offsets


def spelling(table, data, starts, ends):
    """-log p of each token's bytes and its end."""
    joined, offsets = apart(data, starts, ends)
    code, counts = grams(joined, offsets)
    by_class = np.append(0, np.cumsum(table[code], dtype=np.float64))
    by_byte = np.append(0, np.cumsum(np.where(joined == 32, 0, WITHIN[joined])))
    return np.diff(by_class[counts]) + np.diff(by_byte[offsets])


MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def hash_tokens(data, starts, ends):
    """A 64-bit hash of each token, from eight bytes at a time; that of a long one is of its bytes."""
    size = ends - starts
    eight = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    out = common.mix((eight[starts] & MASKS[np.minimum(size, 8)]) ^ size.astype(np.uint64) * STEP)
    more, k = np.flatnonzero(size > 8), 8
    while len(more) and k < LONG:
        out[more] = longer(out[more], eight[starts[more] + k] & MASKS[np.minimum(size[more] - k, 8)])
        k += 8
        more = more[size[more] > k]
    if len(more):
        out[more] = common.hash_words(data, starts[more], ends[more])
    return out


class Words(NamedTuple):
    """Texts with WORDS - 1 words before each and one after it: text and key of each word, whether it is not a text's first
    one, and not one of its first two, the number of its token, -1 before and after a text, and where tokens start and end.
    """

    doc: np.ndarray
    key: np.ndarray
    inner: np.ndarray
    full: np.ndarray
    token: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def pair(self, at):
        """The keys of the 2-grams that end at ``at``."""
        return longer(self.key[at - 1], self.key[at])

    def after(self, own):
        """Whether the word before is one of ``own``."""
        return np.append(False, own[:-1])


def words_of(data, offsets, model):
    """The ``Words`` of texts, each with the number of its model."""
    starts, ends, first = split_tokens(data, offsets)
    number = np.diff(first)
    size = number + WORDS
    head = np.cumsum(size) - size
    doc = np.repeat(np.arange(len(number)), size)
    padded, token = np.full(len(doc), BEFORE), np.full(len(doc), -1)
    place = np.arange(len(starts)) + np.repeat(head - first[:-1] + WORDS - 1, number)
    padded[place], token[place] = hash_tokens(data, starts, ends), np.arange(len(starts))
    padded[head + size - 1] = AFTER
    inner = np.ones(len(doc), bool)
    inner[head] = False
    full = inner.copy()
    full[head + 1] = False
    return Words(doc, common.mix(padded * STEP + np.repeat(model.astype(np.uint64) + np.uint64(1), size)), inner, full, token, starts, ends)


def parts_of(data, offsets, model):
    """Texts a part at a time, so that arrays stay small: the first text, the first byte and the ``Words`` of each."""
    for lo, hi in common.spans(offsets, PART_BYTES):
        yield lo, offsets[lo], words_of(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], model[lo:hi])


def round_of(key, rounds):
    """The round of a word, from bits that do not choose its shard."""
    return ((key & np.uint64(0xFFFFFFFF)) * np.uint64(rounds)) >> np.uint64(32)


def longer(gram, word):
    """The key of an n-gram with one word more."""
    return common.mix(gram * STEP + word)


def spelled(table, data, starts, ends):
    """-log p of the spellings of tokens, zero for those that stand before and after a text, which are empty here."""
    loss = np.zeros(len(starts))
    own = ends > starts
    loss[own] = spelling(table, data, starts[own], ends[own])
    return loss


def shares(docs):
    """How many shards and rounds the texts are dealt to: neither changes a result, both bound what is held at a time."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rounds = int(min(ROUNDS, 1 + size // SHARD_BYTES))
    return max(LEAST_SHARDS, math.ceil(2 * size / SHARD_BYTES / rounds)), rounds


def distinct(key):
    """An order of ``key`` and where each distinct one begins in it."""
    order = np.argsort(key)
    own = key[order]
    new = np.ones(len(own), bool)
    new[1:] = own[1:] != own[:-1]
    return order, np.flatnonzero(new)


def sums(values, begins):
    return np.add.reduceat(values, begins) if len(begins) else np.zeros(0, values.dtype)


def runs(texts, model, share, r):
    """Cells of the n-grams of WORDS words whose middle word is of round ``r``, (context, middle, word, n), dealt by context."""
    shards, rounds = share

    def emit(batches):
        for batch in common.slices(batches, limit=SLICE_BYTES):
            found = []
            for _, _, w in parts_of(*common.text_buffers(batch.column("text")), np.full(batch.num_rows, model)):
                at = np.flatnonzero(w.full & w.after(round_of(w.key, rounds) == r))
                found.append([w.pair(at - 1), w.key[at - 1], w.key[at]])
            context, middle, word = (np.concatenate(c) for c in zip(*found))
            order, begins = distinct(longer(context, word))
            at, n = order[begins], np.diff(np.append(begins, len(order))).astype(np.uint32)
            yield cells.deal(shards, context[at], [context[at], middle[at], word[at], n])

    return texts.where(F.col("half") == model).select("text").mapInArrow(emit, cells.SCHEMA)


def counted(payload):
    """Distinct n-grams of a shard with their counts, sorted by context, and where each context begins."""
    context, middle, word, n = cells.together(payload, RUN)
    order, begins = distinct(longer(context, word))
    n, at = sums(n[order].astype(np.int64), begins), order[begins]
    context, middle, word = context[at], middle[at], word[at]
    order, begins = distinct(context)
    return context[order], middle[order], word[order], n[order], begins


def how_many(n):
    """How many of the counts are 1, 2, 3 and 4."""
    return [int((n == k).sum()) for k in (1, 2, 3, 4)]


#: How many n-grams of 3 (c), and of 2 words (d) or of one (d) have counts of 1 to 4.
OFTEN3, OFTEN = ", ".join(f"c{k} long" for k in (1, 2, 3, 4)), ", ".join(f"d{k} long" for k in (1, 2, 3, 4))


def with_numbers(batch, names, numbers):
    """A batch with columns of numbers that stand in its first row, zero in others."""
    for name, number in zip(names, numbers):
        column = np.zeros(batch.num_rows, type(number))
        if len(column):
            column[0] = number
        batch = batch.append_column(name, pa.array(column))
    return batch


def totals(tables, names):
    """The sums of columns of numbers over tables."""
    both = reduce(DataFrame.unionByName, [t.select(*names) for t in tables])
    return [x or 0 for x in both.agg(*[F.sum(c) for c in names]).first()]


def names_of(schema):
    return [f.split()[0] for f in schema.split(", ")]


def packed_pairs(middle, word, n):
    """A cell of 2-grams, sorted by their first word."""
    return cells.planes(cells.steps(middle)) + cells.planes(word) + cells.planes(n.astype(np.uint32))


def pairs_in(batches):
    """The 2-grams of each cell, (first word, second word, count), and where each first word begins."""
    for batch in batches:
        for cell in batch.column("payload"):
            cell = cell.as_buffer()
            n = len(cell) // 20
            middle, at = cells.from_planes(cell, np.uint64, n, 0)
            word, at = cells.from_planes(cell, np.uint64, n, at)
            n, _ = cells.from_planes(cell, np.uint32, n, at)
            middle = np.cumsum(middle, dtype=np.uint64)
            yield middle, word, n, np.flatnonzero(np.append(True, middle[1:] != middle[:-1]))


class Counts(NamedTuple):
    """What ``count_words`` found: cells of 2-grams by model and round, cells of words by model, and discounts by length."""

    texts: DataFrame
    share: tuple
    pairs: dict
    words: dict
    off: dict
    whole: dict


def count_words(docs, table, share=None):
    """Counts of all n-grams of the texts. Those of WORDS words are dealt round by round and not kept, since they outgrow the texts."""
    spark = docs.sparkSession
    shards, rounds = share = share or shares(docs)
    sent = spark.sparkContext.broadcast(table)

    def once(group):
        _, middle, word, n, _ = counted(group["payload"])
        return pa.Table.from_batches([with_numbers(cells.deal(shards, middle, [middle, word]), names_of(OFTEN3), how_many(n))])

    def pair(group):
        middle, word = cells.together(group["payload"], PAIR)
        order, begins = distinct(longer(middle, word))
        at, n = order[begins], np.diff(np.append(begins, len(order)))
        order = np.argsort(middle[at])
        at, n = at[order], n[order]
        numbers = [pa.compute.sum(group[c]).as_py() for c in names_of(OFTEN3)] + how_many(n)
        cell = pa.RecordBatch.from_arrays([pa.array([packed_pairs(middle[at], word[at], n)], pa.binary())], names=["payload"])
        return pa.Table.from_batches([with_numbers(cell, names_of(f"{OFTEN3}, {OFTEN}"), numbers)])

    pairs = {}
    for model in range(MODELS):
        for r in range(rounds):
            found = runs(docs, model, share, r).groupBy("shard").applyInArrow(once, f"{cells.SCHEMA}, {OFTEN3}")
            pairs[model, r] = staged(found.groupBy("shard").applyInArrow(pair, f"payload binary, {OFTEN3}, {OFTEN}"), "words2")

    def vocabulary(batches):
        for batch in common.slices(batches, limit=SLICE_BYTES):
            data, offsets = common.text_buffers(batch.column("text"))
            found = []
            for _, start, w in parts_of(data, offsets, batch.column("half").to_numpy()):
                at = np.flatnonzero(w.inner)
                own, first = np.unique(w.key[at], return_index=True)
                token = w.token[at[first]]
                known = token >= 0
                begin, end = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
                begin[known], end[known] = w.starts[token[known]] + start, w.ends[token[known]] + start
                found.append([own, begin, end])
            key, begin, end = (np.concatenate(c) for c in zip(*found))
            order, begins = distinct(key)
            at = order[begins]
            yield cells.deal(shards, key[at], [key[at], spelled(sent.value, data, begin[at], end[at])])

    def second_words(batches):
        for _, word, _, _ in pairs_in(batches):
            order, begins = distinct(word)
            own = word[order[begins]]
            yield cells.deal(shards, own, [own, np.diff(np.append(begins, len(order))).astype(np.uint32)], ordered=True)

    def one(left, right):
        word, n = cells.together(left["payload"], NUMBER)
        key, loss = cells.together(right["payload"], SPELLED)
        order, begins = distinct(word)
        word, n = word[order[begins]], sums(n[order].astype(np.int64), begins)
        order = np.argsort(key)
        loss = loss[order[np.searchsorted(key[order], word)]] if len(word) else np.zeros(0)
        cell = b"".join(c.tobytes() for c in (word, n.astype(np.uint32), loss))
        shard = (left if left.num_rows else right)["shard"][:1].combine_chunks()
        batch = pa.RecordBatch.from_arrays([shard, pa.array([cell], pa.binary())], names=["shard", "payload"])
        return pa.Table.from_batches([with_numbers(batch, names_of(f"{OFTEN}, {SIZES}"), [*how_many(n), len(n), int(n.sum())])])

    words = {}
    for model in range(MODELS):
        own = reduce(DataFrame.unionByName, [t.select("payload") for (m, _), t in pairs.items() if m == model])
        left = own.mapInArrow(second_words, cells.SCHEMA).groupBy("shard")
        right = docs.where(F.col("half") == model).select("text", "half").mapInArrow(vocabulary, cells.SCHEMA).groupBy("shard")
        words[model] = staged(left.cogroup(right).applyInArrow(one, f"{cells.SCHEMA}, {OFTEN}, {SIZES}"), "words1")
    often = totals(pairs.values(), names_of(f"{OFTEN3}, {OFTEN}"))
    off = {3: discount_of(*often[:4]), 2: discount_of(*often[4:]), 1: discount_of(*totals(words.values(), names_of(OFTEN)))}
    whole = {}
    for model, t in words.items():
        n1, n2, _, _, n, total = totals([t], names_of(f"{OFTEN}, {SIZES}"))
        if n:
            whole[model] = total, (off[1][0] * n1 + off[1][1] * n2 + off[1][2] * (n - n1 - n2)) / total
    return Counts(docs, share, pairs, words, {k: np.array(v) for k, v in off.items()}, whole)


#: How many words there are and the sum of their counts.
SIZES = "n long, total long"


def discount_of(n1, n2, n3, n4):
    """What modified Kneser-Ney takes off counts of 1, of 2, and of more, from how many n-grams have counts of 1 to 4."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    return [min(max(d, 0.1), k - 0.1) for k, d in (
        (1, 1 - 2 * y * n2 / n1 if n1 else 0.5), (2, 2 - 3 * y * n3 / n2 if n2 else 1), (3, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    )]


class Weights(NamedTuple):
    """Log weight of spellings by model, and the rounds that values are in."""

    of: dict
    rounds: int


class Values:
    """Values of n-grams whose sum over all n-grams of a text is its log-probability, made a model and a round at a time.

    With p(w | uv) = p3 where uvw is seen, else weight(uv) p(w | v), the logarithm is the sum of log p1(w), log weight(v)
    and log weight(uv), of log p2 - log weight(v) - log p1 where vw is seen, and of log p3 - log weight(uv) - log p2
    where uvw is seen. A context without a row has weight 1, a word without one weight times spelling. An n-gram may have two
    rows, as one that is seen and as a context. A round has the n-grams of WORDS words and their contexts by the middle word, 2-grams by their
    first word, and single words by themselves. What it needs goes with it, so values can be gone through once.
    """

    def __init__(self, counts):
        self.counts = counts

    def rounds(self, shards):
        """(model, round, cells of gram and value dealt to ``shards``) of all rounds; a round's cells go when the next one is asked for."""
        for model, r in self.counts.pairs:
            found = self._round(model, r, shards)
            unstage(self.counts.pairs[model, r])
            yield model, r, found
            unstage(found)
            if r == self.counts.share[1] - 1:
                unstage(self.counts.words[model])

    def count(self):
        """How many values there are."""
        size = F.sum(F.octet_length("payload")) / sum(np.dtype(k).itemsize for k in BELOW)
        return sum(int(found.agg(size).first()[0] or 0) for _, _, found in self.rounds(LEAST_SHARDS))

    def _round(self, model, r, to):
        counts = self.counts
        shards, rounds = counts.share
        off = counts.off
        total, least = counts.whole.get(model, (1, 1.0))
        pairs, words = counts.pairs[model, r].select("payload"), counts.words[model].select("shard", "payload")

        def parts(n, begins, length):
            """Of n-grams of contexts that begin at ``begins``: the discounted part, and the weight of each context."""
            own = off[length][np.minimum(n, 3) - 1]
            size = np.diff(np.append(begins, len(n)))
            all_, left = sums(n.astype(np.int64), begins), sums(own, begins)
            return (n - own) / np.repeat(all_, size), left / all_, size

        def below(n, loss):
            """log p1 of words."""
            return np.log((n - off[1][np.minimum(n, 3) - 1]) / total + least * np.exp(-loss))

        def logs(gram, value, ordered=False):
            return cells.deal(to, gram, [gram, value.astype(np.float32)], ordered=ordered)

        def weigh(group):
            context, middle, word, n, begins = counted(group["payload"])
            p, weight, size = parts(n, begins, 3)
            shorter = longer(middle, word)
            seen = [longer(context, word), shorter, p.astype(np.float32), np.repeat(weight, size).astype(np.float32)]
            out = cells.deal(shards, shorter, seen), logs(context[begins], np.log(weight), ordered=True)
            return pa.Table.from_batches([b.append_column("kind", pa.array(np.full(b.num_rows, k, np.int32))) for k, b in enumerate(out)])

        def by_second(batches):
            for middle, word, n, begins in pairs_in(batches):
                p, weight, size = parts(n, begins, 2)
                yield cells.deal(shards, word, [middle, word, p.astype(np.float32), np.repeat(weight, size).astype(np.float32)])

        def contexts(batches):
            for middle, _, n, begins in pairs_in(batches):
                yield logs(middle[begins], np.log(parts(n, begins, 2)[1]), ordered=True)

        def single(batches):
            for batch in batches:
                word, n, loss = cells.together(batch.column("payload"), WORD)
                own = round_of(word, rounds) == r
                yield logs(word[own], below(n[own], loss[own]))

        def second(left, right):
            middle, word, p, weight = cells.together(left["payload"], HEADED)
            known, n, loss = cells.together(right["payload"], WORD)
            order = np.argsort(known)
            shorter = below(n, loss)[order[np.searchsorted(known[order], word)]] if len(word) else np.zeros(0)
            p2 = p + weight * np.exp(shorter)
            gram, value = longer(middle, word), np.log(p2) - np.log(weight.astype(np.float64)) - shorter
            return pa.Table.from_batches([cells.deal(shards, gram, [gram, p2.astype(np.float32), value.astype(np.float32)])])

        def back_off(left, right):
            gram, shorter, p, weight = cells.together(left["payload"], SEEN)
            known, below2, value2 = cells.together(right["payload"], BELOW2)
            order = np.argsort(known)
            p2 = below2[order[np.searchsorted(known[order], shorter)]].astype(np.float64) if len(gram) else np.zeros(0)
            value = np.log(p + weight * p2) - np.log(weight.astype(np.float64)) - np.log(p2)
            return pa.Table.from_batches([logs(np.concatenate([gram, known]), np.concatenate([value, value2]))])

        found = staged(
            runs(counts.texts, model, counts.share, r).groupBy("shard").applyInArrow(weigh, f"{cells.SCHEMA}, kind int"), "weights"
        )
        two = pairs.mapInArrow(by_second, cells.SCHEMA).groupBy("shard").cogroup(words.groupBy("shard")).applyInArrow(second, cells.SCHEMA)
        three = found.where("kind = 0").select("shard", "payload").groupBy("shard").cogroup(two.groupBy("shard")).applyInArrow(back_off, cells.SCHEMA)
        rest = [found.where("kind = 1").select("shard", "payload"), pairs.mapInArrow(contexts, cells.SCHEMA), words.mapInArrow(single, cells.SCHEMA)]
        out = staged(reduce(DataFrame.unionByName, rest, three), "values")
        unstage(found)
        return out


def values(counts):
    """The ``Values`` of n-grams, and each model's log weight of spellings."""
    return Values(counts), Weights({m: math.log(w) for m, (_, w) in counts.whole.items()}, counts.share[1])


def half(text="text"):
    return F.pmod(F.xxhash64(text), F.lit(MODELS)).cast("int")


def text_losses(docs, spellings, table, weights, share=None):
    """(dig, loss) of each distinct text; ``docs`` has text, dig and half. N-grams meet the values of a model and round at a time."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(spellings)
    shards, _ = share or shares(docs)
    rounds = weights.rounds

    def asked(model, r):
        base = weights.of.get(model, 0.0)

        def emit(batches):
            for batch in common.slices(batches, limit=SLICE_BYTES):
                dig = batch.column("dig").to_numpy()
                _, own, copies = np.unique(dig, return_index=True, return_counts=True)
                texts = batch.column("text") if len(own) == len(dig) else batch.column("text").take(pa.array(own))
                if len(own) == len(dig):
                    own, copies = np.arange(len(dig)), np.ones(len(dig), np.int64)
                data, offsets = common.text_buffers(texts)
                found, singles = [], []
                for lo, start, w in parts_of(data, offsets, np.full(len(own), model)):
                    now = round_of(w.key, rounds) == r
                    before = w.after(now)
                    # words are of their own round; 2-grams are seen in the round of their first word and contexts in that of their second
                    one, two, three = (np.flatnonzero(v) for v in (w.inner & now, w.inner & (before | now), w.full & before))
                    key = [w.key[one], w.pair(two), longer(w.pair(three - 1), w.key[three])]
                    token = w.token[one]
                    begin = np.where(token >= 0, np.append(w.starts, 0)[token] + start, 0)
                    end = np.where(token >= 0, np.append(w.ends, 0)[token] + start, 0)
                    word = np.zeros(sum(map(len, key)), bool)
                    word[: len(one)] = True
                    found.append([np.concatenate(key), (np.concatenate([w.doc[x] for x in (one, two, three)]) + lo).astype(np.uint32), word])
                    singles.append([begin, end])
                key, whose, word = (np.concatenate(c) for c in zip(*found))
                begin, end = (np.concatenate(c) for c in zip(*singles))
                number = np.cumsum(word) - 1  # of each single word
                order, begins = distinct(key)
                first = order[begins]
                missed = np.zeros(len(first), np.float32)
                own_words = np.flatnonzero(word[first])
                at = number[first[own_words]]
                missed[own_words] = base - spelled(sent.value, data, begin[at], end[at])
                yield dealt_questions(shards, key[first], missed, np.diff(np.append(begins, len(order))), whose[order], dig[own], copies)

        return docs.where(F.col("half") == MODELS - 1 - model).select("text", "dig").mapInArrow(emit, cells.SCHEMA)

    def meet(left, right):
        gram, value = cells.together(right["payload"], BELOW)
        order, begins = distinct(gram)
        gram, value = gram[order[begins]], sums(value[order].astype(np.float64), begins)
        dig, loss = [np.zeros(0, np.int64)], [np.zeros(0)]
        for cell in left["payload"]:
            key, missed, n, place, digs, copies = questions_in(cell.as_buffer())
            worth = missed.astype(np.float64)
            if len(gram):
                at = np.minimum(np.searchsorted(gram, key), len(gram) - 1)
                worth = np.where(gram[at] == key, value[at], worth)
            dig.append(digs)
            loss.append(-np.bincount(place, np.repeat(worth, n), len(digs)) * copies)
        return pa.table({"dig": np.concatenate(dig), "loss": np.concatenate(loss)})

    parts = []
    for model, r, known in table.rounds(shards):
        met = asked(model, r).groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(meet, "dig long, loss double")
        parts.append(staged(met.groupBy("dig").agg(F.sum("loss").alias("loss")), "part-losses"))
    return reduce(DataFrame.unionByName, parts).groupBy("dig").agg(F.sum("loss").alias("loss"))


def dealt_questions(shards, key, missed, n, whose, dig, copies):
    """Cells of sorted n-grams: what each is worth if it is not known, how often it is asked for, and by which texts."""
    begins = np.append(0, np.cumsum(n))
    rows = np.arange(len(key))

    def cell(part):
        a, b = part[0][0], part[0][-1] + 1
        asking = whose[begins[a] : begins[b]]
        own = np.zeros(len(dig), bool)
        own[asking] = True
        place = (np.cumsum(own) - 1)[asking].astype(np.uint32)
        head = np.array([b - a, len(place), own.sum()], np.int64)
        packed = [cells.steps(key[a:b]), missed[a:b], n[a:b].astype(np.uint32), place]
        return [head, *[np.frombuffer(cells.planes(c), np.uint8) for c in packed], dig[own], copies[own]]

    return cells.deal(shards, key, [rows], cell, ordered=True)


def questions_in(cell):
    """What ``dealt_questions`` packed: keys, their worth if not known, how often each is asked for, texts, their digests and copies."""
    (head,), at = cells.read(cell, [np.int64], n=3)
    out = []
    for kind, n in zip((np.uint64, np.float32, np.uint32, np.uint32), head[[0, 0, 0, 1]].tolist()):
        column, at = cells.from_planes(cell, kind, n, at)
        out.append(column)
    (digs, copies), _ = cells.read(cell, [np.int64, np.int64], at)
    return np.cumsum(out[0], dtype=np.uint64), *out[1:], digs, copies


def quantiles(placed, within, quantile):
    """The smallest value ``own`` of each group that ``quantile`` of its rows do not exceed, exactly, and their number n.

    Ranks are running sums in two levels, so the result depends neither on the layout nor on a sketch.
    """
    ranked = running_sum(placed, "one", "part", ["place"], within, "rank")
    if within:
        sizes = staged(placed.groupBy(*within).agg(F.count(F.lit(1)).alias("n")), "sizes")
        sizes = sizes.withColumnsRenamed({k: f"_{k}" for k in within})
        both = ranked.join(small_side(sizes), [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in within])
    else:
        both = ranked.withColumn("n", F.lit(placed.count()))
    return both.where(F.col("rank") == F.greatest(F.ceil(F.col("n") * quantile), F.lit(1)) - 1).drop(*[f"_{k}" for k in within])


def trusted_ids(labels, key="doc_id"):
    """Keys that are labelled good and not toxic, and never otherwise."""
    own = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("trusted_id"))
    return (
        own.agg(F.min(F.coalesce("quality", F.lit(0))).alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
        .where("q = 1 and t = 0")
        .select("trusted_id")
    )


def count_grams(docs):
    """Counts of all n-grams of the texts, (gram, n), each text ``n`` times if there is such a column: summed in each task, then in shards by gram."""

    def count(batches):
        total = np.zeros(SYMBOLS**ORDER)
        for batch in common.slices(batches):
            code, counts = grams(*common.text_buffers(batch.column("text")))
            times = np.repeat(batch.column("n").to_numpy(), np.diff(counts)) if "n" in batch.schema.names else None
            total += np.bincount(code, times, minlength=len(total))
        seen = np.flatnonzero(total)
        for lo in range(0, len(seen), 50_000):
            part = seen[lo : lo + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(total[part].astype(np.int64))], names=["gram", "n"])

    return docs.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def smoothed(counts):
    """Back-off tables of all orders: (order, gram, p) with p the discounted part of seen n-grams, and
    (order, gram, p) of order -k with p the weight that context ``gram`` of order k gives to shorter ones.
    """
    tables = {ORDER: staged(counts, "counts")}
    for order in range(ORDER - 1, 0, -1):  # in how many different contexts a shorter n-gram is seen
        tables[order] = staged(
            tables[order + 1]
            .groupBy(F.pmod("gram", F.lit(SYMBOLS**order)).alias("gram"))
            .agg(F.count(F.lit(1)).alias("n")),
            f"counts{order}",
        )
    out = None
    for order, table in tables.items():
        n1, n2, n3, n4 = table.agg(*[F.coalesce(F.sum((F.col("n") == k).cast("long")), F.lit(0)) for k in (1, 2, 3, 4)]).first()
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        discount = [min(max(d, 0.1), k - 0.1) for k, d in (
            (1, 1 - 2 * y * n2 / n1 if n1 else 0.5), (2, 2 - 3 * y * n3 / n2 if n2 else 1), (3, 3 - 4 * y * n4 / n3 if n3 else 1.5)
        )]
        off = F.when(F.col("n") == 1, discount[0]).when(F.col("n") == 2, discount[1]).otherwise(discount[2])
        table = table.withColumn("context", F.floor(F.col("gram") / SYMBOLS)).withColumn("off", off)
        contexts = table.groupBy("context").agg(F.sum("n").alias("total"), F.sum("off").alias("left"))
        seen = table.join(contexts, "context").select(
            F.lit(order).alias("order"), "gram", ((F.col("n") - F.col("off")) / F.col("total")).alias("p")
        )
        weights = contexts.select(F.lit(-order).alias("order"), F.col("context").alias("gram"), (F.col("left") / F.col("total")).alias("p"))
        both = seen.unionByName(weights)
        out = both if out is None else out.unionByName(both)
    return out


def fit(docs):
    """The table of -log p of each symbol after ORDER - 1 others, as an array of SYMBOLS ** ORDER floats."""
    rows = smoothed(count_grams(docs)).toArrow()
    order, gram, p = (rows[c].to_numpy() for c in ("order", "gram", "p"))
    probability = np.full(1, 1 / SYMBOLS)
    for k in range(1, ORDER + 1):
        weight = np.ones(SYMBOLS ** (k - 1))
        weight[gram[order == -k]] = p[order == -k]
        shorter = np.full(SYMBOLS, probability[0]) if k == 1 else np.tile(probability, SYMBOLS)
        probability = np.repeat(weight, SYMBOLS) * shorter
        np.add.at(probability, gram[order == k], p[order == k])
    return (-np.log(probability)).astype(np.float32)


def text_of_tokens(docs):
    """The distinct tokens of a slice of texts, each a text of its own with a blank at its end, and how often each occurs, ``n``."""

    def split(batches):
        for batch in common.slices(batches, limit=SLICE_BYTES):
            data, offsets = common.text_buffers(batch.column("text"))
            starts, ends, _ = split_tokens(data, offsets)
            order, begins = distinct(hash_tokens(data, starts, ends))
            own, n = order[begins], np.diff(np.append(begins, len(order)))
            joined, cuts = apart(data, starts[own], ends[own])
            for lo in range(0, len(own), 100_000):
                at = cuts[lo : lo + 100_001]
                column = pa.StringArray.from_buffers(
                    len(at) - 1, pa.py_buffer((at - at[0]).astype(np.int32)), pa.py_buffer(joined[at[0] : at[-1]].tobytes())
                )
                yield pa.RecordBatch.from_arrays([column, pa.array(n[lo : lo + 100_000])], names=["text", "n"])

    return docs.select("text").mapInArrow(split, "text string, n long")


class Classifier:
    """Models and thresholds trained on the trusted rows of ``df``; see ``classify``."""

    def __init__(self, df, labels, text="text", key="doc_id", lang="lang", quantile=QUANTILE, margin=MARGIN):
        common.ship(df.sparkSession)
        self.columns = text, key, lang
        with shuffles_removed(df.sparkSession):
            self._train(df, labels, quantile, margin)

    def _train(self, df, labels, quantile, margin):
        docs = self._documents(df)
        # how much is trusted has no bound: its keys are broadcast only while they are few
        good = small_side(staged(trusted_ids(labels, self.columns[1]), "trusted"))
        trusted = staged(docs.join(good, docs["doc_id"] == F.col("trusted_id"), "left_semi").select("text", half().alias("half")), "texts")
        spellings = fit(text_of_tokens(trusted))
        texts = docs.select("text", "dig", half().alias("half"))
        share = shares(texts)
        table, weights = values(count_words(trusted, spellings, share))
        rows = docs.select("doc_id", "lang", "dig", F.length("text").cast("long").alias("n_symbols"))
        copies = rows.groupBy("dig").agg(F.count(F.lit(1)).alias("copies"))
        losses = text_losses(texts, spellings, table, weights, share)
        unstage(trusted)
        self.losses = staged(losses.join(copies, "dig").select("dig", (F.col("loss") / F.col("copies")).alias("loss")), "losses")
        self.scores = staged(rows.join(self.losses.hint("merge"), "dig").drop("dig"), "scores")
        trusted = self.scores.join(good, self.scores["doc_id"] == F.col("trusted_id"), "left_semi").where("n_symbols > 0")
        mean = trusted.agg(F.sum("loss") / F.sum("n_symbols")).first()[0]
        self.mean = math.log(SYMBOLS) if mean is None else mean
        judged = in_order(trusted.select("lang", self._perplexity().alias("own")), ["lang", "own"], "trusted-order")
        judged = judged.withColumn("one", F.lit(1))
        overall = quantiles(in_order(judged.select("own", "one"), ["own"], "trusted-order"), [], quantile).first()
        self.overall = overall and overall["own"] * margin
        by_lang = quantiles(judged, ["lang"], quantile).where(F.col("n") >= LEAST_TRUSTED)
        self.limits = staged(by_lang.select(F.col("lang").alias("of"), (F.col("own") * margin).alias("own")), "limits")

    def _documents(self, df, *more):
        text, key, lang = self.columns
        own = F.coalesce(F.col(text), F.lit(""))
        return df.select(
            F.col(key).cast("long").alias("doc_id"), own.alias("text"), F.col(lang).cast("string").alias("lang"),
            F.xxhash64(own).alias("dig"), *more,
        )

    def _perplexity(self):
        return F.exp((F.col("loss") + PRIOR * self.mean) / (F.col("n_symbols") + PRIOR))

    def decide(self, scores):
        """Scores with perplexity, threshold and ``kept``."""
        judged = scores.join(self.limits, scores["lang"].eqNullSafe(F.col("of")), "left").withColumns({
            "perplexity": F.when(F.col("n_symbols") > 0, self._perplexity()),
            "threshold": F.coalesce("own", F.lit(self.overall).cast("double")),
        })
        below = F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
        return judged.withColumn("kept", (F.col("n_symbols") > 0) & below)

    def kept_rows(self, df):
        """The rows of ``df`` that are kept."""
        row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
        rows = self._documents(df, row).select("lang", "dig", F.length("text").cast("long").alias("n_symbols"), "row")
        judged = self.decide(rows.join(self.losses.hint("merge"), "dig")).where("kept")
        return judged.select(*[F.col("row").getField(c).alias(c) for c in df.columns])


def classify(df, labels, **options):
    """One row per row of ``df``: doc_id, lang, n_symbols, perplexity, threshold and kept.

    ``labels`` has the key, quality and toxic; the model is trained on all rows whose key is trusted.
    The perplexity is per symbol, with short texts drawn to the mean; a language's threshold is
    ``margin`` times a quantile of its trusted documents, or of all trusted documents
    where it has fewer than ``LEAST_TRUSTED`` of them. Null or empty texts have no perplexity and
    are not kept; a null language is a language; a null key is never trusted; repeated rows count
    as often as they occur. Without trusted text there is no threshold, and texts are kept.
    """
    classifier = Classifier(df, labels, **options)
    return classifier.decide(classifier.scores).select(
        "doc_id", "lang", "n_symbols", "perplexity", "threshold", "kept"
    )


def kept_rows(df, labels, **options):
    """The rows of ``df`` that are kept, with all their columns; each row goes or stays by its own text."""
    return Classifier(df, labels, **options).kept_rows(df)
