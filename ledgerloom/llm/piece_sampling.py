"""SentencePiece encoding and decoding (5): sampled segmentations that repeat, and lossless decoding.

A text is a blank put before it and its characters, blanks written as ``\\u2581``. Pieces
have that mark only at their beginning, so the lattice of a text falls apart into
those of its words. For each distinct word the forward sums are filtered once;
for each occurrence a path is drawn backwards from the end, an edge into the
present place with its share of the sum. Random numbers are a hash of the seed,
the row's key, the word's place in the text and the step, so a text is segmented
the same way wherever and whenever it is computed.

A piece's weight falls with its rank in the model, ``(rank + SHIFT) ** -sharpness``.
Characters without a piece, and a ``\\u2581`` of the text itself, are their UTF-8
bytes, so decoding gives back exactly what was encoded.
"""

import functools
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerloom.llm import common

MARK, OWN_MARK = "▁", "\ud800"  # no valid text has the second
SHIFT, SHARPNESS, SEED = 10.0, 1.0, 17
#: Base of the hashes that find pieces, whose characters are then compared; weights are scaled by
#: length to stay near one, which changes no share.
HASH, SCALE = np.uint64(0x9E3779B97F4A7C15), 10.0
#: Bits of a hash by which most places without a piece are seen at once.
SIEVE = 20
#: Words whose lattices a worker keeps before it starts anew.
REMEMBERED = 300_000
#: Bytes of text at a time, and characters from which the lattice of a word is not kept.
SLICE, LONG = 2 << 20, 200
WORD = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")


def codes(text):
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _spans(begin, end):
    """The numbers of all spans, one span after another, and where each span begins among them."""
    size = end - begin
    moved = np.cumsum(size) - size
    return np.repeat(begin - moved, size) + np.arange(size.sum()), moved


class Lattices:
    def __init__(self, path, sharpness=SHARPNESS):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [
            i for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        pieces = {model.id_to_piece(i): i for i in plain}
        if any(MARK in p.lstrip(MARK) or "\n" in p or OWN_MARK in p for p in pieces):
            raise ValueError("the model has a piece across words")
        order = sorted(plain, key=lambda i: (-model.get_score(i), i))
        self.weight = {model.id_to_piece(i): (i, (r + SHIFT) ** -sharpness) for r, i in enumerate(order)}
        self.longest = max(map(len, pieces), default=1)
        self.bytes = {b: model.piece_to_id(f"<0x{b:02X}>") for b in range(256)}
        self.text = {i: p.replace(MARK, " ").encode() for p, i in pieces.items()}
        self.text.update({i: bytes([b]) for b, i in self.bytes.items()})
        known = [self.text.get(i, b"") for i in range(model.get_piece_size())]
        self.sizes = np.fromiter(map(len, known), np.int64, len(known))
        self.starts, self.blob = np.cumsum(self.sizes) - self.sizes, np.frombuffer(b"".join(known), np.uint8)
        self.tables = self._tables()
        self._forget()

    def _forget(self):
        self.index = {}
        self.uses = np.zeros(0, np.int64)  # of each word, halved whenever words are left out
        self.node_of = np.zeros(0, np.int64)  # last node of each word
        self.edges = np.zeros(1, np.int64)  # first edge into each node, and one more at the end
        self.cum = np.zeros(0, np.int64)  # of each edge: the share of the node's edges up to it, of 2 ** 32
        self.back = np.zeros(0, np.int32)  # the node that an edge comes from, -1 the beginning
        self.first = np.zeros(1, np.int64)  # where the ids of an edge begin, and one more at the end
        self.ids = np.zeros(0, np.int32)

    def _keep_used(self):
        """Leave out words that have been used once, all if too many are left. What a word is cut into does not depend on it."""
        kept = np.flatnonzero(self.uses > 1)
        if not 0 < len(kept) <= REMEMBERED // 2:
            return self._forget()
        words = list(self.index)
        begin = np.append(0, self.node_of[:-1] + 1)[kept]
        nodes, moved = _spans(begin, self.node_of[kept] + 1)
        degree = np.diff(self.edges)[nodes]
        edges, _ = _spans(self.edges[begin], self.edges[self.node_of[kept] + 1])
        ids, _ = _spans(self.first[self.edges[begin]], self.first[self.edges[self.node_of[kept] + 1]])
        shift = np.repeat(np.repeat(begin - moved, self.node_of[kept] + 1 - begin), degree)
        back, count = self.back[edges], np.diff(self.first)[edges]
        self.back = np.where(back < 0, -1, back - shift).astype(np.int32)
        self.cum, self.ids = self.cum[edges], self.ids[ids]
        self.edges, self.first = np.append(0, np.cumsum(degree)), np.append(0, np.cumsum(count))
        self.node_of = moved + self.node_of[kept] - begin
        self.uses = self.uses[kept] // 2
        self.index = {words[k]: i for i, k in enumerate(kept.tolist())}

    def _tables(self):
        """By length: sorted hashes of the pieces, their characters, ids and weights."""
        tables = {}
        for piece, (i, w) in self.weight.items():
            tables.setdefault(len(piece), []).append((piece, i, w))
        for n, rows in tables.items():
            chars = np.array([codes(p) for p, _, _ in rows], np.uint32).reshape(len(rows), n)
            hashes = np.zeros(len(rows), np.uint64)
            for k in range(n):
                hashes = hashes * HASH + chars[:, k].astype(np.uint64) + np.uint64(1)
            order = np.argsort(hashes, kind="stable")
            ids, weights = np.array([i for _, i, _ in rows], np.int32), np.array([w for _, _, w in rows])
            sieve = np.zeros(1 << SIEVE, bool)
            sieve[hashes & np.uint64((1 << SIEVE) - 1)] = True
            tables[n] = hashes[order], chars[order], ids[order], weights[order] * SCALE**n, sieve
        return tables

    def _edges(self, chars, place):
        """(last character, length, piece, weight) of all pieces in words that stand one after another."""
        alone = chars.astype(np.uint64) + np.uint64(1)
        found, hashes = [], np.zeros(len(chars), np.uint64)
        for n in range(1, self.longest + 1):
            longer = alone.copy()
            longer[1:] += hashes[:-1] * HASH
            hashes = longer
            if n not in self.tables:
                continue
            table, own, ids, weights, sieve = self.tables[n]
            last = np.flatnonzero(sieve[hashes & np.uint64((1 << SIEVE) - 1)] & (place >= n - 1))
            at = np.minimum(np.searchsorted(table, hashes[last]), len(table) - 1)
            hit = table[at] == hashes[last]
            last, at = last[hit], at[hit]
            same = (chars[last[:, None] + np.arange(1 - n, 1)] == own[at]).all(1)
            last, at = last[same], at[same]
            found.append((last, np.full(len(last), n), ids[at], weights[at]))
            if n == 1:  # other characters are their bytes
                rest = np.setdiff1d(np.arange(len(chars)), last, assume_unique=True)
                found.append((rest, np.ones(len(rest), int), np.full(len(rest), -1, np.int32), np.full(len(rest), SCALE)))
        return [np.concatenate(c) for c in zip(*found)]

    def _bytes_of(self, char):
        raw = MARK if char == ord(OWN_MARK) else chr(char)
        return [self.bytes[b] for b in raw.encode()]

    def _learn(self, words):
        """Forward sums of words, place by place for all of them at once.

        A word's numbers come from its own edges in their own order, so they do not depend
        on the words around it.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        place = np.arange(len(chars)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        last, length, piece, weight = self._edges(chars, place)
        order = np.argsort((last << 32) - length, kind="stable")
        last, length, piece, weight = last[order], length[order], piece[order], weight[order]
        degree = np.bincount(last, minlength=len(chars))
        rank = np.arange(len(last)) - np.repeat(np.cumsum(degree) - degree, degree)
        before = np.where(place[last] - length < 0, -1, last - length)
        sums, logs, part = np.ones(len(chars)), np.zeros(len(chars)), np.zeros(len(last))
        step = place[last]
        by_place = np.argsort(step.astype(np.uint16) if len(step) and step.max() < 1 << 16 else step, kind="stable")
        cuts = np.searchsorted(step[by_place], np.arange(int(place.max(initial=0)) + 2))
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            e = by_place[lo:hi]
            # sums are kept as sum * exp(log) relative to the best way into each node
            log = np.where(before[e] < 0, 0.0, logs[before[e]])
            heads = np.flatnonzero(rank[e] == 0)
            top = np.maximum.reduceat(log, heads)
            into = last[e[heads]]
            way = np.where(before[e] < 0, 1.0, sums[before[e]]) * weight[e] * np.exp(log - np.repeat(top, degree[into]))
            total = np.add.reduceat(way, heads)
            part[e] = way / np.repeat(total, degree[into])
            far = (total < 1e-100) | (total > 1e100)
            sums[into], logs[into] = np.where(far, 1.0, total), np.where(far, top + np.log(total), top)
        cum = part.copy()
        for r in range(1, int(degree.max(initial=1))):
            e = np.flatnonzero(rank == r)
            cum[e] += cum[e - 1]
        cum = np.floor(cum * 2.0**32).astype(np.int64)
        cum[np.cumsum(degree) - 1] = 1 << 32
        count = np.ones(len(last), np.int64)
        raw = {e: self._bytes_of(int(chars[last[e]])) for e in np.flatnonzero(piece < 0).tolist()}
        count[list(raw)] = list(map(len, raw.values()))
        first = np.append(0, np.cumsum(count))
        ids = np.repeat(piece, count)
        for e, own in raw.items():
            ids[first[e] : first[e] + len(own)] = own
        base = len(self.edges) - 1
        known = len(self.node_of)
        self.index.update(zip(words, range(known, known + len(words))))
        self.node_of = np.append(self.node_of, base + np.cumsum(sizes) - 1)
        self.back = np.append(self.back, np.where(before < 0, -1, base + before).astype(np.int32))
        self.edges = np.append(self.edges, self.edges[-1] + np.cumsum(degree))
        self.cum = np.append(self.cum, cum)
        self.first = np.append(self.first, self.first[-1] + first[1:])
        self.ids = np.append(self.ids, ids)

    def sample(self, texts, keys, seed=SEED):
        """Ids of all texts, one after another, and how many each has; ``keys`` are 64-bit numbers."""
        words = [WORD.findall(MARK + t.replace(MARK, OWN_MARK).replace(" ", MARK)) for t in texts]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = list(chain.from_iterable(words))
        distinct = set(flat)
        if len(self.index) + len(distinct) > REMEMBERED:
            self._keep_used()
        fresh = [w for w in distinct if w not in self.index]
        if fresh:
            self._learn(fresh)
        which = np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat))
        self.uses = np.append(self.uses, np.zeros(len(self.index) - len(self.uses), np.int64))
        self.uses += np.bincount(which, minlength=len(self.uses))
        doc = np.repeat(np.arange(len(texts)), sizes)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        state = common.mix(np.asarray(keys, np.uint64)[doc] + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64)))
        state = common.mix(state ^ place.astype(np.uint64))
        node, active, picks, step = self.node_of[which], np.arange(len(flat)), [], 0
        steps = np.zeros(len(flat), np.int64)
        while len(active):
            draw = common.mix(state[active] + np.uint64((step * 0xD1342543DE82EF95) % (1 << 64)))
            u = (draw >> np.uint64(32)).astype(np.int64)
            edge = self.edges[node]
            beyond = np.flatnonzero(self.cum[edge] <= u)
            while len(beyond):
                edge[beyond] += 1
                beyond = beyond[self.cum[edge[beyond]] <= u[beyond]]
            picks.append((active, edge))
            steps[active] += 1
            node = self.back[edge]
            going = node >= 0
            active, node, step = active[going], node[going], step + 1
        begin = np.cumsum(steps) - steps
        path = np.empty(int(steps.sum()), np.int64)
        for s, (who, edge) in enumerate(picks):
            path[begin[who] + steps[who] - 1 - s] = edge
        count = self.first[path + 1] - self.first[path]
        total = np.append(0, np.cumsum(count))
        ids = self.ids[np.repeat(self.first[path] - total[:-1], count) + np.arange(total[-1])]
        of_word = np.append(0, np.cumsum(steps))
        of_text = total[of_word[np.append(0, np.cumsum(sizes))]]
        if max(map(len, fresh), default=0) > LONG:  # words of any length are not worth keeping
            self._forget()
        return ids, np.diff(of_text)

    def lossless(self, ids, counts, data, offsets):
        """Whether decoding the ids of each text gives back its bytes, ``data`` from one offset to the next."""
        sizes = self.sizes[ids]
        ends = np.append(0, np.cumsum(sizes))
        raw = self.blob[np.repeat(self.starts[ids] - ends[:-1], sizes) + np.arange(ends[-1])]
        first = ends[np.append(0, np.cumsum(counts))]
        same = np.diff(first) == np.diff(offsets) + 1  # a blank stands before the text
        if same.all():
            own = np.ones(len(raw), bool)
            own[first[:-1]] = False
            wrong = np.append(0, np.cumsum(raw[own] != data))
            return np.diff(wrong[offsets]) == 0
        pairs = zip(first[:-1].tolist(), first[1:].tolist(), offsets[:-1].tolist(), offsets[1:].tolist())
        return np.array([s and np.array_equal(raw[a + 1 : b], data[c:d]) for s, (a, b, c, d) in zip(same.tolist(), pairs)])

    def decode(self, ids):
        raw = b"".join(map(self.text.__getitem__, ids))
        return raw[1:].decode()


@common.remembered("lattices")
@functools.lru_cache(maxsize=2)
def lattices(path, sharpness=SHARPNESS):
    return Lattices(path, sharpness)


def encode(df, model, text="text", key="doc_id", seed=SEED, sharpness=SHARPNESS):
    """A sampled segmentation of each row: doc_id, n_pieces, ids and ``lossless``, whether decoding gave the text back.

    Null text is empty and is the blank before it alone. The key seeds a row, null as zero, so
    equal texts of different keys may differ and repeated rows do not. Other columns do not matter.
    """

    def work(batches):
        code = lattices(model, sharpness)
        for batch in common.slices(batches, limit=SLICE, kept=("lattices",)):
            texts = batch.column("text").to_pylist()
            keys = batch.column("seed_key").to_numpy().view(np.uint64)
            ids, counts = code.sample(texts, keys, seed)
            offsets = np.append(0, np.cumsum(counts))
            same = code.lossless(ids, counts, *common.text_buffers(batch.column("text")))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), lists, pa.array(same)],
                names=["doc_id", "n_pieces", "ids", "lossless"],
            )

    docs = common.documents(df, text, key).withColumn("seed_key", F.coalesce("doc_id", F.lit(0).cast("long")))
    return docs.mapInArrow(work, "doc_id long, n_pieces long, ids array<int>, lossless boolean")


def decode(df, model, ids="ids", key="doc_id"):
    """The texts of encoded rows: doc_id and text; null ids give null."""
    common.ship(df.sparkSession)

    def work(batches):
        code = lattices(model)
        for batch in batches:
            texts = [None if i is None else code.decode(i) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return df.select(F.col(key).cast("long").alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(
        work, "doc_id long, text string"
    )
