"""Token ids of whole texts with the tokenizers library, each distinct word encoded once per worker.

A tokenizer that drops white space and splits by the pattern ``LETTERS_APART``
encodes a text as its words one after another, and a word of letters with a
full stop or comma behind it as the two. Other tokenizers get whole texts.
"""

import functools
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerloom.llm import common

#: Fixed value: the pre-tokenizer pattern for which words can be encoded apart.
LETTERS_APART = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words that a worker remembers before it starts anew.
REMEMBERED = 1_000_000
#: Bytes of text that are given out together, and that are split and looked up at a time.
SLICE, PART = 4 << 20, 1 << 20
#: New words that the library encodes at a time: it holds some kilobytes of each until they are done.
AT_ONCE = 8192
SIMPLE = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")
MARKS, WORD_END = (".", ","), "</w>"


def words_apart(settings):
    """Whether a text's ids are those of its white-space separated words in turn."""
    pre, norm, model = (settings.get(k) or {} for k in ("pre_tokenizer", "normalizer", "model"))
    first = (pre.get("pretokenizers") or [{}])[0]
    return (
        first.get("type") == "Split"
        and first.get("pattern") == {"Regex": LETTERS_APART}
        and first.get("behavior") == "Removed"
        and first.get("invert") is True
        and [n.get("type") for n in norm.get("normalizers") or []] == ["NFC", "Replace", "Lowercase"]
        and model.get("end_of_word_suffix") == WORD_END
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in settings.get("added_tokens") or [])
    )


class Encoder:
    def __init__(self, path):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            self.apart = words_apart(json.load(file))
        vocabulary = self.tokenizer.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self._forget()

    def _forget(self):
        """The memory of words: arrays of bytes and ids, and hashes to find words by; some 40 bytes a word."""
        self.hashes, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.bytes, self.at = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self.flat, self.start = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self._keep(pa.array(["", *MARKS]), [[], *self._ids(list(MARKS))])

    def _ids(self, texts):
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, words):
        """Words of lower-case letters, encoded as one text and cut after each word's last id."""
        ids = self._ids([" ".join(words)])[0]
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(words):
            return self._ids(words)
        return [ids[a:b] for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist())]

    def _in_turn(self, encode, words):
        """The ids of all words as (all ids, how many each has), ``AT_ONCE`` words at a time."""
        ids, lengths = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for lo in range(0, len(words), AT_ONCE):
            found = encode(words[lo : lo + AT_ONCE])
            lengths.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter((i for x in found for i in x), np.uint32, int(lengths[-1].sum())))
        return np.concatenate(ids), np.concatenate(lengths)

    def _keep(self, words, ids):
        """Add words with their ids, given as lists or as (all ids, how many each has); their rows."""
        if isinstance(ids, list):
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            ids = np.fromiter((i for x in ids for i in x), np.uint32, int(lengths.sum()))
        else:
            ids, lengths = ids
        data, offsets = common.text_buffers(words)
        hashes = common.hash_words(data, offsets[:-1], offsets[1:])
        rows = np.arange(len(self.start) - 1, len(self.start) - 1 + len(words))
        order = np.argsort(hashes, kind="stable")
        place = np.searchsorted(self.hashes, hashes[order])
        self.hashes = np.insert(self.hashes, place, hashes[order])
        self.rows = np.insert(self.rows, place, rows[order].astype(np.int32))
        self.at = np.append(self.at, self.at[-1] + offsets[1:])
        self.bytes = np.append(self.bytes, data)
        self.start = np.append(self.start, self.start[-1] + np.cumsum(lengths))
        self.flat = np.append(self.flat, ids)
        return rows

    def _find(self, words):
        """The row of each word, -1 where it is not known; a hit is compared byte by byte."""
        data, offsets = common.text_buffers(words)
        hashes = common.hash_words(data, offsets[:-1], offsets[1:])
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        rows = np.where(self.hashes[place] == hashes, self.rows[place], -1).astype(np.int64)
        size = np.diff(offsets)
        rows[self.at[rows + 1] - self.at[rows] != size] = -1
        hit = np.flatnonzero((rows >= 0) & (size > 0))
        if len(hit):
            n = size[hit]
            head = np.cumsum(n) - n
            step = np.arange(n.sum()) - np.repeat(head, n)
            equal = data[np.repeat(offsets[hit], n) + step] == self.bytes[np.repeat(self.at[rows[hit]], n) + step]
            rows[hit[~np.logical_and.reduceat(equal, head)]] = -1
        return rows

    def _of(self, rows):
        """The ids of rows one after another, and how many each has."""
        lengths = self.start[rows + 1] - self.start[rows]
        total = np.append(0, np.cumsum(lengths))
        return self.flat[np.repeat(self.start[rows] - total[:-1], lengths) + np.arange(total[-1])], lengths

    def _learn(self, column):
        """Rows for words that are not known: letters by their lower-case form, a mark behind them apart."""
        words = column.to_pylist()
        rows = np.full(len(words), -1, np.int64)
        found = [SIMPLE.fullmatch(w) for w in words]
        other = [i for i, m in enumerate(found) if not m]
        if other:
            rows[other] = self._keep(column.take(pa.array(other)), self._in_turn(self._ids, [words[i] for i in other]))
        simple = [i for i, m in enumerate(found) if m]
        if simple:
            lower = [found[i][1].lower() for i in simple]
            bases = list(dict.fromkeys(lower))
            at = self._find(pa.array(bases))
            fresh = np.flatnonzero(at < 0).tolist()
            if fresh:
                new = [bases[i] for i in fresh]
                at[fresh] = self._keep(pa.array(new), self._in_turn(self._letters, new))
            row_of = dict(zip(bases, at.tolist()))
            base = np.fromiter(map(row_of.__getitem__, lower), np.int64, len(lower))
            mark = np.fromiter((1 + MARKS.index(m[2]) if m[2] else 0 for m in map(found.__getitem__, simple)), np.int64, len(simple))
            same = np.fromiter((words[i] == b for i, b in zip(simple, lower)), bool, len(simple))
            simple = np.array(simple)
            rows[simple[same]] = base[same]
            rest = simple[~same]
            if len(rest):
                ids, lengths = self._of(np.stack([base[~same], mark[~same]], 1).ravel())
                rows[rest] = self._keep(column.take(pa.array(rest)), (ids, lengths.reshape(-1, 2).sum(1)))
        return rows

    def encode(self, column):
        """Ids of all texts of an Arrow column, one after another, and how many each text has."""
        if not self.apart:
            ids = self._ids(column.to_pylist())
            counts = np.fromiter(map(len, ids), np.int64, len(ids))
            return np.fromiter((i for x in ids for i in x), np.uint32, int(counts.sum())), counts
        words = pc.ascii_split_whitespace(column)
        firsts = words.offsets.to_numpy().astype(np.int64)
        coded = words.flatten().dictionary_encode()
        # white space at an end of a text gives an empty word, which has no ids
        if len(self.rows) + len(coded.dictionary) > REMEMBERED:
            self._forget()
        rows = self._find(coded.dictionary)
        fresh = np.flatnonzero(rows < 0)
        if len(fresh):
            rows[fresh] = self._learn(coded.dictionary.take(pa.array(fresh)))
        ids, lengths = self._of(rows[coded.indices.to_numpy()])
        total = np.append(0, np.cumsum(lengths))
        firsts = firsts - firsts[0]
        return ids, total[firsts[1:]] - total[firsts[:-1]]


@common.remembered("encoder")
@functools.lru_cache(maxsize=2)
def encoder(path):
    return Encoder(path)


def encoded(batches, path, end=None):
    """For each slice of the batches: the batch, all ids, and the offset of each text in them.

    ``end`` is an id put after each text.
    """
    code = encoder(path)
    for batch in common.slices(batches, limit=SLICE, kept=("encoder",)):
        column = batch.column("text").cast(pa.string())
        parts = [code.encode(column.slice(lo, hi - lo)) for lo, hi in common.spans(common.text_buffers(column)[1], PART)]
        ids, counts = (np.concatenate(c) for c in zip(*parts))
        offsets = np.append(0, np.cumsum(counts))
        if end is not None:
            ids = np.insert(ids, offsets[1:], end)
            offsets = offsets + np.arange(len(offsets))
        yield batch, ids, offsets
