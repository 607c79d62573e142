"""Chat formatting (10): whole conversations, encoded once with offsets, and loss masks aligned to them.

A turn is ``<|im_start|>role<|im_sep|>text<|im_end|>``. In roles and texts a ``<`` that is
followed by any number of backslashes and a ``|`` gets one backslash more, so no
control string can stand in a text, and taking one away gives the text back.

The three control strings are tokens of their own, so no token reaches across the
border of a text. Which tokens lie in assistant texts is found by binary search
of the sorted turn spans among the sorted token spans.
"""

import functools
import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerloom.llm import common

START, SEP, END = CONTROLS = ("<|im_start|>", "<|im_sep|>", "<|im_end|>")
ESCAPE, UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
TURN = re.compile(r"<\|im_start\|>(.*?)<\|im_sep\|>(.*?)<\|im_end\|>", re.DOTALL)
#: Characters encoded at a time, about.
CHARS = 1 << 19
FORMATTED = "conv_id long, formatted string, ids array<int>, starts array<int>, ends array<int>, loss array<boolean>"


def escape(text):
    return ESCAPE.sub(r"<\\\1|", text)


def unescape(text):
    return UNESCAPE.sub(r"<\1|", text)


def render(turns, trained=("assistant",)):
    """The formatted conversation and the spans of the texts that are trained on."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{SEP}", escape(text)
        if role in trained:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def mask_of(spans, starts, ends):
    """Which tokens (sorted spans) share a character with one of the sorted turn spans."""
    mask = np.zeros(len(starts) + 1, np.int64)
    if spans and len(starts):
        spans = np.asarray(spans)
        spans = spans[spans[:, 1] > spans[:, 0]]
        lo = np.searchsorted(ends, spans[:, 0], side="right")  # the first token that ends after the span begins
        hi = np.searchsorted(starts, spans[:, 1], side="left")  # the first that begins where it ends or later
        np.add.at(mask, lo, 1)
        np.add.at(mask, hi, -1)
    return np.cumsum(mask[:-1]) > 0


@functools.lru_cache(maxsize=2)
def tokenizer(path):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import AddedToken, Tokenizer

    found = Tokenizer.from_file(path)
    found.add_special_tokens([AddedToken(c, special=True, normalized=False) for c in CONTROLS])
    return found


def conversations(df, conv="conv_id", turn="turn", role="role", text="text"):
    """One row per conversation with its turns in order: conv_id, turns (turn, role, text)."""
    return (
        df.select(
            F.col(conv).cast("long").alias("conv_id"),
            F.struct(
                F.col(turn).alias("turn"),
                F.coalesce(F.col(role), F.lit("")).alias("role"),
                F.coalesce(F.col(text), F.lit("")).alias("text"),
            ).alias("one"),
        )
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("one")).alias("turns"))
    )


def format_chats(df, path, trained=("assistant",), **columns):
    """Conversations as text, token ids, their character spans and loss mask, one row each.

    Rows are ordered by turn, then role and text; a null turn comes first; null roles and
    texts are empty; repeated rows are turns of their own; rows without a conv_id are one
    conversation; other columns do not matter. An empty table gives no rows. A
    conversation has to fit a task: it is rendered and encoded whole.
    """
    common.ship(df.sparkSession)

    def work(batches):
        code = tokenizer(path)
        for batch in batches:
            ids, turns = batch.column("conv_id"), batch.column("turns").to_pylist()
            done = 0
            while done < len(turns):
                texts, spans, size, lo = [], [], 0, done
                while done < len(turns) and size < CHARS:
                    text, own = render([(t["role"], t["text"]) for t in turns[done]], trained)
                    texts.append(text)
                    spans.append(own)
                    size += len(text)
                    done += 1
                rows = [[], [], [], []]
                for own, e in zip(spans, code.encode_batch(texts, add_special_tokens=False)):
                    starts, ends = np.array(e.offsets, np.int32).reshape(-1, 2).T
                    for col, value in zip(rows, (e.ids, starts, ends, mask_of(own, starts, ends))):
                        col.append(value)
                kinds = [pa.int32(), pa.int32(), pa.int32(), pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, done - lo), pa.array(texts)]
                    + [pa.array(c, pa.list_(k)) for c, k in zip(rows, kinds)],
                    names=["conv_id", "formatted", "ids", "starts", "ends", "loss"],
                )

    return conversations(df, **columns).mapInArrow(work, FORMATTED)


def parse(formatted):
    """The turns (role, text) of a formatted conversation."""
    return [(unescape(r), unescape(t)) for r, t in TURN.findall(formatted)]


def trained_text(formatted, starts, ends, loss):
    """The characters under the mask, run by run."""
    chosen = [(s, e) for s, e, m in zip(starts, ends, loss) if m]
    runs = []
    for s, e in chosen:  # tokens of one character's bytes share its span
        if runs and s <= runs[-1][1]:
            runs[-1][1] = max(e, runs[-1][1])
        else:
            runs.append([s, e])
    return [unescape(formatted[s:e]) for s, e in runs]


def digests(formatted):
    """What can be read back: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    def work(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                turns = parse(row["formatted"])
                loss = "".join(trained_text(row["formatted"], row["starts"], row["ends"], row["loss"]))
                whole = "".join(f"{r}\n{t}\n" for r, t in turns)
                out.append((row["conv_id"], len(turns), sha(whole), len(loss), sha(loss), len(row["formatted"])))
            cols = list(zip(*out)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    return formatted.mapInArrow(
        work,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
