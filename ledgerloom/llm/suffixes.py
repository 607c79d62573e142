"""Sparse suffix arrays over the runs of a shard: one suffix per run, at its anchor."""

import numpy as np


def repeated_in_shard(ids, lengths, copies, at, size):
    """Engine of ``repeats``: sort the suffixes at anchors, compare neighbours, extend to the left.

    A window that begins ``o`` words before its anchor occurs again where another
    suffix shares the first ``size - o`` words and has the same ``o`` words to its
    left. Sorted suffixes that share ``f`` words are neighbours whose common
    prefixes are all ``f`` or more, so each ``o`` needs one pass over neighbours
    and one grouping by the words to the left.
    """
    lengths, at, copies = (np.asarray(x, np.int64) for x in (lengths, at, copies))
    count, base = len(lengths), np.cumsum(lengths) - lengths
    mask = np.zeros(count, np.int64)
    if not count:
        return mask
    forward = lengths - at
    depth = min(size, int(forward.max()))
    column = np.arange(depth)
    suffix = np.full((count, depth), -1, np.int64)
    inside = column[None, :] < forward[:, None]
    suffix[inside] = ids[(base + at)[:, None] + column[None, :]][inside] if inside.all() else ids[
        np.minimum((base + at)[:, None] + column[None, :], len(ids) - 1)
    ][inside]
    order = np.lexsort(suffix.T[::-1])
    same = suffix[order[1:]] == suffix[order[:-1]]
    common = np.where(same.all(1), depth, np.argmin(same, axis=1)) if count > 1 else np.zeros(0, np.int64)
    left = np.zeros(count, np.int64)  # equal numbers: equal words to the left so far
    for o in range(0, int(at.max()) + 1):
        if o:
            word = np.where(at >= o, ids[np.maximum(base + at - o, 0)], -1 - np.arange(count))
            _, left = np.unique(np.stack([left, word]), axis=1, return_inverse=True)
            left = left.reshape(-1)
        need = size - o
        if need > depth:
            continue
        able = (at >= o) & (forward >= need)
        run = np.zeros(count, np.int64)
        run[order[1:]] = np.cumsum(common < need)
        who = np.flatnonzero(able)
        _, group = np.unique(run[who] * (count + 1) + left[who], return_inverse=True)
        total = np.bincount(group, weights=copies[who])
        hit = who[total[group] >= 2]
        mask[hit] |= np.int64(1) << (at[hit] - o)
    return mask
