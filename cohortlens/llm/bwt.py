"""Burrows-Wheeler transforms of string shards and their merge by iterative
interleave refinement, in numpy.

A shard's transform lists the symbol before each of its sorted suffixes. To
merge shards no suffix is compared again: an interleave says for each merged
rank which row of which shard it is. It starts with the shards one after
another; reading the transforms in its order and dealing the ranks out by
symbol (stably) gives the interleave that is right for one more symbol.
Ranks that a round tells apart for the first time in round h have a longest
common prefix of h - 1, so after ``depth`` rounds the runs without a boundary
are the repeated strings of ``depth`` symbols.
"""

from __future__ import annotations

import numpy as np


def symbols(buf: np.ndarray) -> tuple[np.ndarray, type]:
    """Dense ranks of the bytes in use, from 1 on (0 is the end mark)."""
    used = np.zeros(256, bool)
    used[buf] = True
    rank = np.cumsum(used)
    kind = np.uint8 if rank[-1] < 256 else np.uint16
    return rank.astype(kind)[buf], kind


def shard_bwt(text: np.ndarray, offs: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(transform, suffix starts) of the strings text[offs[i]:offs[i + 1]],
    each followed by an end mark. Suffixes are sorted by at least ``depth``
    symbols, then by place. A start counts end marks too: string i begins at
    offs[i] + i."""
    m = len(offs) - 1
    size = np.diff(offs)
    n = len(text) + m
    marked = np.zeros(n + depth + 8, text.dtype)
    ends = offs[1:] + np.arange(m)
    body = np.ones(n, bool)
    body[ends] = False
    marked[:n][body] = text
    left = np.repeat(ends, size + 1) - np.arange(n)  # symbols before the suffix's end mark
    step = 8 // text.dtype.itemsize
    shift = 64 // step
    words = []
    for lo in range(0, depth, step):
        word = np.zeros(n, np.uint64)
        for j in range(step):
            part = marked[lo + j:lo + j + n].astype(np.uint64)
            part[left <= lo + j] = 0
            word = (word << np.uint64(shift)) | part
        words.append(word)
    order = np.lexsort(words[::-1])  # stable: equal suffixes stay in place order
    before = np.zeros(n, text.dtype)
    before[1:] = marked[:n - 1]
    return before[order], order


def last_to_first(transform: np.ndarray, strings: int) -> np.ndarray:
    """For every row of a transform the row of the suffix one symbol longer (0
    where the suffix starts its string)."""
    inner = np.flatnonzero(transform)
    out = np.zeros(len(transform), np.int32)
    out[inner[np.argsort(transform[inner], kind="stable")]] = np.arange(strings, strings + len(inner), dtype=np.int32)
    return out


def merge(transforms: list[np.ndarray], strings: list[int], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(row of each merged rank, common prefix with the rank before, at most
    ``depth``). Rows count through the shards one after another; the shard a
    row belongs to is the interleave. ``strings`` counts each shard's strings.
    """
    begin = np.cumsum([0, *(len(t) for t in transforms)])
    longer = np.concatenate([last_to_first(t, m) + np.int32(o) for t, m, o in zip(transforms, strings, begin)])
    ends = np.concatenate([np.arange(o, o + m, dtype=np.int32) for m, o in zip(strings, begin)])
    all_symbols = np.concatenate(transforms)
    n, m = len(all_symbols), len(ends)
    row = np.arange(n, dtype=np.int32)
    block = np.zeros(n, np.int32)
    lcp = np.zeros(n, np.int32)
    edge = np.ones(n, bool)  # every end mark is a string's own
    for _ in range(depth):
        read = all_symbols[row]
        inner = np.flatnonzero(read)  # a suffix after an end mark starts a string
        perm = inner[np.argsort(read[inner], kind="stable")]
        now, was = read[perm], block[perm]
        edge[m + 1:] = (now[1:] != now[:-1]) | (was[1:] != was[:-1])
        lcp += ~edge  # an edge stays one: a rank counts the rounds before its own
        row = np.concatenate([ends, longer[row[perm]]])
        block = np.cumsum(edge, dtype=np.int32)
        if edge.all():
            break
    return row, lcp


def least_holders(buf: np.ndarray, offs: np.ndarray, holder: np.ndarray, length: int, shard_bytes: int = 1 << 15
                  ) -> np.ndarray:
    """For every byte position at which a string of ``length`` bytes starts
    inside its fragment, the smallest holder (one a fragment) of that string
    anywhere; -1 at the other positions."""
    text, _ = symbols(buf)
    shards = max(1, min(250, -(-len(buf) // shard_bytes)))
    cut = np.unique(np.searchsorted(offs, np.linspace(0, len(buf), shards + 1)[1:-1]))
    cut = np.concatenate([[0], cut[(cut > 0) & (cut < len(offs) - 1)], [len(offs) - 1]]).astype(np.int64)
    transforms, starts = [], []
    for lo, hi in zip(cut[:-1], cut[1:]):
        t, order = shard_bwt(text[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], length)
        transforms.append(t)
        starts.append(order + offs[lo] + lo)
    row, lcp = merge(transforms, np.diff(cut).tolist(), length)
    place = np.concatenate(starts)[row]
    frag_of = np.repeat(np.arange(len(offs) - 1), np.diff(offs) + 1)
    frag = frag_of[place]
    at = place - frag  # without end marks
    head = np.flatnonzero(lcp < length)
    least = np.minimum.reduceat(holder[frag], head)
    least = np.repeat(least, np.diff(np.append(head, len(lcp))))
    out = np.full(len(buf), -1, np.int64)
    whole = offs[frag + 1] - at >= length
    out[at[whole]] = least[whole]
    return out
