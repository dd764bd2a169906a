"""Generalised suffix automata over words, and streams of words run through them.

``build`` makes one automaton of the word sequences of several test items.
``Automaton.stream`` appends words one by one and keeps, for the words read so
far, the state and the length of their longest suffix that some item holds
(no longer than the window). Many positions of a block are streamed at once:
the words are cut into lanes, every step appends one word to each lane, and a
lane starts ``window - 1`` words early, after which its state is exact.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np

LANE = 256  # words a lane


class Lookup:
    """A read-only map from non-negative int64 (or uint64) keys to positions
    0..n-1: open addressing, all keys of an array looked up at once."""

    def __init__(self, keys: np.ndarray):
        keys = keys.astype(np.uint64)
        self.bits = max(3, (2 * len(keys)).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.at = np.full(1 << self.bits, -1, np.int64)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):  # of the keys that meet in a free slot one stays, the others move on
            free = self.at[slot] < 0
            self.at[slot[free]] = left[free]
            placed = self.at[slot] == left
            self.keys[slot[placed]] = keys[left[placed]]
            left, slot = left[~placed], (slot[~placed] + 1) & (len(self.at) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The position of each key, or -1."""
        keys = keys.astype(np.uint64, copy=False)
        slot = self._slot(keys)
        out = self.at[slot]
        other = np.flatnonzero((out >= 0) & (self.keys[slot] != keys))
        while len(other):
            slot[other] = (slot[other] + 1) & (len(self.at) - 1)
            out[other] = self.at[slot[other]]
            other = other[(out[other] >= 0) & (self.keys[slot[other]] != keys[other])]
        return out


class Automaton:
    """The automaton of ``items``: arrays of word numbers. ``owners`` gives
    each item's number; equal numbers are pieces of one item. ``whole`` says
    which items are shorter than ``window`` and so are windows as they stand."""

    def __init__(self, items: list[np.ndarray], owners: np.ndarray, window: int):
        self.window = window
        nexts, length, link = _states(items)
        self.length, self.link = np.array(length, np.int64), np.array(link, np.int64)
        self.words = 1 + max((int(x.max()) for x in items if len(x)), default=-1)
        edges = [(s * self.words + w, t) for s, step in enumerate(nexts) for w, t in step.items()]
        self.edge = Lookup(np.array([k for k, _ in edges], np.int64))
        self.target = np.array([t for _, t in edges], np.int64)
        self.first = np.zeros(self.words, np.int64)
        for w, t in nexts[0].items():
            self.first[w] = t
        self._windows(items, owners)

    def _windows(self, items: list[np.ndarray], owners: np.ndarray) -> None:
        """Which states are windows, and of which items."""
        size = np.array([len(x) for x in items], np.int64)
        ids = np.concatenate([np.append(x, -1) for x in items]) if items else np.zeros(0, np.int64)
        ends = np.cumsum(size + 1) - 2
        item = np.repeat(np.arange(len(items)), size + 1)
        states, lengths = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        for at, state, long in self.stream(ids):
            states[at], lengths[at] = state, long
        full = np.flatnonzero(lengths == self.window)
        short = ends[(size < self.window) & (size > 0)]
        pairs = np.unique(np.column_stack([states[np.append(full, short)], owners[item[np.append(full, short)]]]).reshape(-1, 2), axis=0)
        self.owner = pairs[:, 1]
        self.owner_offs = np.searchsorted(pairs[:, 0], np.arange(len(self.length) + 1))
        is_short = np.zeros(len(self.length), bool)
        is_short[states[short]] = True
        self.is_short = is_short
        # the nearest shorter suffix that is a whole item; links lead to shorter strings, so by length
        self.inner = np.full(len(self.length), -1, np.int64)
        for s in np.argsort(self.length, kind="stable")[1:]:
            up = self.link[s]
            self.inner[s] = up if is_short[up] else self.inner[up]

    def stream(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(positions, states, lengths), a step at a time, for all positions
        of ``ids`` (word numbers; -1: a word of no item, or a border)."""
        early = self.window - 1
        lanes = -(-len(ids) // LANE)
        padded = np.full(early + lanes * LANE, -1, np.int64)
        padded[early:early + len(ids)] = ids
        begin = np.arange(lanes) * LANE
        state, long = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        for step in range(early + LANE if lanes else 0):
            self._append(padded[begin + step], state, long)
            if step >= early:
                at = begin + (step - early)
                inside = at < len(ids)
                yield (at, state, long) if inside.all() else (at[inside], state[inside], long[inside])

    def _append(self, word: np.ndarray, state: np.ndarray, long: np.ndarray) -> None:
        """Append one word to every lane, in place."""
        known = word >= 0
        np.multiply(state, known, out=state)
        np.multiply(long, known, out=long)
        tried = np.flatnonzero(known & (state > 0))
        while len(tried):  # follow suffix links until the word goes on from there
            edge = self.edge(state[tried] * self.words + word[tried])
            found = edge >= 0
            state[tried[found]] = self.target[edge[found]]
            long[tried[found]] += 1
            known[tried[found]] = False
            tried = tried[~found]
            state[tried] = self.link[state[tried]]
            long[tried] = self.length[state[tried]]
            tried = tried[state[tried] > 0]
        fresh = np.flatnonzero(known)
        state[fresh] = self.first[word[fresh]]
        long[fresh] = 1
        over = np.flatnonzero(long > self.window)
        long[over] = self.window
        up = self.link[state[over]]
        state[over] = np.where(self.length[up] >= self.window, up, state[over])

    def windows(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(end position, length in words, state) of every occurrence of a
        window in ``ids``."""
        out = []
        for at, state, long in self.stream(ids):
            full = np.flatnonzero(long == self.window)
            if len(full):
                out.append((at[full], long[full], state[full]))
            own = np.flatnonzero((long > 0) & self.is_short[state] & (long == self.length[state]))
            if len(own):
                out.append((at[own], long[own], state[own]))
            at, state = at[(inner := self.inner[state]) >= 0], inner[inner >= 0]
            while len(at):
                out.append((at, self.length[state], state))
                more = self.inner[state] >= 0
                at, state = at[more], self.inner[state[more]]
        if not out:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*out))

    def owners_of(self, group: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (group, item) of (group, window state)."""
        pairs = np.unique(np.column_stack([group, state]).reshape(-1, 2), axis=0)
        lo, n = self.owner_offs[pairs[:, 1]], np.diff(self.owner_offs)[pairs[:, 1]]
        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        found = np.unique(np.column_stack([np.repeat(pairs[:, 0], n), self.owner[at]]).reshape(-1, 2), axis=0)
        return found[:, 0], found[:, 1]

    def dump(self) -> bytes:
        return pickle.dumps(self, protocol=5)


def _states(items: list[np.ndarray]) -> tuple[list[dict], list[int], list[int]]:
    """(transitions, longest length, suffix link) of the states of the items'
    automaton; state 0 is the empty string."""
    nexts: list[dict[int, int]] = [{}]
    length, link = [0], [-1]

    def split(p: int, w: int, q: int) -> int:
        """The state of p's string and w, where q holds longer ones too."""
        if length[q] == length[p] + 1:
            return q
        new = len(nexts)
        nexts.append(dict(nexts[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = new
        while p >= 0 and nexts[p].get(w) == q:
            nexts[p][w] = new
            p = link[p]
        return new

    for item in items:
        last = 0
        for w in item.tolist():
            if w in nexts[last]:  # an earlier item has this prefix
                last = split(last, w, nexts[last][w])
                continue
            new, p = len(nexts), last
            nexts.append({})
            length.append(length[last] + 1)
            link.append(0)
            while p >= 0 and w not in nexts[p]:
                nexts[p][w] = new
                p = link[p]
            if p >= 0:
                link[new] = split(p, w, nexts[p][w])
            last = new
    link[0] = 0
    return nexts, length, link
