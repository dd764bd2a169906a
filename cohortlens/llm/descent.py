"""NN-descent, greedy graph search and whole scans of one cell of vectors, in numpy.

A list's entry is one whole number: the squared distance (its 27 leading bits
as a float), whether the entry is new, and the neighbour's place. So lists are
sorted, merged and cut by plain sorts. A cell has fewer than ``MOST`` vectors.
"""

from __future__ import annotations

import numpy as np

BITS = 18
MOST = 1 << BITS
NEW, PLACE = np.int64(1 << BITS), np.int64(MOST - 1)
NONE = np.int64((0x7F800000 >> 4) << (BITS + 1)) | PLACE  # infinitely far, no place
BLOCK = 128     # nodes whose neighbours meet at once
SCAN = 2048     # vectors that a scan measures at once
WAITING = 1 << 19  # pairs that wait for their lists at most


def _bits(d: np.ndarray) -> np.ndarray:
    """The leading bits of distances, in their order."""
    return np.maximum(d, 0).astype(np.float32).view(np.int32).astype(np.int64) >> 4


def _distance(entries: np.ndarray) -> np.ndarray:
    return (entries >> (BITS + 1) << 4).astype(np.int32).view(np.float32)


def _entries(d: np.ndarray, place: np.ndarray) -> np.ndarray:
    return _bits(d) << (BITS + 1) | NEW | place


def _apart(x: np.ndarray, sq: np.ndarray) -> np.ndarray:
    """Squared distances within groups: (g, m, d) to (g, m, m)."""
    d = np.matmul(x, x.transpose(0, 2, 1))
    d *= -2
    d += sq[:, :, None]
    d += sq[:, None, :]
    return d


def _leaves(x: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    """Places, dealt to leaves of about ``size`` by medians of random
    projections: (leaves, places), -1 where a leaf has one fewer."""
    n = len(x)
    depth = max(0, int(np.ceil(np.log2(n / size))))
    order, leaf = np.arange(n), np.zeros(n, np.int64)
    for _ in range(depth):
        value = x @ rng.standard_normal(x.shape[1]).astype(x.dtype)
        order = np.lexsort((value, leaf))
        own = leaf[order]
        first = np.searchsorted(own, own)
        count = np.searchsorted(own, own, side="right") - first
        upper = np.arange(n) - first >= (count + 1) // 2
        leaf = np.empty(n, np.int64)
        leaf[order] = 2 * own + upper
    order = np.argsort(leaf, kind="stable")
    own = leaf[order]
    out = np.full((1 << depth, int(np.bincount(own).max())), -1, np.int64)
    out[own, np.arange(n) - np.searchsorted(own, own)] = order
    return out


def _first_lists(x: np.ndarray, sq: np.ndarray, width: int, trees: int, bucket: int) -> np.ndarray:
    """Every vector's nearest in its leaf of every tree."""
    n, rng = len(x), np.random.default_rng(7)
    found = np.full((n, 0), NONE)
    for _ in range(trees):
        leaves = _leaves(x, bucket, rng)
        near = np.full((n, width), NONE)
        for lo in range(0, len(leaves), 64):
            own = leaves[lo:lo + 64]
            d = _apart(x[own], np.where(own >= 0, sq[own], np.inf))
            m = own.shape[1]
            d[:, np.arange(m), np.arange(m)] = np.inf
            k = min(width, m)
            at = np.argpartition(d, k - 1, axis=2)[:, :, :k]
            value = _entries(np.take_along_axis(d, at, 2), own[np.arange(len(own))[:, None, None], at])
            value[~np.isfinite(np.take_along_axis(d, at, 2))] = NONE
            near[own[own >= 0], :k] = value[own >= 0]
        found = np.concatenate([found, near], axis=1)
        if found.shape[1] > width:
            found = _distinct(found)[:, :width]
    found.sort(axis=1)
    return found


def _distinct(found: np.ndarray) -> np.ndarray:
    """Rows of entries, nearest first, each place once."""
    out = np.empty_like(found)
    for lo in range(0, len(found), 4096):
        rows = found[lo:lo + 4096]
        by = np.argsort(rows & PLACE, axis=1, kind="stable")
        rows = np.take_along_axis(rows, by, 1)
        again = (rows[:, 1:] & PLACE) == (rows[:, :-1] & PLACE)
        rows[:, 1:][again] = NONE
        out[lo:lo + 4096] = np.sort(rows, axis=1)
    return out


def ranks(sorted_keys: np.ndarray) -> np.ndarray:
    """Each element's place among its equals."""
    head = np.flatnonzero(np.append(True, sorted_keys[1:] != sorted_keys[:-1]))
    return np.arange(len(sorted_keys)) - np.repeat(head, np.diff(np.append(head, len(sorted_keys))))


def _absorb(lists: np.ndarray, keys: list[np.ndarray]) -> None:
    """Put pairs (node, neighbour, distance bits as one number) into lists."""
    key = np.concatenate(keys)
    key.sort()
    first = np.ones(len(key), bool)
    first[1:] = key[1:] >> 27 != key[:-1] >> 27  # each pair once
    key = key[first]
    node, place, d = key >> (27 + BITS), key >> 27 & PLACE, key & ((1 << 27) - 1)
    fresh = d < lists[node, -1] >> (BITS + 1)
    node, place, d = node[fresh], place[fresh], d[fresh]
    fresh = np.concatenate([~((lists[node[lo:lo + 65536]] & PLACE) == place[lo:lo + 65536, None]).any(1) for lo in range(0, len(node) or 1, 65536)])
    node, place, d = node[fresh], place[fresh], d[fresh]
    if not len(node):
        return
    key = node << (27 + BITS) | d << BITS | place
    key.sort()
    node = key >> (27 + BITS)
    rank = ranks(node)
    key, node, rank = (c[rank < lists.shape[1]] for c in (key, node, rank))
    rows, at = np.unique(node, return_inverse=True)
    more = np.full((len(rows), int(rank.max()) + 1), NONE)
    more[at, rank] = (key >> BITS & ((1 << 27) - 1)) << (BITS + 1) | NEW | key & PLACE
    both = np.concatenate([lists[rows], more], axis=1)
    both.sort(axis=1)
    lists[rows] = both[:, :lists.shape[1]]


def _backwards(near: np.ndarray, rank: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(n, width) of the nodes whose lists have a node, -1 where there are
    fewer, and the places in ``near`` they came from; the lowest ``rank`` (up
    to 2**20) goes first."""
    n, wide = near.shape
    if n * wide > 1 << 25:
        raise ValueError(f"{n} lists of {wide} are too many for a key")
    key = near.ravel().astype(np.int64) << 45 | rank.ravel().astype(np.int64) << 25 | np.arange(n * wide)
    key = key[near.ravel() >= 0]
    key.sort()
    to, edge = key >> 45, key & ((1 << 25) - 1)
    place = ranks(to)
    held = place < width
    to, edge, place = to[held], edge[held], place[held]
    out, of = np.full((n, width), -1, np.int32), np.zeros((n, width), np.int32)
    out[to, place] = edge // wide
    of[to, place] = edge
    return out, of


def _round(x: np.ndarray, sq: np.ndarray, lists: np.ndarray, reverse: int, rng: np.random.Generator) -> None:
    """A node's neighbours and some of its reverse neighbours meet; pairs with
    a new member that are nearer than what either end has go to it."""
    n, width = lists.shape
    near = places(lists)
    new = (lists & NEW != 0) & (near >= 0)
    rank = rng.integers(0, 1 << 19, near.shape, dtype=np.int32) | np.where(new, 0, 1 << 19).astype(np.int32)  # new ones first
    back, of = _backwards(near, rank, reverse)
    back_new = new.ravel()[of] & (back >= 0)
    lists &= ~np.where(lists == NONE, np.int64(0), NEW)
    waiting, held = [], 0
    amount = new.sum(1) + back_new.sum(1)
    nodes = np.argsort(amount, kind="stable")  # blocks of nodes with about as many new members
    for lo in range(int((amount == 0).sum()), n, BLOCK):
        own = nodes[lo:lo + BLOCK]
        f, b, fn, bn = near[own], back[own], new[own], back_new[own]
        same = f[:, :, None] == b[:, None, :]
        fn = fn | (same & bn[:, None, :]).any(2)
        b = np.where(same.any(1), -1, b)
        who = np.concatenate([f, b], axis=1)
        fresh = np.concatenate([fn, bn & (b >= 0)], axis=1)
        by = np.argsort(~fresh, axis=1, kind="stable")  # new members first
        who, fresh = np.take_along_axis(who, by, 1), np.take_along_axis(fresh, by, 1)
        k, m = int(fresh.sum(1).max()), who.shape[1]
        y, real = x[who], who >= 0
        square = np.where(real, sq[who], np.inf)
        d = np.matmul(y[:, :k], y.transpose(0, 2, 1))
        d *= -2
        d += square[:, :k, None]
        d += square[:, None, :]
        d[~fresh[:, :k]] = np.inf
        d[:, np.arange(k), np.arange(k)] = np.inf
        far = _distance(lists[who, -1])
        for at, to, of_ in ((np.flatnonzero(d < far[:, :k, None]), 0, 1), (np.flatnonzero(d < np.where(fresh, -np.inf, far)[:, None, :]), 1, 0)):
            row = at // m
            pair = who.ravel()[row // k * m + row % k], who.ravel()[row // k * m + at % m]  # (a new member, any)
            waiting.append(pair[to].astype(np.int64) << (27 + BITS) | pair[of_].astype(np.int64) << 27 | _bits(d.ravel()[at]))
            held += len(at)
        if held >= WAITING:
            _absorb(lists, waiting)
            waiting, held = [], 0
    if held:
        _absorb(lists, waiting)


def descend(x: np.ndarray, width: int, reverse: int, trees: int, bucket: int, rounds: int, settled: float) -> np.ndarray:
    """(n, width) entries: every vector's near neighbours, nearest first, with
    NONE where there are fewer. Rounds stop when few lists change."""
    n = len(x)
    if n >= MOST:
        raise ValueError(f"a cell of {n} vectors; it must be cut below {MOST}")
    sq = (x * x).sum(1)
    lists, rng = _first_lists(x, sq, width, trees, bucket), np.random.default_rng(11)
    for _ in range(rounds if n > 2 else 0):
        _round(x, sq, lists, reverse, rng)
        if (lists & NEW != 0).sum() <= settled * width * n:
            break
    return lists


def places(lists: np.ndarray) -> np.ndarray:
    """The neighbours' places (-1: none) of lists."""
    return np.where(lists == NONE, -1, lists & PLACE).astype(np.int32)


def links(lists: np.ndarray) -> np.ndarray:
    """Each node's list and as many of its reverse neighbours, -1: none."""
    near = places(lists)
    n, width = near.shape
    order = np.minimum(np.arange(width), (1 << 20) - 1)
    back, _ = _backwards(near, np.broadcast_to(order, near.shape), width)
    for lo in range(0, n, 4096):
        part = back[lo:lo + 4096]
        part[(part[:, :, None] == near[lo:lo + 4096][:, None, :]).any(2)] = -1
    return np.concatenate([near, back], axis=1)


def greedy(x: np.ndarray, sq: np.ndarray, graph: np.ndarray, queries: np.ndarray, selves: np.ndarray, landmarks: np.ndarray,
           beam: int, expand: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, squared distances less the query's own square), nearest first
    and -1 where fewer were met, of a greedy search for a block of queries:
    each step expands the ``expand`` nearest unexpanded nodes of every query's
    beam and measures those of their neighbours that the query has not met.
    ``selves`` has the node that a query is itself (-1: none here), which is no
    answer; the search starts from the landmarks and from its neighbours."""
    b, n = len(queries), len(x)
    rows = np.arange(b)[:, None]
    shift = int(n).bit_length()  # a pair of query and node is one number; node n stands for -1
    kind = np.int32 if b << shift < 1 << 31 else np.int64
    row_at = (np.arange(b) << shift).astype(kind)
    met = np.zeros(b << shift, bool)
    met[row_at + n] = True
    met[row_at + np.where(selves < 0, n, selves)] = True
    own = np.flatnonzero(selves >= 0)
    at = np.concatenate([(row_at[:, None] + landmarks.astype(kind)).ravel(), _pairs(row_at[own], graph[selves[own]], n)])
    ids, d, done = np.full((b, beam), -1, np.int32), np.full((b, beam), np.inf, x.dtype), np.ones((b, beam), bool)
    while True:
        at = at[~met[at]]
        at.sort()
        if len(at):
            at = at[np.append(True, at[1:] != at[:-1])]
            met[at] = True
            row, new = at >> shift, at & ((1 << shift) - 1)
            value = np.empty(len(at), x.dtype)
            cuts = np.searchsorted(at, np.append(row_at, row_at[-1:] + (1 << shift) - 1))
            for q, lo, hi in zip(queries, cuts[:-1], cuts[1:]):
                if hi > lo:
                    np.matmul(x[new[lo:hi]], q, out=value[lo:hi])
            value *= -2
            value += sq[new]
            place = np.arange(len(at)) - cuts[row]
            wide = int(np.diff(cuts).max())
            more_id, more_d = np.full((b, wide), -1, np.int32), np.full((b, wide), np.inf, x.dtype)
            more_id[row, place], more_d[row, place] = new, value
            ids, d = np.concatenate([ids, more_id], 1), np.concatenate([d, more_d], 1)
            done = np.concatenate([done, more_id < 0], 1)
            top = np.argpartition(d, beam - 1, axis=1)[:, :beam]
            ids, d, done = ids[rows, top], d[rows, top], done[rows, top]
        k = min(expand, beam)
        ahead = np.argpartition(np.where(done, np.inf, d), k - 1, axis=1)[:, :k]
        live = ~done[rows, ahead]
        if not live.any():
            order = np.lexsort((ids, d), axis=1)
            return np.take_along_axis(ids, order, 1), np.take_along_axis(d, order, 1)
        r, c = np.nonzero(live)
        c = ahead[r, c]
        done[r, c] = True
        at = _pairs(row_at[r], graph[ids[r, c]], n)


def _pairs(row_at: np.ndarray, near: np.ndarray, n: int) -> np.ndarray:
    return (row_at[:, None] + np.where(near < 0, n, near).astype(row_at.dtype)).ravel()


def for_scans(x: np.ndarray, sq: np.ndarray) -> np.ndarray:
    """(n, d + 1) whose products with a query and 1 are squared distances less the query's own square."""
    return np.concatenate([-2 * x, sq[:, None]], axis=1)


def scanned(wide: np.ndarray, queries: np.ndarray, selves: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``greedy``, with all vectors measured and the ``keep`` nearest given."""
    b, n = len(queries), len(wide)
    queries = np.concatenate([queries, np.ones((b, 1), queries.dtype)], axis=1)
    bound = np.full(b, np.inf, wide.dtype)
    near = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, wide.dtype)  # (query, place, distance)
    parts, held = [near], 0
    for lo in range(0, n, SCAN):
        d = queries @ wide[lo:lo + SCAN].T
        m = d.shape[1]
        here = np.flatnonzero((selves >= lo) & (selves < lo + m))
        d[here, selves[here] - lo] = np.inf
        if not lo and m > keep:
            bound = np.partition(d, keep - 1, axis=1)[:, keep - 1]
        at = np.flatnonzero(d <= bound[:, None])
        row = at // m
        parts.append((row, at - row * m + lo, d.ravel()[at]))
        held += len(at)
        if held > 4 * b * keep or lo + SCAN >= n:
            row, place, value = (np.concatenate(c) for c in zip(*parts))
            order = np.lexsort((place, value, row))
            rank = ranks(row[order])
            order = order[(rank < keep) & np.isfinite(value[order])]
            near = row[order], place[order], value[order]
            parts, held = [near], 0
            size = np.bincount(near[0], minlength=b)
            full = size >= keep
            bound[full] = near[2][np.cumsum(size)[full] - 1]
    ids, d = np.full((b, keep), -1, np.int64), np.full((b, keep), np.inf, wide.dtype)
    rank = ranks(near[0])
    ids[near[0], rank], d[near[0], rank] = near[1], near[2]
    return ids, d
