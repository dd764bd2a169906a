"""Approximate nearest neighbours: NN-descent and greedy graph search.

Nodes are dealt to cells, each node to its nearest centre (k-means over a
hashed sample; a cell that came out too large is cut at random), about
``CELL_ROWS`` of them each. In a cell the neighbour graph starts from leaves of
random projection trees and improves by rounds: a node's neighbours and a
bounded sample of its reverse neighbours meet, every pair of them with a new
member is a neighbour of a neighbour, and pairs nearer than what either end
has go to it. Rounds stop when few lists change (``descent``). Distances inside
the rounds use vectors quantised to bytes, each on its own scale, which is
kept; nothing but candidates depends on them.

Queries search the graphs of their nearest cells greedily with a beam: each
step expands the nearest unexpanded nodes of a query's beam and measures those
of their neighbours that the query has not met yet, by their quantised vectors.
A query starts from a fixed number of landmarks a cell and, being a row of the
table, from its own neighbours. The cells share the beam. The nearest nodes of
all of a query's beams are measured in double precision on the original
vectors. Equal vectors are one node; the answer lists their ids.

A hashed sample of the queries is compared with an exact scan of all vectors.
Its neighbours' cells say how many cells a query must ask. Below ``RECALL`` the
sample searches again with twice the beam, and all queries with the first beam
that passes; beyond ``MAX_BEAM`` all are answered by exact scans, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.llm import descent
from cohortlens.llm.common import drop_shared, partitions, prepare, table, write_shared
from cohortlens.llm.exchange import packed_schema
from cohortlens.llm.kernels import mix
from cohortlens.llm.vectors import SMALL, classes_by_hash, lengths, matrix, usable_once

NEIGHBOURS, REVERSE = 24, 16
TREES, BUCKET = 4, 128
ROUNDS, SETTLED = 8, 0.02
CELL_ROWS, MIN_CELLS, MIN_CELL_ROWS = 1 << 16, 6, 2048  # nodes of a cell; small tables have fewer, down to one cell
CELL_SAMPLE, CELL_STEPS = 64, 10                        # nodes a centre that k-means sees, and its steps
PACK = 1 << 14                                          # nodes in one row of the index
LANDMARKS, BEAM, EXPAND, MAX_BEAM = 256, 384, 32, 3072
TOGETHER, MEASURED, CLOSE = 256, 32, 4  # queries that search together; nodes that a query measures exactly, at least; its cells that may have all
SHARE, SCAN_ALL = 64, 2048               # a cell's beam at least, where a query asks several; nodes measured in the time of a beam's node
AUDIT, RECALL = 128, 0.95  # queries that are audited, and the share of their nearest that must be found
SCAN_ROWS = 256            # queries that an exact scan takes along at once
QUERY_EVERY, TOP = 100, 10
INDEX = "cell int, part int, nodes binary, q binary, links binary"
FOUND = "bucket int, queries binary, ids binary, d binary"


def _codes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(codes as float32, scales) of a list of ``q`` values."""
    rows = np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1)
    return rows[:, 8:].view(np.int8).astype(np.float32), np.ascontiguousarray(rows[:, :8]).view(np.float64)[:, 0]


def _quantised(nodes: DataFrame) -> DataFrame:
    """(node, q binary): a scale (8 bytes: the vector's largest component as a
    share of the table's, by 127) and the components as bytes on that scale."""
    top = nodes.agg(F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))).alias("m")).first()["m"] or 1.0

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column(1))
            own = np.abs(v).max(axis=1, initial=0)
            codes = np.rint(v / own[:, None] * 127).astype(np.int8)
            packed = [s.tobytes() + c.tobytes() for s, c in zip(own / top / 127, codes)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, type=pa.binary())], names=["node", "q"])

    return nodes.select("node", "v").mapInArrow(run, "node long, q binary")


def _vectors(codes: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Quantised vectors as numbers; in double precision where their lengths
    are too unlike for squares in single precision."""
    wide = len(scale) and scale.min() < 1e-15 * scale.max()
    return codes * scale.astype(np.float64 if wide else np.float32)[:, None]


@dataclass
class Cells:
    """``rows``: INDEX, written. A centre's cells are ``first[i]`` up to
    ``first[i + 1]``. ``probes``: the centres whose cells a query asks;
    ``measured``: the nodes that it measures exactly; ``walks``: the beam up to
    which no cell is scanned."""

    rows: DataFrame
    centres: np.ndarray
    first: np.ndarray
    probes: int
    measured: int
    walks: int = BEAM

    def share(self, beam: int) -> int:
        """A cell's part of a beam."""
        return max(-(-beam // self.probes), min(beam, SHARE))

    @property
    def count(self) -> int:
        return int(self.first[-1])


def _nearest_centres(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances to the centres, less the vectors' own squares."""
    return (centres * centres).sum(1) - 2 * (x @ centres.T)


def _centres(q: DataFrame, n: int) -> np.ndarray:
    """Centres by k-means over a hashed sample of bounded size a centre."""
    k = max(1, -(-n // CELL_ROWS), min(MIN_CELLS, n // MIN_CELL_ROWS))
    rows = q.orderBy(F.xxhash64("node", F.lit("cell")), "node").limit(CELL_SAMPLE * k).collect()
    x = _vectors(*_codes([bytes(r["q"]) for r in rows])).astype(np.float64)
    centres = x[:k].copy()
    for _ in range(CELL_STEPS if k > 1 else 0):
        of = _nearest_centres(x, centres).argmin(1)
        size = np.bincount(of, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, of, x)
        centres[size > 0] = total[size > 0] / size[size > 0, None]
    return centres


def _dealt(q: DataFrame, centres: np.ndarray) -> DataFrame:
    """(node, q, centre): every node's nearest centre."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _vectors(*_codes(batch.column(1).to_pylist())).astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(_nearest_centres(x, centres).argmin(1).astype(np.int32))],
                                             names=["node", "q", "centre"])

    return q.select("node", "q").mapInArrow(run, "node long, q binary, centre int")


def _cell(node: np.ndarray, centre: np.ndarray, first: np.ndarray) -> np.ndarray:
    parts = np.diff(first)[centre]
    return (first[centre] + (mix(node.astype(np.uint64)) % parts.astype(np.uint64)).astype(np.int64)).astype(np.int32)


def _packed(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(nodes, codes, scales, links) of a cell from its index rows (part, nodes, q, links)."""
    parts = sorted(parts, key=lambda r: r[0])
    nodes = np.frombuffer(b"".join(r[1] for r in parts), np.int64)
    rows = np.frombuffer(b"".join(r[2] for r in parts), np.uint8).reshape(len(nodes), -1)
    codes, scale = rows[:, 8:].view(np.int8).astype(np.float32), np.ascontiguousarray(rows[:, :8]).view(np.float64)[:, 0]
    return nodes, codes, scale, np.frombuffer(b"".join(r[3] for r in parts), np.int32).reshape(len(nodes), -1)


def _cells(q: DataFrame, top: int = TOP, rounds: int = ROUNDS) -> Cells:
    """The neighbour graphs of the cells of quantised nodes (node, q), with
    every node's list and as many reverse neighbours."""
    n = q.count()
    centres = _centres(q, n) if n else np.zeros((1, 1))
    sizes = np.zeros(len(centres), np.int64)
    dealt = _dealt(q, centres)
    for r in dealt.groupBy("centre").count().collect():
        sizes[r["centre"]] = r["count"]
    most = min(descent.MOST - 1, CELL_ROWS + CELL_ROWS // 2)
    # parts are dealt by hash: a little room for uneven ones
    first = np.concatenate([[0], np.cumsum(np.maximum(1, -(-sizes // most)))]).astype(np.int64)
    settings = (NEIGHBOURS, REVERSE, TREES, BUCKET, rounds, SETTLED)

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = _cell(batch.column(0).to_numpy(), batch.column(2).to_numpy(), first)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell)], names=["node", "q", "cell"])

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        rows = pa.Table.from_batches(parts).sort_by("node")
        raw, nodes, cell = rows.column("q").to_pylist(), rows.column("node").to_numpy(), rows.column("cell")[0].as_py()
        graph = descent.links(descent.descend(_vectors(*_codes(raw)), *settings))
        for part, lo in enumerate(range(0, len(nodes), PACK)):
            hi = lo + PACK
            yield pa.RecordBatch.from_pylist([{"cell": cell, "part": part, "nodes": nodes[lo:hi].tobytes(), "q": b"".join(raw[lo:hi]),
                                               "links": graph[lo:hi].tobytes()}], schema=index)

    index = packed_schema(INDEX)
    rows = dealt.mapInArrow(deal, "node long, q binary, cell int").repartitionById(int(first[-1]), "cell").mapInArrow(build, INDEX)
    return Cells(write_shared(rows, "nnd-cells"), centres, first, len(centres), max(MEASURED, 2 * top))


def neighbour_graph(q: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(node, ids): the near neighbours of quantised nodes (node, q) in their
    cells, nearest first."""
    cells, width = _cells(q, rounds=rounds), NEIGHBOURS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns[1:]))]
        if parts:
            nodes, _, _, graph = _packed(parts)
            for lo in range(0, len(nodes), 10_000):
                ids = [nodes[g[g >= 0]] for g in graph[lo:lo + 10_000, :width]]
                yield pa.RecordBatch.from_arrays([pa.array(nodes[lo:lo + 10_000]), pa.array(ids, type=pa.list_(pa.int64()))], names=["node", "ids"])

    return cells.rows.repartitionById(cells.count, "cell").mapInArrow(run, "node long, ids array<long>")


def _beams(q: DataFrame, links: Cells, queries: DataFrame, beam: int) -> DataFrame:
    """(query, ids): the nearest nodes of each query's beams when no node of
    them is unexpanded. Distances are those of the quantised vectors (node, q).
    A beam wider than the first so wide that measuring a whole cell takes less
    time does that."""
    centres, first, probes, count, measured = links.centres, links.first, links.probes, links.count, links.measured
    share, keep, walks = links.share(beam), min(beam, links.measured), beam <= links.walks
    marks, expand, scan, together, close = LANDMARKS, EXPAND, SCAN_ALL, TOGETHER, CLOSE
    buckets = partitions(q.sparkSession)
    index, given = packed_schema(INDEX), packed_schema(FOUND)

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A packed row (part -1, links: ranks of the centres) for each cell that any of a batch's queries asks."""
        for batch in batches:
            raw, node = batch.column(1).to_pylist(), batch.column(0).to_numpy()
            if not raw:
                continue
            x = _vectors(*_codes(raw)).astype(np.float64)
            near = np.argsort(_nearest_centres(x, centres), axis=1, kind="stable")[:, :probes]
            size = np.diff(first)[near.ravel()]
            row = np.repeat(np.repeat(np.arange(len(node)), near.shape[1]), size)
            rank = np.repeat(np.tile(np.arange(near.shape[1], dtype=np.int32), len(node)), size)
            cell = np.repeat(first[near.ravel()] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            order = np.argsort(cell, kind="stable")
            codes = np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1)
            cuts = np.flatnonzero(np.append(True, np.diff(cell[order]) != 0))
            for lo, hi in zip(cuts, np.append(cuts[1:], len(order))):
                own = order[lo:hi]
                yield pa.RecordBatch.from_pylist([{"cell": int(cell[own[0]]), "part": -1, "nodes": node[row[own]].tobytes(),
                                                   "q": codes[row[own]].tobytes(), "links": rank[own].tobytes()}], schema=index)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, asked = [], []
        for batch in batches:
            for _, part, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                (parts if part >= 0 else asked).append((part, *rest))
        if not parts or not asked:
            return
        nodes, codes, scale, graph = _packed(parts)
        parts.clear()
        node, own, own_scale, rank = _packed(asked)
        both = _vectors(np.concatenate([codes, own]), np.concatenate([scale, own_scale]))
        del codes, own
        x, vectors, rank = both[:len(nodes)], both[len(nodes):], rank[:, 0]
        sq = (x * x).sum(1)
        at = np.minimum(np.searchsorted(nodes, node), len(nodes) - 1)
        selves = np.where(nodes[at] == node, at, -1)
        landmarks = np.unique(np.linspace(0, len(nodes) - 1, min(marks, len(nodes))).astype(np.int64))
        greedy = walks or share * scan < len(nodes)
        wide = None if greedy else descent.for_scans(x, sq)
        out, held = [], 0
        for lo in range(0, len(node), together):
            part = slice(lo, lo + together)
            if greedy:
                found, d = descent.greedy(x, sq, graph, vectors[part], selves[part], landmarks, share, expand)
            else:
                found, d = descent.scanned(wide, vectors[part], selves[part], measured)
            few = np.where(rank[part] < close, measured, -(-measured // 2))  # a far cell has fewer of the nearest
            i, j = np.nonzero((found >= 0) & (np.arange(found.shape[1]) < few[:, None]))
            out.append((node[part][i], nodes[found[i, j]], d[i, j].astype(np.float32)))
            held += len(i)
            if held >= 1 << 20 or lo + together >= len(node):
                yield from _by_bucket(*(np.concatenate(c) for c in zip(*out)), buckets, given)
                out, held = [], 0

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns[1:]))]
        if not parts:
            return
        query, ids, d = (np.frombuffer(b"".join(c), kind) for c, kind in zip(zip(*parts), (np.int64, np.int64, np.float32)))
        order = np.lexsort((ids, d, query))
        order = order[descent.ranks(query[order]) < keep]
        query, ids = query[order], ids[order]
        of, start = np.unique(query, return_index=True)
        cuts = np.append(start, len(ids))
        for lo in range(0, len(of), 10_000):
            hi = min(lo + 10_000, len(of))
            lists = pa.ListArray.from_arrays((cuts[lo:hi + 1] - cuts[lo]).astype(np.int32), pa.array(ids[cuts[lo]:cuts[hi]]))
            yield pa.RecordBatch.from_arrays([pa.array(of[lo:hi]), lists], names=["query", "ids"])

    asks = queries.select("node").join(q, "node").select("node", "q").mapInArrow(ask, INDEX)
    found = links.rows.unionByName(asks).repartitionById(count, "cell").mapInArrow(search, FOUND)
    return found.repartitionById(buckets, "bucket").mapInArrow(merge, "query long, ids array<long>")


def _by_bucket(query: np.ndarray, ids: np.ndarray, d: np.ndarray, buckets: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Findings as packed rows, one a bucket of queries."""
    if not len(query):
        return
    bucket = (mix(query.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0))
    yield pa.RecordBatch.from_pylist([{"bucket": int(bucket[order[lo]]), "queries": query[order[lo:hi]].tobytes(), "ids": ids[order[lo:hi]].tobytes(),
                                       "d": d[order[lo:hi]].tobytes()} for lo, hi in zip(cuts, np.append(cuts[1:], len(order)))], schema=schema)


def _search(q: DataFrame, links: Cells, queries: DataFrame, beam: int) -> DataFrame:
    """The beams of audited queries."""
    return _beams(q, links, queries, beam)


def _measured(beams: DataFrame, nodes: DataFrame, asked: DataFrame, top: int) -> DataFrame:
    """(query, node, score): the ``top`` nearest of every beam, in double precision."""
    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gap = matrix(batch.column("v")) - matrix(batch.column("own"))
            yield pa.RecordBatch.from_arrays([batch.column("query"), batch.column("node"), pa.array(np.sqrt((gap * gap).sum(1)))],
                                             names=["query", "node", "score"])

    pairs = beams.select("query", F.explode("ids").alias("node")).join(nodes.select("node", "v"), "node")
    pairs = pairs.join(asked.select(F.col("node").alias("query"), F.col("v").alias("own")), "query")
    found = pairs.select("query", "node", "v", "own").mapInArrow(measure, "query long, node long, score double")
    best = W.partitionBy("query").orderBy("score", "node")
    return found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= top).drop("r")


def _scanned(nodes: DataFrame, queries: DataFrame, top: int) -> DataFrame:
    """(query, node, score) by exact scans: every block of the queries (a
    bounded number, fetched in turn) goes over all nodes, each task keeps a
    query's ``top`` nearest, and these meet."""
    out = None
    blocks = max(1, -(-queries.count() // SCAN_ROWS))
    dealt = queries.select("node", "v", F.pmod(F.xxhash64("node"), F.lit(blocks)).alias("block"))
    for block in range(blocks):
        rows = dealt.where(F.col("block") == block).select("node", "v").collect()
        if not rows:
            continue
        ids, v = np.array([r["node"] for r in rows], np.int64), np.array([r["v"] for r in rows], np.float64)

        def scan(batches: Iterable[pa.RecordBatch], ids=ids, v=v) -> Iterator[pa.RecordBatch]:
            near_d, near_id = np.full((len(ids), top), np.inf), np.full((len(ids), top), -1, np.int64)
            own_sq = (v * v).sum(1)
            for batch in batches:
                rows, node = matrix(batch.column("v")), batch.column("node").to_numpy()
                for lo in range(0, len(node), 2048):
                    x, own = rows[lo:lo + 2048], node[lo:lo + 2048]
                    sq = (x * x).sum(1)
                    about = own_sq[:, None] + sq - 2 * (v @ x.T)
                    room = 1e-9 * (own_sq[:, None] + sq)  # far above their rounding
                    about[ids[:, None] == own] = np.inf
                    bound = near_d[:, -1:] ** 2
                    if np.isinf(bound).any() and len(own) >= top:
                        bound = np.minimum(bound, np.partition(about + room, top - 1, axis=1)[:, top - 1:top])
                    # where squares are too large for numbers, what is not surely farther is measured
                    at = np.flatnonzero(~(about - room > bound * (1 + 1e-9)))
                    for k in range(0, len(at), 65536):
                        i, j = np.divmod(at[k:k + 65536], len(own))
                        gap = x[j] - v[i]
                        d = np.sqrt((gap * gap).sum(1))
                        d[ids[i] == own[j]] = np.inf
                        who = np.append(np.repeat(np.arange(len(ids)), top), i)
                        all_d, all_id = np.append(near_d, d), np.append(near_id, own[j])
                        order = np.lexsort((all_id, all_d, who))
                        order = order[descent.ranks(who[order]) < top]
                        near_d, near_id = all_d[order].reshape(-1, top), all_id[order].reshape(-1, top)
            keep = np.isfinite(near_d)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, keep.sum(1))), pa.array(near_id[keep]), pa.array(near_d[keep])],
                                             names=["query", "node", "score"])

        part = nodes.select("node", "v").mapInArrow(scan, "query long, node long, score double")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return nodes.sparkSession.createDataFrame([], "query long, node long, score double")
    best = W.partitionBy("query").orderBy("score", "node")
    return out.withColumn("r", F.row_number().over(best)).where(F.col("r") <= top).drop("r")


def _recall(found: DataFrame, exact: DataFrame) -> float:
    """The share of ``exact`` (query, node, score) that ``found`` has."""
    hits = exact.join(found.select("query", "node", F.lit(1).alias("hit")), ["query", "node"], "left")
    row = hits.agg(F.count("*").alias("wanted"), F.count("hit").alias("hits")).first()
    return row["hits"] / row["wanted"] if row["wanted"] else 1.0


def _ranks_asked(cells: Cells, q: DataFrame, asked: DataFrame, exact: DataFrame) -> np.ndarray:
    """For all neighbours in ``exact`` (of a bounded number of queries), how
    many centres are nearer to the query than the neighbour's own, sorted."""
    of = _dealt(q.join(exact.select("node").distinct(), "node"), cells.centres).select("node", "centre")
    wanted = exact.join(of, "node").groupBy(F.col("query").alias("node")).agg(F.collect_list("centre").alias("of"))
    ranks = [np.zeros(0, np.int64)]
    for r in asked.select("node").join(wanted, "node").join(q, "node").select("q", "of").collect():
        near = _nearest_centres(_vectors(*_codes([bytes(r["q"])])).astype(np.float64), cells.centres)[0]
        ranks.append(np.argsort(np.argsort(near, kind="stable"), kind="stable")[r["of"]])
    return np.sort(np.concatenate(ranks))


def _probes(ranks: np.ndarray, share: float) -> int:
    """How many centres a query must ask so that ``share`` of the neighbours are in their cells."""
    return int(ranks[max(0, min(len(ranks), int(np.ceil(len(ranks) * share))) - 1)]) + 1 if len(ranks) else 1


def _found(nodes: DataFrame, asked: DataFrame, top: int, beam: int, recall: float) -> DataFrame:
    """(query, node, score): the ``top`` nearest other nodes found for every
    node of ``asked``."""
    if not asked.take(1):
        return _scanned(nodes, asked, top)
    q, asked = write_shared(_quantised(nodes), "nnd-bytes"), write_shared(asked, "nnd-asked")
    cells = _cells(q, top)
    sample = write_shared(asked.orderBy(F.xxhash64("node", F.lit("audit")), "node").limit(AUDIT), "nnd-sample")  # a bounded sample by hash
    exact = write_shared(_scanned(nodes, sample, top), "nnd-audit")
    ranks, missed = _ranks_asked(cells, q, sample, exact), max(0.0, 1 - recall)
    cells.probes = _probes(ranks, 1 - missed / 2)
    cells.walks = beam = max(beam, SHARE * cells.probes) if cells.probes > 1 else beam
    missed *= 0.8  # of cells that are scanned nothing else is missed
    while beam <= MAX_BEAM * cells.probes:
        found = write_shared(_measured(_search(q, cells, sample, beam), nodes, sample, top), "nnd-found")
        if _recall(found, exact) >= recall:
            rest = asked.join(sample.select("node"), "node", "left_anti")
            if not rest.take(1):
                return found
            return found.unionByName(write_shared(_measured(_beams(q, cells, rest, beam), nodes, rest, top), "nnd-found"))
        drop_shared(found)
        beam, cells.probes, missed = 2 * beam, _probes(ranks, 1 - missed), missed / 2
    return _scanned(nodes, asked, top)


def nearest(vectors: DataFrame, query: Column, top: int = TOP, beam: int = BEAM, recall: float = RECALL, small: int = SMALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` nearest other rows found
    for every row of ``vectors`` (vec_id, embedding) for which ``query`` holds.

    Score is the Euclidean distance in double precision; ties go to the
    smaller vec_id. Rows with a null vec_id and vectors that are null, zero or
    hold null or non-finite components take no part. Only vectors of one
    length have a distance, so each length is searched by itself: by the graph,
    or, other lengths than the most common one with at most ``small`` vectors,
    exactly. With fewer candidates than ``top`` all are returned.
    """
    prepare(vectors.sparkSession)
    usable = write_shared(usable_once(vectors).withColumn("asks", F.coalesce(query, F.lit(False))), "vectors")
    many, rest = lengths(usable, small)
    rest = write_shared(rest.select("length", "vec_id", "v", "asks"), "vectors-rest")
    parts = [_nodes(usable.where(F.size("v") == n)) for n in many]
    drop_shared(usable)
    pairs = rest.groupBy("length").applyInArrow(_exact(top), "query_id long, vec_id long, score double")
    for nodes, of in parts:
        pairs = pairs.unionByName(_pairs(nodes, of, lambda nodes, asked: _found(nodes, asked, top, beam, recall), top))
    best = W.partitionBy("query_id").orderBy("score", "vec_id")
    return pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _exact(top: int):
    """All of a few vectors of one length against each other."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("vec_id")
        ids, v = rows.column("vec_id").to_numpy(), matrix(rows.column("v"))
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for i in np.flatnonzero(rows.column("asks").to_numpy()):
            gap = v - v[i]
            d = np.sqrt((gap * gap).sum(1))
            d[i] = np.inf
            order = np.lexsort((ids, d))[:min(top, len(ids) - 1)]
            out.append((np.full(len(order), ids[i]), ids[order], d[order]))
        query, vec, score = (np.concatenate(x) for x in zip(*out))
        return pa.table({"query_id": query, "vec_id": vec, "score": score})

    return run


def _nodes(usable: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, v, asks, alone) and, of vectors that others equal, (vec_id, node, asks)."""
    nodes, of = classes_by_hash(usable)
    return write_shared(nodes, "nodes"), write_shared(of, "vector-classes")


def _pairs(nodes: DataFrame, of: DataFrame, found, top: int) -> DataFrame:
    """(query_id, vec_id, score) of vectors of one length: ``found`` gives
    each asked node's nearest nodes, whose members are listed."""
    asked = nodes.where("asks").select("node", "v")
    ranked = W.partitionBy("node").orderBy("vec_id")
    # of equal vectors an answer can hold top + 1 at most (one may be the query)
    ids = of.withColumn("r", F.row_number().over(ranked)).where(F.col("r") <= top + 1).groupBy("node").agg(
        F.sort_array(F.collect_list("vec_id")).alias("members"))
    near = found(nodes.select("node", "v"), asked).unionByName(asked.select(F.col("node").alias("query"), "node", F.lit(0.0).alias("score")))
    listed = near.join(ids, "node", "left").select("query", "score", F.explode(F.coalesce("members", F.array("node"))).alias("vec_id"))
    alone = nodes.where("asks and alone").select(F.col("node").alias("query_id"), F.col("node").alias("query"))
    asking = alone.unionByName(of.where("asks").select(F.col("vec_id").alias("query_id"), F.col("node").alias("query")))
    return asking.join(listed, "query").where("query_id <> vec_id").select("query_id", "vec_id", "score")


def op4_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest of every hundredth embedding."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0)
