"""Ops 4 and 5 against brute force."""

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm import embedding_dedup
from cohortlens.llm.embedding_dedup import (AUDIT_ROWS, BLOCKS, QUERY_ROWS, component_links, links_of, near_duplicates,
                                            op5_embedding_near_dedup, query_tasks)
from cohortlens.llm.hnsw import Graph
from cohortlens.llm import descent, nn_descent
from cohortlens.llm.oracles import OP5
from cohortlens.llm.nn_descent import nearest, neighbour_graph, op4_nn_descent

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("label", T.IntegerType())])


def table(seed=4, n=700, d=16, clusters=6):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d))
    for c in range(clusters):  # tight groups and exact copies
        own = rng.choice(n, 25, replace=False)
        x[own] = x[own[0]] + 0.02 * rng.standard_normal((25, d))
        x[own[20:]] = x[own[0]]
    x[7] = 3 * x[8]
    x = x.astype(np.float32)
    rows = [(int(i), [float(v) for v in x[i]], 0) for i in range(n)]
    rows[11] = (11, None, 0)
    rows[12] = (12, [0.0] * d, 0)
    rows[13] = (13, [float("nan")] + [1.0] * (d - 1), 0)
    rows[14] = (14, [None] + [1.0] * (d - 1), 0)
    rows[15] = (15, [float("inf")] + [1.0] * (d - 1), 0)
    rows[16] = (16, [1.0, 2.0], 0)
    rows[17] = (17, [], 0)
    rows.append((None, [float(v) for v in x[0]], 0))
    return rows


def usable(rows):
    d = 16
    out = {}
    for i, v, _ in rows:
        if i is None or v is None or len(v) != d or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        out[i] = np.array(v, dtype=np.float64)
    return out


def write(spark, tmp_path, rows):
    spark.createDataFrame(rows, VECTORS).repartition(4).withColumn("node", F.lit("clash")).write.parquet(f"{tmp_path}/embeddings.parquet")
    return str(tmp_path)


def test_op4_finds_the_nearest(spark, tmp_path):
    rows = table()
    out = op4_nn_descent(spark, write(spark, tmp_path, rows))
    assert [f.dataType.simpleString() for f in out.schema.fields[:4]] == ["bigint", "int", "bigint", "double"]
    got = {}
    for r in out.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    vecs = usable(rows)
    ids = np.array(sorted(vecs))
    x = np.array([vecs[i] for i in ids])
    assert sorted(got) == [i for i in ids if i % 100 == 0]
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((x - vecs[q]) ** 2).sum(1))
        d[ids == q] = np.inf
        want = ids[np.lexsort((ids, d))[:10]]
        assert [v for v, _ in found] == [v for v, _ in sorted(found, key=lambda p: (p[1], p[0]))] and len(found) == 10
        np.testing.assert_allclose([s for _, s in found], [d[ids == v][0] for v, _ in found], rtol=1e-12, atol=1e-12)
        hits += len(set(want) & {v for v, _ in found})
    assert hits >= 0.9 * 10 * len(got)


def test_op4_few_candidates_and_ties(spark):
    rows = [(0, [1.0, 0.0], 0), (5, [1.0, 0.0], 0), (3, [1.0, 0.0], 0), (9, [0.0, 1.0], 0)]
    out = nearest(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 100 == 0).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"]) for r in out] == [(1, 3), (2, 5), (3, 9)]
    assert out[2]["score"] == pytest.approx(np.sqrt(2), rel=1e-15)
    assert nearest(spark.createDataFrame(rows[:1], VECTORS), F.col("vec_id") == 0).count() == 0
    assert nearest(spark.createDataFrame([], VECTORS), F.lit(True)).count() == 0


def test_op4_one_huge_vector_and_tiny_ones(spark):
    """Recall among ordinary and among tiny vectors beside one huge vector."""
    rng = np.random.default_rng(9)
    x = rng.standard_normal((3000, 8))
    x[5] *= 1e6
    tiny = np.arange(3000) % 10 == 1
    x[tiny] *= 1e-4
    x = x.astype(np.float32)
    vectors = spark.createDataFrame([(i, x[i].tolist(), 0) for i in range(3000)], VECTORS)
    asks = [i for i in range(3000) if i % 60 in (1, 2)]
    nodes = vectors.select(F.col("vec_id").alias("node"), F.col("embedding").cast("array<double>").alias("v"))
    graph = {r["node"]: r["ids"] for r in neighbour_graph(nn_descent._quantised(nodes)).collect()}
    got = {}
    for r in nearest(vectors, (F.col("vec_id") % 60).isin(1, 2)).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits, near = {True: [], False: []}, {True: [], False: []}
    for q in asks:
        d = ((x.astype(np.float64) - x[q]) ** 2).sum(1)
        d[q] = np.inf
        want = set(np.argsort(d, kind="stable")[:10].tolist())
        hits[bool(tiny[q])].append(len(want & got[q]) / 10)
        near[bool(tiny[q])].append(len(want & set(graph[q])) / 10)
    assert all(np.mean(h) >= 0.9 for h in (*hits.values(), *near.values()))


def exact_nearest(x, q, top=10):
    d = np.sqrt(((x - x[q]) ** 2).sum(1))
    d[q] = np.inf
    return set(np.lexsort((np.arange(len(x)), d))[:top].tolist())


def test_op4_widens_until_the_audit_passes(spark, monkeypatch):
    """From a beam that is far too narrow the search goes on to wider ones, and in the end to exact scans."""
    x = np.random.default_rng(3).standard_normal((900, 24)).astype(np.float32)
    vectors = spark.createDataFrame([(i, x[i].tolist(), 0) for i in range(900)], VECTORS)
    beams, search, scan = [], nn_descent._search, []
    monkeypatch.setattr(nn_descent, "_search", lambda q, links, asked, beam: (beams.append(beam), search(q, links, asked, beam))[1])
    scanned = nn_descent._scanned
    monkeypatch.setattr(nn_descent, "_scanned", lambda nodes, asked, top: (scan.append(1), scanned(nodes, asked, top))[1])
    monkeypatch.setattr(nn_descent, "NEIGHBOURS", 4)
    monkeypatch.setattr(nn_descent, "REVERSE", 2)

    def found(**options):
        out = {}
        for r in nearest(vectors, F.col("vec_id") % 30 == 0, **options).collect():
            out.setdefault(r["query_id"], set()).add(r["vec_id"])
        return np.mean([len(exact_nearest(x.astype(np.float64), q) & got) / 10 for q, got in out.items()])

    assert found(beam=10, recall=0.9) >= 0.9 and len(beams) > 1 and beams == [10 * 2**k for k in range(len(beams))] and scan == [1]
    monkeypatch.setattr(nn_descent, "MAX_BEAM", 10)
    assert found(beam=10, recall=1.01) == 1.0 and len(scan) == 3  # the audit's scan, and that of all queries


def test_op4_failed_beams_search_the_sample_alone(spark, monkeypatch):
    """Beams that the audit turns down cost the audited queries only; the others are searched once, over several cells."""
    x = np.random.default_rng(8).standard_normal((3000, 24)).astype(np.float32)
    x[1000:2000] = x[1000] + 0.05 * x[1000:2000]  # a third in one place: its cell is cut
    vectors = spark.createDataFrame([(i, x[i].tolist(), 0) for i in range(3000)], VECTORS)
    asked, cells, search, built = [], [], nn_descent._search, nn_descent._cells
    monkeypatch.setattr(nn_descent, "_search", lambda q, links, queries, beam: (asked.append(queries.count()), search(q, links, queries, beam))[1])
    monkeypatch.setattr(nn_descent, "_cells", lambda *a: (cells.append(built(*a)), cells[-1])[1])
    for name, value in (("AUDIT", 16), ("NEIGHBOURS", 6), ("REVERSE", 2), ("CELL_ROWS", 300), ("CELL_SAMPLE", 4), ("SHARE", 4), ("LANDMARKS", 8), ("PACK", 100)):
        monkeypatch.setattr(nn_descent, name, value)
    got = {}
    for r in nearest(vectors, F.col("vec_id") % 30 == 0, beam=8).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert len(got) == 100 and all(len(g) == 10 and q not in g for q, g in got.items())
    assert np.mean([len(exact_nearest(x.astype(np.float64), q) & g) / 10 for q, g in got.items()]) >= 0.9
    assert len(asked) > 1 and set(asked) == {16} and cells[0].count > len(cells[0].centres) == 10
    rows = cells[0].rows.select("cell", F.length("nodes").alias("n")).groupBy("cell").agg(F.sum("n").alias("n")).collect()
    assert sum(r["n"] for r in rows) == 8 * 3000 and max(r["n"] for r in rows) <= 8 * 600


def test_op4_copies_and_repeated_ids(spark):
    """Rows of a repeated vec_id count once (the smaller vector), equal vectors (0.0 and -0.0 too) are listed one by one."""
    rows = [(0, [1.0, 0.0], 0), (0, [2.0, 2.0], 0), (3, [1.0, -0.0], 0), (5, [1.0, 0.0], 0), (5, [1.0, 0.0], 0), (7, [0.0, 1.0], 0), (9, [0.0, 3.0], 0),
            (9, [0.0, 2.0], 0), (11, [0.0, 0.0], 0), (11, [0.0, 5.0], 0)]
    for kind in ("array<float>", "array<double>"):
        vectors = spark.createDataFrame(rows, VECTORS).withColumn("embedding", F.col("embedding").cast(kind))
        out = [(r["rank"], r["vec_id"], r["score"]) for r in nearest(vectors, F.col("vec_id") == 5).orderBy("rank").collect()]
        assert out == [(1, 0, 0.0), (2, 3, 0.0), (3, 7, np.sqrt(2)), (4, 9, np.sqrt(5)), (5, 11, np.sqrt(26))]


def test_op4_exact_scan_beside_rounding_and_huge_numbers(spark):
    """The scan's bounds leave out none of the nearest: near copies far from the origin, ties, squares beyond numbers."""
    rng = np.random.default_rng(6)
    x = rng.standard_normal((5000, 8))
    x[:400] = 1e5 + 1e-4 * x[:400]
    x[400:500] = x[400]
    x[500:520] = 1e160 + 1e146 * x[500:520]
    nodes = spark.createDataFrame([(i, x[i].tolist()) for i in range(5000)], "node long, v array<double>").repartition(3)
    asks = [3, 399, 450, 505, 4000]
    got = {}
    for r in nn_descent._scanned(nodes, nodes.where(F.col("node").isin(asks)), 10).orderBy("query", "score", "node").collect():
        got.setdefault(r["query"], []).append((r["node"], r["score"]))
    for q in asks:
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        want = np.lexsort((np.arange(5000), d))[:10]
        assert got[q] == [(i, d[i]) for i in want]


def test_descent_kernel_against_brute_force():
    rng = np.random.default_rng(12)
    centres = rng.standard_normal((20, 16))
    x = (np.repeat(centres, 100, axis=0) + 0.3 * rng.standard_normal((2000, 16))).astype(np.float32)
    sq = (x * x).sum(1)
    d = ((x[:, None, :].astype(np.float64) - x[None]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    want = np.argsort(d, axis=1, kind="stable")
    lists = descent.descend(x, 12, 8, 4, 64, 8, 0.02)
    near = descent.places(lists)
    assert all(len(set(r)) == 12 and i not in r for i, r in enumerate(near.tolist()))
    assert np.mean([len(set(want[i, :10]) & set(near[i])) / 10 for i in range(2000)]) > 0.9
    q = np.arange(0, 2000, 7)
    found, value = descent.scanned(descent.for_scans(x, sq), x[q], q, 15)
    assert np.mean(found == want[q, :15]) > 0.99
    np.testing.assert_allclose(value + sq[q, None], np.take_along_axis(d[q], found, 1), rtol=1e-3, atol=1e-4)
    walked, _ = descent.greedy(x, sq, descent.links(lists), x[q], q, np.arange(0, 2000, 50), 40, 8)
    assert not (walked == q[:, None]).any() and np.mean([len(set(want[i, :10]) & set(w)) / 10 for i, w in zip(q, walked)]) > 0.97
    few = descent.descend(x[:1], 12, 8, 4, 64, 8, 0.02)
    assert (descent.links(few) == -1).all() and (descent.scanned(descent.for_scans(x[:3], sq[:3]), x[:1], np.array([0]), 5)[0] >= 0).sum() == 2


def test_vectors_of_several_lengths(spark):
    """Every length is a table of its own: nearest and links within it."""
    rng = np.random.default_rng(5)
    data = {i: rng.standard_normal(n) for i, n in enumerate([8] * 120 + [3] * 40 + [5] * 7 + [2])}
    for a, b in ((0, 1), (125, 126), (161, 162)):
        data[b] = data[a] * 1.001
    rows = [(i, [float(np.float32(x)) for x in v], 0) for i, v in data.items()]
    x = {i: np.array(v) for i, v, _ in rows}
    vectors = spark.createDataFrame(rows, VECTORS)
    for small in (4096, 20):  # the length of 40 exactly, or by a graph
        got = {}
        for r in nearest(vectors, F.lit(True), top=3, small=small).collect():
            got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
        for q, v in x.items():
            near = sorted((float(np.sqrt(((v - w) ** 2).sum())), i) for i, w in x.items() if i != q and len(w) == len(v))[:3]
            assert [i for _, i, _ in sorted(got.get(q, []))] == [i for _, i in near]
        out = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_duplicates(vectors, small=small).collect()}
        links = {i: [j for j, w in x.items() if j != i and len(w) == len(v) and v @ w >= 0.9 * np.sqrt((v @ v) * (w @ w))] for i, v in x.items()}
        assert {i: n for i, (n, *_) in out.items()} == {i: len(l) for i, l in links.items()}
        assert out[1][1:] == (0, False) and out[167][1:] == (167, True)
        assert all(out[j][1] == out[i][1] for i, l in links.items() for j in l)


def test_op5_links_and_components(spark, tmp_path):
    rows = table()
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"])
           for r in op5_embedding_near_dedup(spark, write(spark, tmp_path, rows)).collect()}
    vecs = usable(rows)
    ids = np.array(sorted(vecs))
    x = np.array([vecs[i] for i in ids])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    comp = ids.copy()
    while True:
        new = np.array([min(comp[k], comp[near[k]].min(initial=comp[k])) for k in range(len(ids))])
        if (new == comp).all():
            break
        comp = new
    want = {i: (int(n), int(c), bool(i == c)) for i, n, c in zip(ids, near.sum(1), comp)}
    for i, *_ in rows:
        if i not in want:
            want[i] = (0, i, i is not None)
    assert got == want


def test_op5_empty(spark):
    assert near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


def test_op5_tasks_follow_the_table():
    """A block of queries is bounded, and so is what a task streams; the index is read once a task."""
    for n in (1, 10_256, 51_282, 3_000_000, 100_000_000):
        assert n / query_tasks(n) <= QUERY_ROWS * BLOCKS and QUERY_ROWS == 32 * AUDIT_ROWS
    assert query_tasks(51_282) == query_tasks(1_000_000) == 4


def test_op5_streams_queries_in_blocks(spark, monkeypatch):
    """Results do not depend on the size of the blocks and of the Arrow batches."""
    vectors = spark.createDataFrame(table(), VECTORS)
    want = sorted(map(tuple, near_duplicates(vectors).collect()), key=repr)
    monkeypatch.setattr(embedding_dedup, "QUERY_ROWS", 37)
    monkeypatch.setattr(embedding_dedup, "BLOCKS", 2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        assert sorted(map(tuple, near_duplicates(vectors, shards=3).collect()), key=repr) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_op5_links_found_from_one_end_count_for_both(spark):
    """Counts come from the components, whoever found the links; one component
    is of many parts, one is a chain whose ends are no link."""
    rng = np.random.default_rng(2)
    hot = np.array([1.0, 0, 0, 0]) + 0.12 * rng.standard_normal((1500, 4))
    chain = np.array([[0, np.cos(t), np.sin(t), 0] for t in (0, 0.4, 0.8)])
    x = np.concatenate([hot, chain])
    copies = 1 + np.arange(len(x)) % 3
    comp = [0] * 1500 + [1500] * 3
    members = spark.createDataFrame([(i, int(copies[i]), x[i].tolist(), comp[i]) for i in range(len(x))],
                                    "rep long, copies long, v array<double>, component long")
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = (u @ u.T >= 0.9) & (np.array(comp)[:, None] == np.array(comp))
    np.fill_diagonal(near, False)
    assert {r["node"]: r["links"] for r in component_links(members, 0.9).collect()} == dict(enumerate((near @ copies).tolist()))


def test_op5_audit_leaves_out_self_hits():
    class Blind(Graph):  # finds everything but the query itself
        asked = 0

        def search(self, queries, beam):
            Blind.asked += 1
            sims = queries @ self.x.T
            return np.tile(np.arange(len(self.x)), (len(queries), 1)), np.where(sims > 0.9999, -1, sims)

    t = np.arange(12) * 0.3
    x = np.stack([np.cos(t), np.sin(t)], axis=1)
    a, b = links_of(Blind(x, np.arange(12)), x, x, 0.9, np.arange(12), np.arange(12))
    assert Blind.asked == 1 and sorted(zip(a, b)) == sorted([(i, i + 1) for i in range(11)] + [(i + 1, i) for i in range(11)])


def test_graph_reaches_isolated_clusters():
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((30, 24))
    x = np.repeat(centres, 40, axis=0) + 0.01 * rng.standard_normal((1200, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    graph = Graph(x, np.arange(1200))
    ids, _ = graph.search(x.astype(np.float32), 48)
    own = np.arange(1200) // 40
    assert np.mean([(i[:40] // 40 == c).mean() for i, c in zip(ids, own)]) > 0.99


def test_op5_planted_copies_against_sql(spark, tmp_path):
    """Groups of near copies of many sizes, over all shards, against the oracle's SQL."""
    rng = np.random.default_rng(11)
    vectors, n = [], 0
    for size in (700, 130, 40, 9, 3, 2, 2):
        base = rng.standard_normal(24)
        for _ in range(size):
            vectors.append(base + rng.standard_normal(24) * np.linalg.norm(base) / np.sqrt(24) * rng.choice([0.1, 0.3, 0.36]))
    chain = rng.standard_normal(24)
    for _ in range(30):  # each near the next, the ends not near each other
        chain = chain + rng.standard_normal(24) * 0.25
        vectors.append(chain)
    vectors += list(rng.standard_normal((400, 24)))
    order = rng.permutation(len(vectors))
    rows = [(int(i), [float(np.float32(v)) for v in vectors[k]], 0) for i, k in enumerate(order)]
    rows += [(5000, rows[0][1], 0), (5001, None, 0), (5002, [0.0] * 24, 0)]
    folder = write(spark, tmp_path, rows)
    got = sorted(map(tuple, op5_embedding_near_dedup(spark, folder).select("vec_id", "n_links", "component_id", "kept").collect()))
    con = duckdb.connect()
    con.execute(f"create view embeddings as select vec_id, embedding from read_parquet('{folder}/embeddings.parquet/*.parquet')")
    want = sorted(con.execute(OP5).fetchall())
    assert got == want
    assert sum(n > 100 for _, n, *_ in want) > 300 and sum(c != v for v, _, c, _ in want) > 700


@pytest.mark.parametrize("threshold", [0.5, 0.9, 0.999, 1.0, -0.2])
def test_op5_counts_by_bounds_are_exact(threshold):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.standard_normal((300, 6)), rng.standard_normal((1, 6)) + 0.05 * rng.standard_normal((200, 6)),
                        rng.standard_normal((1, 6)) + 0.4 * rng.standard_normal((200, 6)), np.eye(6), np.eye(6) + 1e-9])
    x = embedding_dedup._units(x)
    ids, copies = rng.permutation(len(x)) * 3, rng.integers(1, 4, len(x))
    q = np.arange(0, len(x), 2)
    got = embedding_dedup._near_counts(x[q], ids[q], x, ids, copies, threshold)
    for k, i in enumerate(q):
        near = (x[i] * x).sum(1) >= threshold
        near[i] = False
        assert got[k] == copies[near].sum()


def test_op5_a_hot_component_is_counted_in_bounded_time(spark):
    """20,000 near copies: 4e8 pairs, of which the bounds leave next to none to compare."""
    import time
    rng = np.random.default_rng(6)
    n = 20_000
    base = rng.standard_normal(32)
    v = base + 0.02 * rng.standard_normal((n, 32))
    frame = pa.table({"rep": np.arange(n), "copies": np.ones(n, np.int64), "v": list(v), "component": np.zeros(n, np.int64)})
    members = spark.createDataFrame(frame.to_pandas()).repartition(8)
    began = time.time()
    counts = component_links(members, 0.9).agg(F.count("*"), F.min("links"), F.max("links")).first()
    assert tuple(counts) == (n, n - 1, n - 1) and time.time() - began < 60
