"""N-gram Jaccard self-join of documents: a grouped prefix join.

A document's set holds its distinct shingles of ``width`` lower-cased words.
Documents link when the Jaccard similarity of their sets reaches
``percent`` / 100. The steps, all exact:

1. Texts with equal sets form one class, represented by one of them;
   everything below works on representatives, named by the hash of their text.
2. Length filter on shared shingles: in the order of the shingle hashes, two
   linked documents have their first common shingles in both extended
   prefixes, so a document with too few shingles there that any other text
   holds has no link (``exchange.shared_keys`` counts them). What is left,
   usually a few percent of the corpus, is explored further.
3. Shingles are ordered rarest first by their exact document frequency, a
   document's prefix is taken in that order, and documents with identical
   prefixes and size collapse into one group.
4. Round one: each group's members against its smallest, and in every
   prefix shingle's list all groups against the smallest group. Round two:
   pairs of groups that share a prefix shingle and still lie in different
   components; pairs inside a component could not change it. Size and
   position bounds drop group pairs before they are expanded to members and
   verified on whole sets.

Round two makes the work on a hot group (thousands of near copies) follow its
size, not its square: after round one nearly all of it is one component.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.common import components, prepare, table, write_shared
from cohortlens.llm.exchange import buckets_of, fold, pack5, shared_keys, unpack5
from cohortlens.llm.kernels import (PACKED, column, mix, pack_texts, packed_blocks, text_blocks, window_hashes,
                                    word_hashes, word_spans)

WIDTH, PERCENT = 5, 75


def _shingles(buf: np.ndarray, offs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(document index, 64-bit hash) of every shingle, repeats included; a
    document with fewer words has its whole sequence as one."""
    starts, ends, wo = word_spans(buf, offs)
    words = word_hashes(buf, starts, ends, lower=True)
    n = np.diff(wo)
    at = np.repeat(np.arange(len(n)), np.maximum(n - width + 1, 0))
    pos = np.arange(len(at)) - np.repeat(np.cumsum(np.maximum(n - width + 1, 0)) - np.maximum(n - width + 1, 0),
                                         np.maximum(n - width + 1, 0)) + wo[at]
    full = window_hashes(words, width)
    hashes = full[pos] if len(pos) else np.zeros(0, np.uint64)
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        extra = np.array([window_hashes(words[wo[i]:wo[i + 1]], int(n[i]))[0] for i in short], np.uint64)
        extra = mix(extra + n[short].astype(np.uint64))
        at, hashes = np.concatenate([at, short]), np.concatenate([hashes, extra])
    return at, hashes


def _distinct(buf: np.ndarray, offs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document index, top 48 bits, rank) of the distinct shingles, in hash
    order within each document."""
    at, hashes = _shingles(buf, offs, width)
    bits = np.uint64(max(1, int(len(offs) - 2).bit_length()))
    room = np.uint64(64) - bits
    packed = np.unique((at.astype(np.uint64) << room) | (hashes >> bits))
    at = (packed >> room).astype(np.int64)
    first = np.searchsorted(at, np.arange(len(offs)))
    value = (packed & ((np.uint64(1) << room) - np.uint64(1))) >> (room - np.uint64(48))
    return at, value, np.arange(len(at)) - first[at]


def _need(n: np.ndarray, percent: int) -> np.ndarray:
    """Common shingles that a set of n needs at least: ceil(percent * n / 100)."""
    return -(-percent * n // 100)


def shingle_sets(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, mark, n_shingles, sig_a, sig_b) per row; equal sets have equal
    signatures."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_blocks(batches):
            at, value, _ = _distinct(buf, offs, width)
            cut = np.searchsorted(at, np.arange(len(offs)))
            sums = []
            for salt in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(value ^ np.uint64(salt)))])
                sums.append((total[cut[1:]] - total[cut[:-1]]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(np.diff(cut)), pa.array(sums[0]), pa.array(sums[1])],
                names=["doc_id", "mark", "n_shingles", "sig_a", "sig_b"])

    return docs.select("doc_id", "mark", "text").mapInArrow(
        run, "doc_id long, mark long, n_shingles long, sig_a long, sig_b long")


def _full_sets(packed: DataFrame, width: int) -> DataFrame:
    """(block, rep, doc, n, tokens): the whole sets of packed texts, a block's
    rows together a few MB."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for i, (rows, buf, offs) in enumerate(packed_blocks(batches)):
            at, hashes = _shingles(buf, offs, width)
            order = np.lexsort((hashes, at))
            at, hashes = at[order], hashes[order]
            keep = np.ones(len(at), bool)
            keep[1:] = (at[1:] != at[:-1]) | (hashes[1:] != hashes[:-1])
            at, hashes = at[keep], hashes[keep]
            cut = np.searchsorted(at, np.arange(len(offs))).astype(np.int32)
            sets = pa.ListArray.from_arrays(pa.array(cut), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(rows.num_rows, task + i)), pa.array(column(rows, "mark")), pa.array(column(rows, "doc_id")),
                 pa.array(np.diff(cut).astype(np.int64)), sets], names=["block", "rep", "doc", "n", "tokens"])

    return packed.mapInArrow(run, "block long, rep long, doc long, n long, tokens array<long>")


def _lists(batch: pa.RecordBatch | pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, values) of a column of long lists."""
    col = batch.column(name)
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    offs = np.asarray(col.offsets) if len(col) else np.zeros(1, np.int32)
    return offs - offs[0], col.flatten().to_numpy(zero_copy_only=False)


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(rep, doc, n, skip, prefix): shingles in the order of their document
    frequency, rarest first; of the prefix, ``skip`` shingles that no other
    set holds are only counted. Sets whose prefix has no other are left out.

    Frequencies are summed over blocks by bucket and go back to the blocks
    that asked, so a shingle that every document holds is one entry a block.
    """
    buckets = buckets_of(sets)

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = column(batch, "block")
            offs, tokens = _lists(batch, "tokens")
            of = np.repeat(blocks, np.diff(offs))
            for block in np.unique(blocks):
                keys, counts = np.unique(fold(tokens[of == block].view(np.uint64), buckets), return_counts=True)
                bucket = (keys >> np.uint64(40)).astype(np.int64)
                cut = np.flatnonzero(np.diff(bucket)) + 1
                lows, highs = np.append(0, cut), np.append(cut, len(keys))
                if not len(keys):
                    continue
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[lows].astype(np.int32)), pa.array(np.full(len(lows), block)),
                     pa.array([pack5(keys[x:y]) for x, y in zip(lows, highs)], type=pa.binary()),
                     pa.array([counts[x:y].astype(np.uint16).tobytes() for x, y in zip(lows, highs)], type=pa.binary())],
                    names=["bucket", "block", "keys", "counts"])

    def answer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, keys, counts = [], [], []
        for batch in batches:
            for bucket, block, k, c in zip(*(x.to_pylist() for x in batch.columns)):
                keys.append(unpack5(k) | np.uint64(bucket) << np.uint64(40))
                counts.append(np.frombuffer(c, np.uint16))
                asked.append(block)
        if not keys:
            return
        size = [len(k) for k in keys]
        all_keys = np.concatenate(keys)
        own, at = np.unique(all_keys, return_inverse=True)
        df = np.bincount(at, weights=np.concatenate(counts))[at].astype(np.int64)
        of = np.repeat(np.array(asked), size)
        order = np.flatnonzero(df > 1)
        order = order[np.argsort(of[order], kind="stable")]
        of, all_keys, df = of[order], all_keys[order], df[order]
        cut = np.flatnonzero(np.diff(of)) + 1
        for lo, hi in zip(np.append(0, cut), np.append(cut, len(of))):  # one row a block
            if hi > lo:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(of[lo:lo + 1]), pa.array([all_keys[lo:hi].tobytes()], type=pa.binary()),
                     pa.array([df[lo:hi].astype(np.uint32).tobytes()], type=pa.binary())], names=["block", "keys", "dfs"])

    def rank(rows: pa.Table, answers: pa.Table) -> pa.Table:
        offs, tokens = _lists(rows, "tokens")
        n = np.diff(offs)
        keys = np.frombuffer(b"".join(answers.column("keys").to_pylist()), np.uint64)
        dfs = np.frombuffer(b"".join(answers.column("dfs").to_pylist()), np.uint32)
        order = np.argsort(keys)
        keys, dfs = keys[order], dfs[order]
        mine = fold(tokens.view(np.uint64), buckets)
        spot = np.minimum(np.searchsorted(keys, mine), max(0, len(keys) - 1))
        df = np.where(keys[spot] == mine, dfs[spot], 1) if len(keys) else np.ones(len(mine), np.int64)
        doc = np.repeat(np.arange(len(n)), n)
        order = np.lexsort((tokens, df, doc))
        doc, tokens, df = doc[order], tokens[order], df[order]
        within = np.arange(len(doc)) - np.repeat(offs[:-1], n)
        inside = (within < (n - _need(n, percent) + 1)[doc]) & (df > 1)
        skip = np.bincount(doc, weights=df == 1, minlength=len(n)).astype(np.int64)
        cut = np.searchsorted(doc[inside], np.arange(len(n) + 1)).astype(np.int32)
        out = pa.table({"rep": rows.column("rep").combine_chunks(), "doc": rows.column("doc").combine_chunks(), "n": pa.array(n.astype(np.int64)), "skip": pa.array(skip),
                        "prefix": pa.ListArray.from_arrays(pa.array(cut), pa.array(tokens[inside]))})
        return out.filter(pa.array(np.diff(cut) > 0))

    answers = (sets.select("block", "tokens").mapInArrow(send, "bucket int, block long, keys binary, counts binary")
               .repartitionById(buckets, "bucket").mapInArrow(answer, "block long, keys binary, dfs binary"))
    return (sets.groupBy("block").cogroup(answers.groupBy("block"))
            .applyInArrow(rank, "rep long, doc long, n long, skip long, prefix array<long>"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the similarity."""
    a = sets.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    b = sets.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = pairs.join(a, "a").join(b, "b").withColumn("o", F.size(F.array_intersect("ta", "tb")))
    return both.where(F.lit(100) * F.col("o") >= F.lit(percent) * (F.col("na") + F.col("nb") - F.col("o"))).select("a", "b")


def jaccard_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest
    doc_id reachable by links, its own included).

    ``docs`` has doc_id and text; further columns are ignored. A null or empty
    text has no shingles and links with nothing. Rows with a null doc_id take
    no part and have a null component_id; rows that share a doc_id are one
    node of the graph, whatever their texts. Repeated rows stay.
    """
    docs, rows, texts, edges = _linked(docs, width, percent)
    same = ["sig_a", "sig_b", "n_shingles"]
    # documents with several texts: few, found by one number a document
    several = write_shared(rows.groupBy("doc_id").agg(F.min("mark").alias("x"), F.max("mark").alias("y")).where("x <> y").select("doc_id"), "several")
    theirs = write_shared(rows.join(several, "doc_id", "left_semi").join(texts.select("mark", *same, "rep", "doc"), ["mark", *same], "left")
                          .select("doc_id", "rep").distinct(), "several")
    tied = theirs.where("rep is not null")
    tied = tied.join(tied.groupBy("doc_id").agg(F.min("rep").alias("a")), "doc_id").where("a <> rep").select("a", F.col("rep").alias("b"))
    heads = _heads(components(edges.unionByName(tied)), texts)
    placed = texts.join(heads, "rep", "left").select("mark", *same, F.coalesce("head.doc", "doc").alias("component"))
    # a document's rows without words go where its texts with words are
    theirs = theirs.join(texts.select("rep", "doc").distinct().join(heads, "rep", "left").select("rep", F.coalesce("head.doc", "doc").alias("to")), "rep")
    wordless = theirs.groupBy("doc_id").agg(F.min("to").alias("to"))
    known = rows.join(placed, ["mark", *same], "left")
    bare = known.where("n_shingles = 0").join(wordless, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("to", "doc_id").alias("component_id"))
    nodes = known.where("n_shingles > 0").select("doc_id", "n_shingles", F.col("component").alias("component_id")).unionByName(bare)
    lost = docs.where("doc_id is null").select(
        "doc_id", F.lit(0).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return nodes.unionByName(lost)


def distinct_texts(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, mark): of every group of linked texts the one with the
    smallest doc_id (ties: the smallest mark); ``mark`` is the text's xxhash64.

    Links are between texts here: rows that share a doc_id and have different
    texts are judged each by its own. A text without words is in no group and
    is returned for each doc_id that has it. Rows with a null doc_id take no
    part.
    """
    _, rows, texts, edges = _linked(docs, width, percent)
    heads = _heads(components(edges), texts)
    placed = texts.select("rep", F.struct("doc", "rep").alias("own")).distinct().join(heads, "rep", "left")
    kept = placed.select(F.coalesce("head", "own").alias("h")).distinct().select(F.col("h.doc").alias("doc_id"), F.col("h.rep").alias("mark"))
    return kept.unionByName(rows.where("n_shingles = 0").select("doc_id", "mark").distinct())


def _heads(comp: DataFrame, texts: DataFrame) -> DataFrame:
    """(rep, head): for classes that any link touches, the (doc, rep) of the
    first class of their component."""
    own = comp.join(texts.select(F.col("rep").alias("node"), "doc").distinct(), "node")
    first = own.groupBy("component").agg(F.min(F.struct("doc", F.col("node").alias("rep"))).alias("head"))
    return write_shared(own.join(first, "component").select(F.col("node").alias("rep"), "head"), "heads")


def _linked(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(rows as used, (doc_id, mark, n_shingles, signature) of those with a
    doc_id, (mark, signature, rep, doc) of each text with words, links between
    classes). ``doc`` is the smallest doc_id of a text's class, ``rep`` the mark
    of a text of that document."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    known = docs.where("doc_id is not null")
    rows = write_shared(shingle_sets(known, width), "sets")

    def extended(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, value, rank = _distinct(buf, offs, width)
        n = np.bincount(at, minlength=len(offs) - 1)
        keep = rank < (n - _need(n, percent) + n // 8 + 1)[at]
        return at[keep], mix(value[keep])

    need_shared = F.floor((F.expr(f"-floor(-{percent} * n_shingles / 100)")) / 8) + 1
    shared = shared_keys(known, extended, counted=True).groupBy("mark").agg(F.sum("shared").alias("shared"))
    same = ["sig_a", "sig_b", "n_shingles"]
    # one row a text, counted down on the map side: copies meet nowhere as rows
    texts = rows.where("n_shingles > 0").groupBy("mark", *same).agg(F.min("doc_id").alias("own"))
    classes = texts.groupBy(*same).agg(F.min(F.struct("own", "mark")).alias("first"))
    texts = write_shared(texts.join(classes, same).select("mark", *same, F.col("first.mark").alias("rep"), F.col("first.own").alias("doc")), "classes")
    live = texts.join(shared, "mark").where(F.col("shared") >= need_shared).select("rep", "doc").distinct()
    reps = live.select(F.col("doc").alias("doc_id"), F.col("rep").alias("mark"))
    packed = known.mapInArrow(pack_texts, PACKED).join(reps, ["doc_id", "mark"], "left_semi")
    sets = write_shared(_full_sets(packed.dropDuplicates(["doc_id", "mark"]), width), "shingles")
    return docs, rows, texts, _links(sets, percent)


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """Enough verified links (a, b) for the components of ``sets`` (rep, doc,
    n, tokens). Of a group, and of a shingle's list, the text of the smallest
    document is the one that the others meet first: copies are mostly younger
    than what they copy, and nearer to it than to each other."""
    prefix = write_shared(_prefixes(sets, percent), "prefixes")
    prefix = prefix.withColumn("own", F.when(F.col("skip") > 0, F.col("rep")))
    groups = write_shared(prefix.groupBy("n", "prefix", "own").agg(F.min(F.struct("doc", "rep")).alias("first"))
                          .select("n", "prefix", "own", F.col("first.rep").alias("gid"), F.col("first.doc").alias("doc")), "groups")
    alike = (F.col("p.n") == F.col("g.n")) & (F.col("p.prefix") == F.col("g.prefix")) & F.col("p.own").eqNullSafe(F.col("g.own"))
    members = write_shared(prefix.alias("p").join(groups.alias("g"), alike).select("p.rep", "g.gid", "p.n"), "members")
    posts = write_shared(groups.join(prefix.select(F.col("rep").alias("gid"), "skip"), "gid")
                         .select("gid", "doc", "n", "skip", F.posexplode("prefix").alias("at", "token"))
                         .select("gid", "doc", "n", "token", (F.col("at") + F.col("skip")).alias("pos")), "posts")

    def near(x: str, y: str) -> str:
        """Bounds on what two sets can still share from a common shingle on."""
        least = f"-floor(-{percent} * ({x}n + {y}n) / {100 + percent})"
        return f"1 + least({x}n - {x}pos, {y}n - {y}pos) - 1 >= {least}"

    hubs = posts.groupBy("token").agg(F.min(F.struct("doc", "gid", "n", "pos")).alias("h")).select(
        "token", F.col("h.gid").alias("hub"), F.col("h.n").alias("hn"), F.col("h.pos").alias("hpos"))
    first = (posts.join(hubs, "token").where("gid <> hub").where(near("", "h"))
             .select(F.col("hub").alias("a"), F.col("gid").alias("b"))
             .unionByName(members.where("rep <> gid").select(F.col("gid").alias("a"), F.col("rep").alias("b")))
             .distinct())
    one = write_shared(_verified(first, sets, percent), "links")
    comp = write_shared(components(one), "comps")
    placed = members.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select(
        "rep", "gid", F.coalesce("component", "rep").alias("comp"))
    parts = write_shared(placed.groupBy("gid", "comp").agg(F.min("rep").alias("rep")), "parts")
    lists = posts.join(parts.select("gid", "comp"), "gid")
    mixed = lists.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("token")
    lists = lists.join(mixed, "token", "left_semi")
    x = lists.select("token", *(F.col(c).alias("x" + c) for c in ("gid", "comp", "n", "pos")))
    y = lists.select("token", *(F.col(c).alias("y" + c) for c in ("gid", "comp", "n", "pos")))
    group_pairs = (x.join(y, "token").where("xcomp < ycomp").where(near("x", "y"))
                   .select("xgid", "xcomp", "ygid", "ycomp").distinct())
    inside = (placed.select(F.col("gid").alias("xgid"), F.col("comp").alias("xcomp"), F.col("rep").alias("a")),
              placed.select(F.col("gid").alias("ygid"), F.col("comp").alias("ycomp"), F.col("rep").alias("b")))
    second = group_pairs.join(inside[0], ["xgid", "xcomp"]).join(inside[1], ["ygid", "ycomp"]).select("a", "b")
    second = second.unionByName(parts.alias("p").join(parts.alias("q"), "gid").where("p.comp < q.comp")
                                .select(F.col("gid"), F.col("p.comp").alias("xcomp"), F.col("q.comp").alias("ycomp"))
                                .join(placed.select("gid", F.col("comp").alias("xcomp"), F.col("rep").alias("a")), ["gid", "xcomp"])
                                .join(placed.select("gid", F.col("comp").alias("ycomp"), F.col("rep").alias("b")), ["gid", "ycomp"])
                                .select("a", "b"))
    return one.unionByName(_verified(second, sets, percent))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 5-word shingles, 0.75."""
    return jaccard_components(table(spark, sf_dir, "documents"))
