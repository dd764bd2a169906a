"""The prefix trie of conversations, by ROLLUP over positional turn columns.

A conversation becomes one row for each block of 8 turns, with the turns' ids
(MD5 of role and text, and the text's words) in 8 columns. One ``GROUP BY
block, key, ROLLUP (t0 .. t7)`` aggregates the prefixes of all lengths together;
``grouping_id`` says which length a row is. A block goes on from the trie node
where the one before ended: its rows are grouped by that node's key too (128
bits of the prefix), so long conversations take further rows, not more columns
or rounds.

Sums over a node's subtree follow from members. The words that a node's members
have from its depth on are a sum in the same ROLLUP. For the words and leaves of
the subtree's distinct nodes every node belongs to its smallest member; that
conversation has all deeper nodes of its path too, so one number a conversation
(its own nodes' words, whether its last one is a leaf), summed by a second
ROLLUP, counts every node once.

Hot groups: equal prefixes meet in partial aggregates; a conversation's turns
are numbered and summed by range partitions (``group_scan``), so one with a
third of all turns spreads over tasks; the ids that end at one node are sorted
in ranges and only short joined pieces of them reach the task that hashes them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.common import prepare, table, write_shared
from cohortlens.llm.group_scan import scan_groups
from cohortlens.llm.kernels import column

BLOCK = 8
PIECE = 500  # ids joined in one piece of a node's list

_COLUMNS = [f"t{i}" for i in range(BLOCK)]


def turn_table(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, id, words): the turns of conversations (conv_id, turn,
    role, text; other columns are ignored), numbered from 1 by turn, null
    first; equal turns by role, then by the id. ``id`` is the MD5 of role and
    text, ``words`` the number of the text's words; null role or text counts as
    empty. Rows without a conv_id are no conversation's."""
    prepare(conversations.sparkSession)
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("id"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    return scan_groups(write_shared(rows, "turns"), "conv_id", ["turn", "role", "id"]).select("conv_id", F.col("nth").alias("pos"), "id", "words")


def shared_starts(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) of the rebuilt conversations that the query is
    asked of: the first h turns of conversation c - c % 20, then c's own after
    its first h, h = CRC-32 of c, modulo 4. A conversation can end up turnless."""
    convs = turns.select("conv_id").distinct().withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4)
    convs = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % 20)
    heads = turns.where("conv_id % 20 = 0 and pos <= 3").withColumnRenamed("conv_id", "base")
    taken = convs.where("h > 0").join(heads, "base").where("pos <= h").select("conv_id", "pos", "id", "words")
    have = heads.groupBy("base").agg(F.count("*").alias("have"))
    less = (convs.where("h > 0").join(have, "base", "left").withColumn("less", F.col("h") - F.least("h", F.coalesce("have", F.lit(0))))
            .where("less > 0").select("conv_id", "less"))
    own = turns.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).where("pos > h")
    own = own.join(less, "conv_id", "left").select("conv_id", (F.col("pos") - F.coalesce("less", F.lit(0))).alias("pos"), "id", "words")
    return taken.unionByName(own), convs.select("conv_id")


def _blocks(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, block, t0 .. t7, k1, k2, ahead, last): ``k1, k2`` is the key
    of the node before the block, ``ahead`` the words from the block on,
    ``last`` whether the conversation ends here."""
    slot = (F.col("pos") - 1) % BLOCK
    turn = F.struct("id", "words")
    # a turnless row for every conversation, so that all have a first block
    rows = turns.unionByName(convs.select("conv_id", F.lit(None).cast("long").alias("pos"), F.lit(None).cast("binary").alias("id"), F.lit(0).cast("long").alias("words")))
    zero = F.lit(0).cast("long")
    wide = rows.groupBy("conv_id", F.coalesce(F.floor((F.col("pos") - 1) / BLOCK), zero).alias("block")).agg(
        *(F.max(F.when(slot == i, turn)).alias(c) for i, c in enumerate(_COLUMNS)), F.sum("words").alias("block_words"),
        *(F.coalesce(F.bit_xor(F.when(F.col("pos").isNotNull(), _hash(seed, F.col("pos"), F.col("id")))), zero).alias(f"x{seed}") for seed in (1, 2)))
    sizes = turns.groupBy("conv_id").agg(F.max("pos").alias("n_turns"), F.sum("words").alias("all_words"))
    wide = write_shared(wide.join(sizes, "conv_id", "left").withColumns({"n_turns": F.coalesce("n_turns", zero), "all_words": F.coalesce("all_words", zero)}), "blocks")
    keep = ["conv_id", "block", *_COLUMNS, "k1", "k2", "ahead", "last"]
    short = wide.where(F.col("n_turns") <= BLOCK).select("*", zero.alias("k1"), zero.alias("k2"), F.col("all_words").alias("ahead"), F.lit(True).alias("last"))
    long = scan_groups(wide.where(F.col("n_turns") > BLOCK), "conv_id", ["block"], sums=("block_words",), xors=("x1", "x2"))
    long = long.select("*", F.col("so_far_x1").bitwiseXOR(F.col("x1")).alias("k1"), F.col("so_far_x2").bitwiseXOR(F.col("x2")).alias("k2"),
                       (F.col("all_words") - F.col("so_far_block_words") + F.col("block_words")).alias("ahead"),
                       (F.col("block") == F.floor((F.col("n_turns") - 1) / BLOCK)).alias("last"))
    return short.select(*keep).unionByName(long.select(*keep))


def _hash(seed: int, pos: Column, turn_id: Column) -> Column:
    return F.xxhash64(F.lit(seed), pos.cast("long"), turn_id)


def _key(seed: int, upto: Column) -> Column:
    """The key of the node after the first ``upto`` turns of a block."""
    out = F.col(f"k{seed}")
    for i, c in enumerate(_COLUMNS):
        h = _hash(seed, F.col("block") * BLOCK + i + 1, F.col(f"{c}.id"))
        out = out.bitwiseXOR(F.when((F.lit(i) < upto) & F.col(c).isNotNull(), h).otherwise(F.lit(0).cast("long")))
    return out


def _rollup(rows: DataFrame, aggregates: str) -> DataFrame:
    """All prefixes of the blocks: ``block, k1, k2, t0 .. t7``, ``level`` (how
    many of the columns count) and the aggregates. A prefix that ends after no
    turn belongs to the block before, but for the root."""
    names = ", ".join(_COLUMNS)
    found = rows.sparkSession.sql(
        f"select block, k1, k2, {names}, cast({BLOCK} - bit_count(grouping_id()) as int) as level, {aggregates} "
        f"from {{rows}} group by block, k1, k2, rollup({names})", rows=rows)
    ends = F.element_at(F.array(*(F.col(c).isNotNull() for c in _COLUMNS)), F.greatest("level", F.lit(1)))
    return found.where(F.when(F.col("level") == 0, F.col("block") == 0).otherwise(ends))


def _digests(ends: DataFrame) -> DataFrame:
    """(k1, k2, digest): SHA-256 of the comma-joined ascending conv_ids of
    rows (k1, k2, conv_id)."""

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2, conv = (column(batch, c) for c in ("k1", "k2", "conv_id"))
            out, lo = [], 0
            for at in range(1, len(k1) + 1):
                if at == len(k1) or k1[at] != k1[lo] or k2[at] != k2[lo] or at - lo == PIECE:
                    out.append((int(k1[lo]), int(k2[lo]), int(conv[lo]), ",".join(map(str, conv[lo:at].tolist()))))
                    lo = at
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=["k1", "k2", "first", "piece"])

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state, done = None, None, []
        for batch in batches:
            for k1, k2, _, piece in zip(*(c.to_pylist() for c in batch.columns)):
                if (k1, k2) == own:
                    state.update(b",")
                else:
                    if own:
                        done.append((*own, state.hexdigest()))
                    own, state = (k1, k2), hashlib.sha256()
                state.update(piece.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], names=["k1", "k2", "digest"])
                done = []
        if own:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*own, state.hexdigest())], names=["k1", "k2", "digest"])

    order = ["k1", "k2", "conv_id"]
    cut = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pieces, "k1 long, k2 long, first long, piece string")
    return (cut.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first")
            .mapInArrow(digest, "k1 long, k2 long, digest string"))


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations ``convs`` (conv_id,
    each once) with ``turns`` (conv_id, pos from 1 without gaps, id, words; as
    ``turn_table`` gives them): conv_id (smallest member), depth,
    parent_conv_id (null for the root), n_convs, n_children, n_leaves,
    saved_tokens (words that sharing the subtree's nodes saves), ends_sha256
    (of the comma-joined ids of the members that end here), turn_id (id of the
    last turn; null for the root).

    Conversations without turns are members of the root alone. Equal
    conversations share all their nodes. Without conversations there are no rows.
    """
    prepare(turns.sparkSession)
    rows = write_shared(_blocks(turns, convs), "paths")
    found = _rollup(rows, "count(*) as n_convs, sum(ahead) as ahead, min(struct(conv_id, ahead)) as own")
    level = F.col("level")
    before = sum((F.when(F.lit(i + 1) < level, F.col(f"{c}.words")).otherwise(F.lit(0)) for i, c in enumerate(_COLUMNS)), F.lit(0).cast("long"))
    last = F.element_at(F.array(*_COLUMNS), F.greatest(level, F.lit(1)))
    nodes = write_shared(found.select(
        (F.col("block") * BLOCK + level).alias("depth"), *(_key(s, level).alias(f"k{s}") for s in (1, 2)),
        *(F.when((level > 0), _key(s, level - 1)).alias(f"p{s}") for s in (1, 2)),
        F.col("own.conv_id").alias("conv_id"), "n_convs", (F.col("ahead") - F.col("n_convs") * before).alias("member_words"),
        (F.col("own.ahead") - before).alias("own_words"), F.when(level > 0, last["words"]).otherwise(F.lit(0)).alias("words"),
        F.when(level > 0, last["id"]).alias("turn_id")), "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    nodes = write_shared(nodes.join(children, ["k1", "k2"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "nodes")
    # what a conversation has of its own: the nodes of which it is the smallest member
    own = nodes.groupBy("conv_id").agg(F.sum("words").alias("own"), F.max(F.struct("depth", F.col("n_children") == 0)).alias("end"))
    own = own.select("conv_id", "own", F.col("end.col2").cast("long").alias("leaf"))
    below = _rollup(rows.join(own, "conv_id"), "sum(own) as below, sum(leaf) as n_leaves, min(struct(conv_id, own)).own as top")
    below = below.select(*(_key(s, level).alias(f"k{s}") for s in (1, 2)), "n_leaves", (F.col("below") - F.col("top")).alias("below"))
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    ends = _digests(rows.where("last").select(*(_key(s, F.lit(BLOCK)).alias(f"k{s}") for s in (1, 2)), "conv_id"))
    return (nodes.join(below, ["k1", "k2"]).join(ends, ["k1", "k2"], "left").join(parents, ["p1", "p2"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                    (F.col("member_words") - F.col("own_words") - F.col("below")).alias("saved_tokens"),
                    F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "turn_id"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, after ``shared_starts``."""
    return prefix_trie(*shared_starts(turn_table(table(spark, sf_dir, "conversations")))).drop("turn_id")
