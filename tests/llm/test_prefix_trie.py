"""Op 11 against brute force, and its general interface."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from cohortlens.llm.group_scan import scan_groups
from cohortlens.llm.prefix_trie import op11_prefix_trie, prefix_trie, shared_starts, turn_table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CONVERSATIONS = "conv_id long, turn long, role string, text string"


def conversations(seed=6):
    """Shared starts of all lengths, copies, one long pair, null and odd rows."""
    rng = random.Random(seed)
    turn = lambda: (rng.choice(["user", "bot", None, ""]), rng.choice(["a", "a b", "", None, "one two  three", "b\n"]))
    stock = [[turn() for _ in range(rng.randint(1, 20))] for _ in range(6)]
    data = {}
    for c in list(range(0, 90)) + [-1, -5, -20, -39, 1_000_003, 2_000_000]:
        if c % 17 == 3:
            continue
        own = rng.choice(stock)
        data[c] = own[:rng.randint(0, len(own))] + [turn() for _ in range(rng.randint(0, 3))]
    data[100] = data[101] = [turn() for _ in range(130)]
    data[102] = data[100][:64]
    data[103] = data[100][:120] + [("x", "the other end")]
    rows = [(c, None if i == 0 and c % 3 == 0 else i * 2, *t) for c, turns in data.items() for i, t in enumerate(turns)]
    rng.shuffle(rows)
    return rows


def ordered(rows):
    by = {}
    for c, turn, role, text in rows:
        if c is not None:
            by.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for *_, r, t in sorted(x)] for c, x in by.items()}


def rebuilt(by):
    out = {}
    for c, own in by.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = by.get(base, [])[:h] + own[h:]
    return out


def expected(by):
    members = {}
    for c, turns in by.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children, saved, leaves = {}, {}, {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node, convs in members.items():
        gain = (len(convs) - 1) * len(WORD.findall(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] = saved.get(node[:d], 0) + gain
            leaves[node[:d]] = leaves.get(node[:d], 0) + (node not in children)
    out = []
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(by[c]) == len(node))))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), children.get(node, 0), leaves[node],
                    saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark, in_folder):
    rows = conversations()
    df = spark.createDataFrame(rows, CONVERSATIONS).withColumn("nth", F.lit("clash")).withColumn("block", F.lit("clash")).repartition(7)
    assert found(op11_prefix_trie(spark, in_folder(conversations=df))) == expected(rebuilt(ordered(rows)))


def test_plain_conversations(spark):
    rows = [*conversations(8), (None, 1, "user", "nobody's"), *[(500, 1, "user", "tie"), (500, 1, "bot", "tie"), (500, 1, "bot", "tie")]]
    turns = turn_table(spark.createDataFrame(rows, CONVERSATIONS))
    trie = prefix_trie(turns, turns.select("conv_id").distinct())
    assert found(trie.drop("turn_id")) == expected(ordered(rows))


def test_rebuilt_turnless(spark):
    """A conversation whose turns are all replaced by none is a member of the root."""
    lone = next(c for c in range(1, 100) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(lone, 0, "user", "a b"), (lone, 1, "user", "c")]
    turns, convs = shared_starts(turn_table(spark.createDataFrame(rows, CONVERSATIONS)))
    assert turns.count() == 0
    ends = hashlib.sha256(str(lone).encode()).hexdigest()
    assert found(prefix_trie(turns, convs).drop("turn_id")) == [(lone, 0, None, 1, 0, 1, 0, ends)]


def test_no_conversations(spark, in_folder):
    assert found(op11_prefix_trie(spark, in_folder(conversations=spark.createDataFrame([], CONVERSATIONS)))) == []


def test_hot_conversation_and_hot_end(spark):
    """One conversation with a third of all turns, and thousands that end at one node."""
    rows = [(0, i, "user", f"turn {i % 7}") for i in range(2000)] + [(c, 0, "user", "hello") for c in range(1, 4001)]
    turns = turn_table(spark.createDataFrame(rows, CONVERSATIONS).repartition(9))
    got = {(r.conv_id, r.depth): r for r in prefix_trie(turns, turns.select("conv_id").distinct()).collect()}
    assert len(got) == 2002
    assert got[1, 1].ends_sha256 == hashlib.sha256(",".join(map(str, range(1, 4001))).encode()).hexdigest()
    assert (got[1, 1].saved_tokens, got[0, 0].n_children, got[0, 0].n_leaves, got[0, 0].saved_tokens) == (3999, 2, 2, 3999)
    assert (got[0, 2000].n_leaves, got[0, 2000].parent_conv_id, got[0, 1].n_convs) == (1, 0, 1)


@pytest.mark.parametrize("partitions", [1, 40])
def test_scan_groups(spark, partitions):
    rng = random.Random(1)
    data = [(rng.choice([1, 1, 1, 2, 3, 9]), rng.choice([None, *range(5000)]), rng.randint(-9, 9), rng.getrandbits(62)) for _ in range(3000)]
    df = spark.createDataFrame(data, "g long, o long, s long, x long").repartition(partitions)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = scan_groups(df, "g", ["o", "s", "x"], sums=("s",), xors=("x",)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    want, state = [], {}
    for g, o, s, x in sorted(data, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2], r[3])):
        n, total, xor = state.get(g, (0, 0, 0))
        state[g] = (n + 1, total + s, xor ^ x)
        want.append((g, o, s, x, *state[g]))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
