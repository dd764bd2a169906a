"""Op 12 against brute force, and its general interface."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm.automaton import Automaton, Lookup
from cohortlens.llm.decontaminate import clean_documents, contamination, op12_benchmark_decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {i: i + 32 for i in range(65, 91)}
ITEMS = "item_id string, text string"


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def expected(docs, items, window):
    """(doc_id, n_words, hit ranges, items) by comparing every window."""
    held = {}
    for item, text in items:
        w = tuple(words(text))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            held.setdefault(w[k:k + window], set()).add(item)
    sizes = sorted({len(w) for w in held})
    out = []
    for doc, text, *_ in docs:
        w = tuple(words(text))
        hit, found = [False] * len(w), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if w[k:k + size] in held:
                    found |= held[w[k:k + size]] - {None}
                    hit[k:k + size] = [True] * size
        edges = np.flatnonzero(np.diff([0, *map(int, hit), 0])).reshape(-1, 2)
        out.append((doc, len(w), tuple(map(tuple, edges.tolist())), tuple(sorted(found))))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_words, tuple((x.start, x.end) for x in r.ranges), tuple(r["items"])) for r in df.collect()), key=repr)


def contaminated(rows, seed=5):
    """The corpus's rows with parts of items in them, and the items: short,
    empty, null and repeated ones, one with its words repeating."""
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(12)] + ["Ünï", "日本", "x9"]
    items = [("i%d" % i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 40)))) for i in range(30)]
    items += [("short", "Alpha, BETA"), ("one", "zeta"), ("same", "go " * 25), ("empty", " .,! "), ("none", None), (None, "nobody's " * 12),
              ("i3", items[3][1]), ("copy", items[4][1]), ("inner", " ".join(items[0][1].split()[:9])), ("i5", "a second text of item five")]
    docs = list(rows)
    for i in range(60):
        own = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 30)))
        part = words(rng.choice(items)[1])
        a = rng.randint(0, max(0, len(part) - 1))
        docs.append((1000 + i, f"{own}, {'-'.join(part[a:a + rng.randint(1, 30)]).upper()}.\n{own}", "en", "s", 0))
    docs += [(2000, "ALPHA beta zeta", "en", "s", 0), (2000, "go " * 40, "en", None, 0), (None, "alpha,beta", "en", "s", 0), (2001, "GO", "en", "s", 0)]
    return docs, items


@pytest.mark.parametrize("window, shard_words, group_bytes", [(10, 100_000, 64 << 20), (10, 60, 1), (3, 100_000, 64 << 20), (1, 50, 40_000)])
def test_equals_brute_force(spark, make_docs, rows, window, shard_words, group_bytes):
    docs, items = contaminated(rows)
    df = contamination(make_docs(docs, clash=True), spark.createDataFrame(items, ITEMS).withColumn("shard", F.lit("clash")),
                       window, shard_words, group_bytes)
    assert found(df) == expected(docs, items, window)


def test_no_items_and_no_documents(spark, make_docs, rows):
    none = spark.createDataFrame([], ITEMS)
    assert found(contamination(make_docs(rows[:5]), none)) == expected(rows[:5], [], 10)
    assert contamination(make_docs([]), spark.createDataFrame([("a", "b c")], ITEMS)).collect() == []


def test_query_digests(spark, in_folder, make_docs, rows):
    docs, items = contaminated(rows)
    folder = in_folder(documents=make_docs(docs), benchmark=spark.createDataFrame(items, ITEMS))
    got = sorted(map(tuple, op12_benchmark_decontamination(spark, folder).collect()), key=repr)
    want = []
    for doc, n, ranges, names in expected(docs, items, 10):
        hit = sum(b - a for a, b in ranges)
        want.append((doc, n, hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), hit > 0))
    assert got == sorted(want, key=repr)


def test_clean_documents(spark, make_docs):
    item = "one two three four five six seven eight nine ten eleven twelve"
    docs = [(1, f"Own words before. {item.upper()}! And quite a few of its own words after, more than twelve, so it stays.", "en", "s", 0),
            (2, f"mostly {item}", "en", "s", 0), (3, "clean", "en", "s", 0), (4, None, "en", "s", 0), (5, "", "en", "s", 0)]
    got = {r.doc_id: r for r in clean_documents(make_docs(docs), spark.createDataFrame([("i", item)], ITEMS)).collect()}
    assert sorted(got) == [1, 3, 4, 5]  # 12 of 13 words of document 2 are hit
    assert got[1].text == "Own words before. ! And quite a few of its own words after, more than twelve, so it stays."
    assert (got[1].n_removed, got[3].text, got[4].text, got[5].text) == (12, "clean", None, "")
    long = clean_documents(make_docs(docs), spark.createDataFrame([("i", item)], ITEMS), longest_span=12, most_covered=1.0)
    assert {r.doc_id: r.n_removed for r in long.collect()} == {1: 0, 2: 0, 3: 0, 4: 0, 5: 0}


def test_automaton_tracks_longest_matches():
    rng = np.random.default_rng(2)
    items = [rng.integers(0, 3, n) for n in (0, 1, 5, 30, 80, 7, 30)]
    text = rng.integers(-1, 3, 2000)
    held = {tuple(x[a:b]) for x in items for a in range(len(x)) for b in range(a + 1, len(x) + 1)}
    for window in (1, 4, 9):
        at, long = [], []
        for p, _, n in Automaton(items, np.arange(len(items)), window).stream(text):
            at.append(p.copy())
            long.append(n.copy())
        at, long = np.concatenate(at), np.concatenate(long)
        assert sorted(at) == list(range(len(text)))
        for p, n in zip(at, long):
            best = max((m for m in range(1, window + 1) if m <= p + 1 and tuple(text[p + 1 - m:p + 1]) in held), default=0)
            assert n == best


def test_lookup():
    keys = np.random.default_rng(1).integers(0, 2**63, 5000, dtype=np.uint64)
    look = Lookup(keys)
    assert (look(keys) == np.arange(5000)).all()
    assert (look(keys + np.uint64(1)) == -1).all()
    assert (Lookup(np.zeros(0, np.uint64))(keys) == -1).all()
