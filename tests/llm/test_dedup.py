"""Ops 1, 3 and 9 against brute force."""

import hashlib
import re

import numpy as np
import pytest

from cohortlens.llm.bwt import least_holders
from cohortlens.llm.kernels import anchors, byte_hashes
from cohortlens.llm.ngram_join import distinct_texts, jaccard_components, op9_ngram_jaccard_join
from cohortlens.llm.substring_dedup import op1_substring_dedup, remove_repeats, repeat_lengths
from cohortlens.llm.suffix_dedup import op3_suffix_array_dedup, remove_repeated_bytes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def covered(units, width, first, doc):
    gone = [False] * len(units)
    for k in range(len(units) - width + 1):
        if first[units[k:k + width]] < doc:
            gone[k:k + width] = [True] * width
    return gone


def first_holders(texts, width):
    first = {}
    for doc in sorted(texts):
        for units in texts[doc]:
            for k in range(len(units) - width + 1):
                first.setdefault(units[k:k + width], doc)
    return first


def expected_words(data, width):
    split = [(i, tuple(WORD.findall(t or ""))) for i, t, *_ in data]
    by = {}
    for i, w in split:
        by.setdefault(i, []).append(w)
    first = first_holders({i: w for i, w in by.items() if i is not None}, width)
    out = []
    for i, w in split:
        gone = covered(w, width, first, i) if i is not None else [False] * len(w)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def expected_bytes(data, width):
    split = [(i, (t or "").encode()) for i, t, *_ in data]
    by = {}
    for i, w in split:
        by.setdefault(i, []).append(w)
    first = first_holders({i: w for i, w in by.items() if i is not None}, width)
    out = []
    for i, w in split:
        gone = np.array(covered(w, width, first, i) if i is not None else [False] * len(w), dtype=int)
        spans = int((np.diff(np.concatenate([[0], gone])) == 1).sum())
        kept = bytes(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def expected_components(data):
    sets = {}
    for i, t, *_ in data:
        w = WORD.findall(lower(t))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    comp = {i: i for i in sets}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                comp[max(x, y)] = min(x, y)
    return sorted(((i, len(sets[i]), root(i)) for i in sets), key=repr)


def got(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


OP1 = ("doc_id", "n_words", "n_removed", "kept_sha256")
OP3 = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_op1_whole_table(make_docs, in_folder, spark, rows):
    out = op1_substring_dedup(spark, in_folder(documents=make_docs(rows, clash=True)))
    assert out.columns[:4] == list(OP1)
    assert got(out, *OP1) == expected_words(rows, 13)


def test_op3_whole_table(make_docs, in_folder, spark, rows):
    out = op3_suffix_array_dedup(spark, in_folder(documents=make_docs(rows, clash=True)))
    assert got(out, *OP3) == expected_bytes(rows, 50)


def test_op9_whole_table(make_docs, in_folder, spark, rows):
    out = op9_ngram_jaccard_join(spark, in_folder(documents=make_docs(rows, clash=True)))
    assert got(out, "doc_id", "n_shingles", "component_id") == expected_components(rows)


@pytest.mark.parametrize("width", [2, 5])
def test_other_lengths(make_docs, rows, width):
    some = rows[:70]
    assert got(remove_repeats(make_docs(some), width), *OP1) == expected_words(some, width)
    assert got(remove_repeated_bytes(make_docs(some), width * 10), *OP3) == expected_bytes(some, width * 10)


def test_repeat_lengths(make_docs, rows):
    """The longest of 13, 26, 52, ... words that a different text has too."""
    texts = {i: tuple(WORD.findall(t or "")) for i, t, *_ in rows}
    raw = {i: t for i, t, *_ in rows}
    want, length = {}, 13
    while True:
        holders = {}
        for i, w in texts.items():
            for k in range(len(w) - length + 1):
                holders.setdefault(w[k:k + length], set()).add(i)
        now = {i for own in holders.values() if len({raw[j] for j in own}) > 1 for i in own}
        if not now:
            break
        want.update(dict.fromkeys(now, length))
        length *= 2
    assert length > 52
    assert {r["doc_id"]: r["words"] for r in repeat_lengths(make_docs(rows)).collect()} == want
    assert repeat_lengths(make_docs([])).count() == 0
    assert repeat_lengths(make_docs([(1, "a b c", None, None, 1), (2, "d e f", None, None, 1)])).count() == 0


def test_null_and_repeated_ids(make_docs):
    long = " ".join(f"w{i}" for i in range(40))
    data = [(None, long, None, None, 1), (3, long, None, None, 1), (3, long, None, None, 1), (3, long + " x", None, None, 1),
            (7, "y " + long, None, None, 1), (None, long, None, None, 1), (9, None, None, None, None)]
    docs = make_docs(data)
    assert got(remove_repeats(docs), *OP1) == expected_words(data, 13)
    assert got(remove_repeated_bytes(docs), *OP3) == expected_bytes(data, 50)
    comp = got(jaccard_components(docs), "doc_id", "component_id")
    assert comp == sorted([(None, None)] * 2 + [(3, 3)] * 3 + [(7, 3), (9, 9)], key=repr)


def test_empty_table(make_docs):
    docs = make_docs([])
    assert remove_repeats(docs).count() == 0
    assert remove_repeated_bytes(docs).count() == 0
    assert jaccard_components(docs).count() == 0


def test_near_copies_of_near_copies(make_docs):
    """A chain whose ends are not similar is one component; so is a hot group
    of near copies, whatever its members' prefixes."""
    base = [f"w{i}" for i in range(120)]
    chain = []
    for k in range(8):
        base = base[:]
        base[k * 12] = f"new{k}"
        chain.append((k, " ".join(base), None, None, 1))
    hot = [f"h{i}" for i in range(60)]
    group = []
    for k in range(60):
        w = hot[:]
        w[(k * 7) % 60] = f"other{k}"
        group.append((100 + k, " ".join(w), None, None, 1))
    data = chain + group
    assert got(jaccard_components(make_docs(data)), "doc_id", "n_shingles", "component_id") == expected_components(data)


def test_one_doc_id_ties_its_texts_together(make_docs):
    """Rows that share a doc_id are one node, however its texts link; a row without words too."""
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    data = [(2, a, None, None, 1), (3, a, None, None, 1), (3, b, None, None, 1), (4, b, None, None, 1), (4, None, None, None, 1), (4, "", None, None, 1),
            (5, None, None, None, 1), (6, b + " x", None, None, 1), (9, "c d e f g h", None, None, 1), (9, "p q r s t u", None, None, 1), (10, "p q r s t u", None, None, 1)]
    want = [(2, 2), (3, 2), (3, 2), (4, 2), (4, 2), (4, 2), (5, 5), (6, 2), (9, 9), (9, 9), (10, 9)]
    assert got(jaccard_components(make_docs(data)), "doc_id", "component_id") == sorted(want, key=repr)


def test_distinct_texts_judge_each_text(make_docs):
    a, b, c = (" ".join(f"{k}{i}" for i in range(30)) for k in "abc")
    data = [(2, a, None, None, 1), (3, a + " x", None, None, 1), (3, b, None, None, 1), (7, c, None, None, 1), (7, "other words that nobody has", None, None, 1),
            (8, c.upper(), None, None, 1), (8, None, None, None, 1), (8, None, None, None, 1), (1, b + " y", None, None, 1), (None, a, None, None, 1)]
    docs = make_docs(data)
    kept = distinct_texts(docs)
    mark = {r.t: r.m for r in docs.selectExpr("text t", "xxhash64(text) m").collect()}
    assert got(kept, "doc_id", "mark") == sorted(
        [(2, mark[a]), (1, mark[b + " y"]), (7, mark[c]), (7, mark["other words that nobody has"]), (8, mark[None])], key=repr)


def test_threshold_is_reached_exactly(make_docs):
    """Three of four shingles is 0.75: linked; two of three is not."""
    data = [(1, "a b c d e f g", None, None, 1), (2, "a b c d e f g h", None, None, 1),
            (3, "p q r s t u", None, None, 1), (4, "p q r s t u v", None, None, 1)]
    assert got(jaccard_components(make_docs(data)), "doc_id", "component_id") == [(1, 1), (2, 1), (3, 3), (4, 4)]


def test_bwt_merge_any_shards():
    rng = np.random.default_rng(5)
    frags = [bytes(rng.integers(0, 3, rng.integers(1, 30)).astype(np.uint8)) for _ in range(150)]
    buf, offs = np.frombuffer(b"".join(frags), np.uint8), np.concatenate([[0], np.cumsum([len(f) for f in frags])])
    holder = rng.integers(0, 99, len(frags))
    first = {}
    for f, h in zip(frags, holder):
        for k in range(len(f) - 5):
            first[f[k:k + 6]] = min(h, first.get(f[k:k + 6], h))
    want = np.full(len(buf), -1)
    for f, o in zip(frags, offs):
        for k in range(len(f) - 5):
            want[o + k] = first[f[k:k + 6]]
    for size in (50, 400, 1 << 20):
        assert np.array_equal(least_holders(buf, offs, holder, 6, size), want)


def test_anchors_are_a_property_of_the_string():
    rng = np.random.default_rng(2)
    text = rng.integers(97, 101, 4000).astype(np.uint8)
    offs = np.array([0, 1500, 1510, 4000])
    spots = set(anchors(byte_hashes(text, 8), offs, 8, 13).tolist())
    for lo, hi in zip(offs[:-1], offs[1:]):
        for s in range(lo, hi - 19):
            assert any(p in spots for p in range(s, s + 13))
