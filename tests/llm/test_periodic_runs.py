"""Op 13 against brute force, and its general interface."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from cohortlens.llm.kernels import mix
from cohortlens.llm.periodic_runs import find_runs, op13_periodic_runs, with_repeats, word_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs(w, shortest=12):
    """(start, length, period) of the maximal runs, by every period in turn."""
    best = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i >= q and j - i + q >= shortest:
                best.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted((a, b - a, q) for (a, b), q in best.items())


def collapsed(w, found):
    gone = {i for a, n, q in found for i in range(a + q, a + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def repeated(doc, text):
    """The words that the query's statement makes of a text."""
    w = WORD.findall(text or "")
    if doc is None or not w:
        return w
    h, n = zlib.crc32(str(doc).encode()), len(w)
    g = h // 10
    if h % 10 == 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def texts(seed=4):
    rng = random.Random(seed)
    out = []
    for letters, most in (("ab", 60), ("abc", 150), ("abcdefgh", 400)):
        out += [" ".join(rng.choice(letters) for _ in range(rng.randint(0, most))) for _ in range(30)]
    for _ in range(40):
        part = [rng.choice("abcd") for _ in range(rng.randint(1, 40))]
        body = part * rng.randint(1, 6) + part[:rng.randint(0, len(part))]
        out.append("\n".join([rng.choice("abcd") for _ in range(rng.randint(0, 20))] + body + [rng.choice("abcd") for _ in range(rng.randint(0, 20))]))
    thue = "a"
    while len(thue) < 600:
        thue += thue.translate(str.maketrans("ab", "ba"))
    fib = ["a", "a b"]
    while len(fib[-1]) < 900:
        fib.append(fib[-1] + " " + fib[-2])
    return out + [" ".join(thue), fib[-1], "same " * 500, "x y " * 300, "one  two\tthree " * 4, "a " * 11, "a " * 12, "a b c d e f " * 2, None, "", " \n"]


def test_words_of_small_alphabets():
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, int(rng.integers(1, 5)), int(rng.integers(0, 200))) for _ in range(150)]
    offs = np.concatenate([[0], np.cumsum([len(x) for x in docs])])
    hashes = mix(np.concatenate(docs).astype(np.uint64) + np.uint64(9))
    for shortest in (2, 12):
        doc, start, length, period = word_runs(hashes, offs, shortest)
        want = [(d, *r) for d, w in enumerate(docs) for r in runs(w.tolist(), shortest)]
        assert list(zip(doc.tolist(), start.tolist(), length.tolist(), period.tolist())) == want


def test_nothing_to_find():
    for sizes in ([], [0], [0, 0], [1], [11]):
        offs = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        assert all(len(x) == 0 for x in word_runs(np.ones(int(offs[-1]), np.uint64), offs))


def test_equals_brute_force(spark, make_docs):
    data = [(i // 2 if i % 7 else None, t, "en", "s", 0) for i, t in enumerate(texts())]
    got = sorted(((r.doc_id, r.n_words, tuple(tuple(x) for x in r.runs), r.collapsed, r.collapsed_sha256) for r in find_runs(make_docs(data, clash=True)).collect()), key=repr)
    want = []
    for doc, text, *_ in data:
        w = WORD.findall(text or "")
        found = runs(w)
        kept = collapsed(w, found)
        want.append((doc, len(w), tuple(found), kept, hashlib.sha256(kept.encode()).hexdigest()))
    assert got == sorted(want, key=repr)


def test_empty_table(spark, make_docs):
    assert find_runs(make_docs([])).collect() == []


def test_statement_of_repeats(spark, make_docs, rows):
    data = [(i, t, "en", "s", 0) for i, t in enumerate(texts())] + [(None, "a b c", "en", "s", 0)]
    got = sorted(((r.doc_id, tuple(WORD.findall(r.text or ""))) for r in with_repeats(make_docs(data, clash=True)).collect()), key=repr)
    assert got == sorted(((i, tuple(repeated(i, t))) for i, t, *_ in data), key=repr)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, *_ in data[:-1]) > 5


def test_query_digests(spark, in_folder, make_docs, rows):
    data = [(i, t, "en", "s", 0) for i, t in enumerate(texts())] + [(10_000 + i, t, *r) for i, t, *r in rows if len(t or "") < 10_000]
    got = sorted(map(tuple, op13_periodic_runs(spark, in_folder(documents=make_docs(data))).collect()))
    want = []
    for doc, text, *_ in data:
        w = repeated(doc, text)
        found = runs(w)
        top = min(((-n, a, q) for a, n, q in found), default=None)
        digest = hashlib.sha256("".join(f"{a},{n},{q}\n" for a, n, q in found).encode()).hexdigest()
        first = (None,) * 4 if top is None else (top[1], -top[0], top[2], 1000 * -top[0] // top[2])
        want.append((doc, len(found), *first, digest, hashlib.sha256(collapsed(w, found).encode()).hexdigest()))
    assert got == sorted(want)


@pytest.mark.parametrize("n", [1, 40_000])
def test_one_long_text(n):
    words = mix(np.arange(200_000, dtype=np.uint64) % np.uint64(n))
    doc, start, length, period = word_runs(words, np.array([0, 200_000]))
    assert (doc.tolist(), start.tolist(), length.tolist(), period.tolist()) == ([0], [0], [200_000], [n])
