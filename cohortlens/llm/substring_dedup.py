"""Substring dedup by level-wise doubling over word windows.

Lengths grow from half the wanted window, doubling: windows that repeat at one
length alone are extended to twice that length, until no candidates survive
(or the wanted window is reached, where the removal is decided).

* Seed level (``ceil(window / 2)`` words): every wanted window holds an
  anchor, the smallest seed hash of its seeds. Only anchors are compared
  (about a quarter of all positions); equal windows have equal anchors, so no
  repeated window is missed.
* Copies of a whole text collapse first. Window level: windows over an anchor
  that another text holds too are compared by 96 bits. A block of documents settles its own repeats and asks
  only whether a smaller document elsewhere has the window of its smallest
  document; so a passage in a third of all documents costs one entry a block.
* ``repeat_lengths`` goes on from there (26, 52, ... words) until no window
  survives, for the lengths of repeated passages.

Removal: a word covered by a window whose words also start in a document
with a smaller doc_id; windows are judged on the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.common import prepare, table, text_copies, write_shared
from cohortlens.llm.exchange import (PACKET, buckets_of, fold, gathered, named, packed_rows, packed_schema, packets,
                                     ranges_of, refs, shared_keys)
from cohortlens.llm.kernels import (PACKED, anchors, column, mix, pack_texts, packed_blocks, valid_starts,
                                    window_hashes, word_hashes, word_spans)

WINDOW = 13
_ASK_DDL = "bucket int, kind int, docs binary, marks binary, idx binary, at binary, a binary, b binary"
_ASK = packed_schema(_ASK_DDL)
_OPEN, _SETTLED = 0, 1


def _seeds(buf: np.ndarray, offs: np.ndarray, window: int):
    """Words of a block with their anchors: (word offsets, word hashes, anchor
    positions, anchor hashes)."""
    seed = -(-window // 2)
    starts, ends, wo = word_spans(buf, offs)
    words = word_hashes(buf, starts, ends)
    grams = window_hashes(words, seed)
    spots = anchors(grams, wo, seed, window - seed + 1)
    return starts, ends, wo, words, spots, grams[spots]


def _candidates(wo: np.ndarray, spots: np.ndarray, window: int) -> np.ndarray:
    """Starts of the windows that hold one of the seeds at ``spots``."""
    seed = -(-window // 2)
    total = int(wo[-1])
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, np.maximum(spots - (window - seed), 0), 1)
    np.add.at(edge, np.minimum(spots + 1, total), -1)
    ok = valid_starts(wo, total, window)
    return np.flatnonzero((np.cumsum(edge)[:len(ok)] > 0) & ok)


def _least(d: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each entry the smallest document with its window (a, b)."""
    order = np.lexsort((d, b, a))
    x, y = a[order], b[order]
    head = np.ones(len(x), bool)
    head[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    out = np.empty(len(x), np.int64)
    out[order] = np.repeat(d[order][head], np.diff(np.append(np.flatnonzero(head), len(x))))
    return out


def owned(frame: DataFrame, windows_of, length: int, buckets: int) -> DataFrame:
    """(doc_id, mark, ranges binary): what the windows of ``length`` cover that
    also start in a document with a smaller doc_id.

    ``windows_of(rows, bytes, offsets)`` gives (row, hash a, hash b, start)
    for a block of ``frame`` (doc_id, mark, size, packed, ...).
    """

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, (rows, buf, offs) in enumerate(packed_blocks(batches)):
            row, a, b, at = windows_of(rows, buf, offs)
            if not len(row):
                continue
            docs, marks = column(rows, "doc_id"), column(rows, "mark")
            ask = _least(docs[row], a, b) == docs[row]
            out = []

            def put(bucket: int, kind: int, part: np.ndarray) -> None:
                used, idx = refs(row[part])
                hashes = (a[part].tobytes(), b[part].tobytes()) if kind == _OPEN else (b"", b"")
                out.append((bucket, kind, docs[used].tobytes(), marks[used].tobytes(), idx,
                            at[part].astype(np.int32).tobytes(), *hashes))

            own = np.flatnonzero(~ask)  # a smaller document of the block has the window
            if len(own):
                put((int(docs[0]) * 31 + block) % buckets, _SETTLED, own)
            sent = np.flatnonzero(ask)
            bucket = (a[sent] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            sent, bucket = sent[order], bucket[order]
            cut = np.flatnonzero(np.diff(bucket)) + 1
            for lo, hi in zip(np.append(0, cut), np.append(cut, len(sent))):
                put(int(bucket[lo]), _OPEN, sent[lo:hi])
            yield from packed_rows(out, _ASK)

    def settle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d, m, at, a, b = ([] for _ in range(5))
        for batch in batches:
            for _, kind, docs, marks, idx, places, x, y in zip(*(c.to_pylist() for c in batch.columns)):
                docs, marks = named(idx, docs, marks)
                if kind == _SETTLED:
                    yield from packets(docs, marks, np.frombuffer(places, np.int32), length, buckets)
                    continue
                for to, value in ((d, docs), (m, marks), (at, np.frombuffer(places, np.int32)),
                                  (a, np.frombuffer(x, np.uint64)), (b, np.frombuffer(y, np.uint32))):
                    to.append(value)
        if d:
            d, m, at, a, b = (np.concatenate(x) for x in (d, m, at, a, b))
            gone = d > _least(d, a, b)
            yield from packets(d[gone], m[gone], at[gone], length, buckets)

    settled = frame.mapInArrow(send, _ASK_DDL).repartitionById(buckets, "bucket").mapInArrow(settle, PACKET)
    return gathered(settled, buckets)


def _candidate_windows(docs: DataFrame, window: int) -> tuple[DataFrame, Callable]:
    """(mark, keys) of the texts of ``docs`` (doc_id, mark, text) with anchors
    that another text has too, and the function that gives the windows over
    them, as (row, hash a, hash b, start), for a block of packed rows with
    ``keys``."""
    buckets = buckets_of(docs)

    def seeds(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        *_, wo, _, spots, keys = _seeds(buf, offs, window)
        return np.searchsorted(wo, spots, side="right") - 1, keys

    def windows_of(rows: pa.RecordBatch, buf: np.ndarray, offs: np.ndarray):
        starts, ends, wo, words, spots, keys = _seeds(buf, offs, window)
        row = np.searchsorted(wo, spots, side="right") - 1
        lists = rows.column(rows.schema.get_field_index("keys"))
        asked = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
        wanted = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        keep = _member(row, fold(keys, buckets), asked, wanted)
        at = _candidates(wo, spots[keep], window)
        doc = np.searchsorted(wo, at, side="right") - 1
        other = word_hashes(buf, starts, ends, seed=2)
        a = window_hashes(words, window)[at] if len(at) else np.zeros(0, np.uint64)
        b = window_hashes(other, window, seed=2)[at] if len(at) else a
        return doc, a, (b >> np.uint64(32)).astype(np.uint32), at - wo[doc]

    return shared_keys(docs, seeds).groupBy("mark").agg(F.collect_set("key").alias("keys")), windows_of


def repeated_windows(docs: DataFrame, firsts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, mark, ranges): per document of ``docs`` (doc_id, mark, text)
    that ``firsts`` (doc_id, mark) names, one for each different text, the words
    covered by windows that also start in a document with a smaller doc_id.
    Documents without any are left out."""
    found, windows_of = _candidate_windows(docs, window)
    joined = docs.mapInArrow(pack_texts, PACKED).join(firsts.join(found, "mark"), ["doc_id", "mark"])
    return owned(joined, windows_of, window, buckets_of(docs))


def repeat_lengths(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, mark, words): the largest of ``window``, 2 * window, 4 * window,
    ... such that a window of so many words also occurs in a different text of
    a document with another doc_id. Documents whose windows occur nowhere else
    are left out.

    The levels after ``window``: windows that repeat at one length and go on
    into one that repeats too are extended to twice the length and compared
    again, until no candidate survives. Each level is one self-join by document
    and one aggregation by window with map-side partial sums. Windows are
    compared by 64 bits here.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    docs = docs.where("doc_id is not null")
    found, windows_of = _candidate_windows(docs, window)

    def flat(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in packed_blocks(batches):
            row, a, b, at = windows_of(rows, buf, offs)
            h = mix(a ^ (b.astype(np.uint64) << np.uint64(17)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(column(rows, "doc_id")[row]), pa.array(column(rows, "mark")[row]), pa.array(at.astype(np.int32)),
                 pa.array(h.view(np.int64))], names=["doc_id", "mark", "at", "h"])

    level = docs.mapInArrow(pack_texts, PACKED).join(found, "mark").mapInArrow(flat, "doc_id long, mark long, at int, h long").distinct()
    length, tops = window, None
    while True:
        shared = level.groupBy("h").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y"), F.min("mark").alias("p"),
                                        F.max("mark").alias("q")).where("x < y and p <> q").select("h")
        level = write_shared(level.join(shared, "h", "left_semi"), "level")
        if not level.take(1):
            break
        top = level.select("doc_id", "mark").distinct().withColumn("words", F.lit(length))
        tops = top if tops is None else tops.unionByName(top)
        ahead = level.select("doc_id", "mark", (F.col("at") - length).alias("at"), F.col("h").alias("g"))
        level = level.join(ahead, ["doc_id", "mark", "at"]).select("doc_id", "mark", "at", F.xxhash64("h", "g").alias("h"))
        length *= 2
    if tops is None:
        return level.select("doc_id", "mark", F.lit(window).alias("words")).limit(0)
    return tops.groupBy("doc_id", "mark").agg(F.max("words").alias("words"))


def _member(row: np.ndarray, key: np.ndarray, rows: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which (row, key) pairs are among (rows, keys)."""
    r, k = np.concatenate([rows, row]), np.concatenate([keys, key])
    own = np.repeat([0, 1], [len(rows), len(row)])
    order = np.lexsort((own, k, r))
    r, k, own = r[order], k[order], own[order]
    head = np.ones(len(r), bool)
    head[1:] = (r[1:] != r[:-1]) | (k[1:] != k[:-1])
    has = np.repeat(own[head] == 0, np.diff(np.append(np.flatnonzero(head), len(r))))
    out = np.zeros(len(row), bool)
    out[order[own == 1] - len(rows)] = has[own == 1]
    return out


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored):
    doc_id, n_words, n_removed, kept_text, kept_sha256, spans (removed word
    ranges ``start:end``, comma-joined).

    A null text has no words. Rows with a null doc_id take no part: nothing
    of theirs is removed and nothing is removed because of them. Rows that
    share a doc_id never remove each other's words. Texts shorter than the
    window stay whole.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    known = docs.where("doc_id is not null")
    firsts, copies = text_copies(known)
    hits = repeated_windows(known, firsts, window)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in packed_blocks(batches):
            starts, ends, wo = word_spans(buf, offs)
            row, first, size = ranges_of(rows)
            edge = np.zeros(len(starts) + 1, np.int64)
            np.add.at(edge, wo[row] + first, 1)
            np.add.at(edge, wo[row] + first + size, -1)
            gone = np.cumsum(edge)[:-1] > 0
            copy = np.array([bool(x) for x in rows.column(rows.schema.get_field_index("copy")).to_pylist()], bool)
            gone |= np.repeat(copy & (np.diff(wo) >= window), np.diff(wo))
            texts, digests, spans = [], [], []
            flat = buf.copy()
            keep = ~gone
            edge = np.zeros(len(buf) + 1, np.int8)
            edge[starts[keep]] += 1
            np.add.at(edge, ends[keep], -1)
            inside = np.cumsum(edge, dtype=np.int64)[:-1] > 0
            doc = np.repeat(np.arange(len(offs) - 1), np.diff(wo))
            kept_doc = doc[keep]
            glue = np.ones(len(kept_doc), bool)  # a space after every kept word but the document's last
            glue[:-1] = kept_doc[:-1] == kept_doc[1:]
            glue[-1:] = False
            inside[ends[keep][glue]] = True
            flat[ends[keep][glue]] = 0x20
            out = flat[inside].tobytes()
            cuts = np.concatenate([[0], np.cumsum(inside)])[offs]
            removed = np.concatenate([[0], np.cumsum(gone)])
            for i in range(len(offs) - 1):
                kept = out[cuts[i]:cuts[i + 1]]
                digests.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept)
                lo, hi = wo[i], wo[i + 1]
                if removed[hi] > removed[lo]:
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone[lo:hi].view(np.int8), [0]])))
                    spans.append(",".join(f"{x}:{y}" for x, y in edges.reshape(-1, 2)))
                else:
                    spans.append("")
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(np.diff(wo)), pa.array(removed[wo[1:]] - removed[wo[:-1]]),
                 pa.array(texts, type=pa.binary()).cast(pa.string()), pa.array(digests, type=pa.string()),
                 pa.array(spans, type=pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256", "spans"])

    return docs.mapInArrow(pack_texts, PACKED).join(hits, ["doc_id", "mark"], "left").join(copies, ["doc_id", "mark"], "left").mapInArrow(
        cut, "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string, spans string")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 13-word windows removed from all documents."""
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")
