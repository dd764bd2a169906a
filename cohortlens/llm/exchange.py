"""Packed exchanges between blocks of documents.

* ``shared_keys``: which keys of a text occur in other texts too. The keys
  (hashes of word windows, byte grams, shingles) leave the map side as blobs of
  a few bytes a key, one row per block of documents and bucket. A block sends
  at most two entries of a key (more of its texts with the key need no answer:
  the block itself knows that the key repeats), so a key that a third of all
  documents hold costs two entries a block in its bucket, and the bucket's task
  stays bounded.
* ``packets`` and ``gathered``: findings about documents, spread over tasks by
  something else, come together as one row a document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohortlens.llm.common import partitions
from cohortlens.llm.kernels import column, mix, text_blocks

_LOW = np.uint64((1 << 40) - 1)


def packed_schema(ddl: str) -> pa.Schema:
    """Arrow schema of a DDL of int and binary columns."""
    return pa.schema([(x.split()[0], pa.int32() if x.endswith("int") else pa.binary()) for x in ddl.split(", ")])


def packed_rows(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def buckets_of(frame: DataFrame) -> int:
    return partitions(frame.sparkSession)


def fold(keys: np.ndarray, buckets: int) -> np.ndarray:
    """A key as bucket and 40 further bits. Two different keys may meet here,
    so equality of folded keys makes candidates only."""
    return ((keys >> np.uint64(40)) % np.uint64(buckets) << np.uint64(40)) | (keys & _LOW)


def pack5(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def unpack5(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, 5)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :5] = raw
    return out.view("<u8").ravel()


def refs(idx: np.ndarray) -> tuple[np.ndarray, bytes]:
    """(documents used, which of them each entry names), packed: counts where
    the entries come in document order, else numbers."""
    used, at = np.unique(idx, return_inverse=True)
    runs = bool((np.diff(at) >= 0).all())
    number = np.bincount(at) if runs else at
    wide = int(number.max(initial=0)) >= 1 << 16
    return used, bytes([runs + 2 * wide]) + number.astype(np.uint32 if wide else np.uint16).tobytes()


def named(data: bytes, *tables: bytes) -> list[np.ndarray]:
    """Each table's (int64) value for every entry of ``refs``."""
    number = np.frombuffer(data[1:], np.uint32 if data[0] & 2 else np.uint16)
    if data[0] & 1:
        return [np.repeat(np.frombuffer(t, np.int64), number) for t in tables]
    return [np.frombuffer(t, np.int64)[number] for t in tables]


# ------------------------------------------------------------- findings --

PACKET = "bucket int, docs binary, marks binary, idx binary, ranges binary"
_PACKET = packed_schema(PACKET)


def packets(d: np.ndarray, m: np.ndarray, start: np.ndarray, size: np.ndarray | int, groups: int
            ) -> Iterator[pa.RecordBatch]:
    """Ranges [start, start + size) of documents (d, m), packed to one row a
    group of documents."""
    if not len(d):
        return
    group = (mix(d.astype(np.uint64) ^ mix(m.astype(np.uint64))) % np.uint64(groups)).astype(np.int64)
    order = np.lexsort((start, m, d, group))
    d, m, group = d[order], m[order], group[order]
    ranges = np.column_stack([start, np.broadcast_to(size, len(start))]).astype(np.int32)[order]
    doc = np.cumsum(np.append(False, (d[1:] != d[:-1]) | (m[1:] != m[:-1])))
    first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    docs, marks = d[first], m[first]
    cut = np.flatnonzero(np.diff(group)) + 1
    rows = []
    for lo, hi in zip(np.append(0, cut), np.append(cut, len(d))):
        used, idx = refs(doc[lo:hi])
        rows.append((int(group[lo]), docs[used].tobytes(), marks[used].tobytes(), idx, ranges[lo:hi].tobytes()))
    yield from packed_rows(rows, _PACKET)


def merged(doc: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, size) of the unions of ranges that touch or overlap;
    ranges come by document and start."""
    base = doc.astype(np.int64) << 32
    lo, hi = base + start, np.maximum.accumulate(base + start + size)
    head = np.ones(len(lo), bool)
    head[1:] = lo[1:] > hi[:-1]
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(lo)) - 1
    return doc[first], start[first], hi[last] - lo[first]


def gathered(packed: DataFrame, groups: int) -> DataFrame:
    """(doc_id, mark, ranges binary): the union of a document's ranges, start
    and size in int32, in one row."""

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d, m, ranges = [], [], []
        for batch in batches:
            for _, docs, marks, idx, data in zip(*(c.to_pylist() for c in batch.columns)):
                docs, marks = named(idx, docs, marks)
                d.append(docs)
                m.append(marks)
                ranges.append(np.frombuffer(data, np.int32).reshape(-1, 2))
        if not d:
            return
        d, m, ranges = np.concatenate(d), np.concatenate(m), np.concatenate(ranges).astype(np.int64)
        order = np.lexsort((ranges[:, 0], m, d))
        d, m, ranges = d[order], m[order], ranges[order]
        doc = np.cumsum(np.append(False, (d[1:] != d[:-1]) | (m[1:] != m[:-1])))
        first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
        own, start, size = merged(doc, ranges[:, 0], ranges[:, 1])
        flat = np.column_stack([start, size]).astype(np.int32)
        lows = np.searchsorted(own, np.arange(len(first) + 1))
        for lo in range(0, len(first), 10_000):
            part = slice(lo, lo + 10_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(d[first[part]]), pa.array(m[first[part]]),
                 pa.array([flat[x:y].tobytes() for x, y in zip(lows[:-1][part], lows[1:][part])], type=pa.binary())],
                names=["doc_id", "mark", "ranges"])

    return packed.repartitionById(groups, "bucket").mapInArrow(merge, "doc_id long, mark long, ranges binary")


def ranges_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, size) of the ranges column of a batch; null: none."""
    parts = [x or b"" for x in batch.column(batch.schema.get_field_index("ranges")).to_pylist()]
    pairs = np.frombuffer(b"".join(parts), np.int32).reshape(-1, 2).astype(np.int64)
    return np.repeat(np.arange(len(parts)), [len(x) // 8 for x in parts]), pairs[:, 0], pairs[:, 1]


# ----------------------------------------------------------- shared keys --

BLOB = "bucket int, kind int, marks binary, idx binary, keys binary"
_BLOB = packed_schema(BLOB)
_ASKED, _KNOWN = 0, 1


def shared_keys(frame: DataFrame, keys_of: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]],
                counted: bool = False) -> DataFrame:
    """(mark, key) for the folded keys of the texts of ``frame`` (mark, text;
    mark a hash of the text) that occur under another mark too, a key once or
    more; with ``counted`` (mark, shared): how many there are, in several rows a
    mark that are to be summed (copies in many blocks can make that sum too
    large, never too small).

    ``keys_of(bytes, offsets)`` gives (document index, key) arrays for a
    block, in document order. The answer may hold a key too many (folding),
    never one too few.
    """
    buckets = buckets_of(frame)

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, (rows, buf, offs) in enumerate(text_blocks(batches)):
            at, keys = keys_of(buf, offs)
            if not len(keys):
                continue
            marks = column(rows, "mark")
            keys = fold(keys, buckets)
            order = np.lexsort((marks[at], keys))
            k, m = keys[order], marks[at[order]]
            fresh = np.ones(len(k), bool)
            fresh[1:] = (k[1:] != k[:-1]) | (m[1:] != m[:-1])
            order, k = order[fresh], k[fresh]
            first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
            rank = np.arange(len(k)) - np.repeat(first, np.diff(np.append(first, len(k))))
            out = []

            def put(bucket: int, kind: int, entries: np.ndarray) -> None:
                used, idx = refs(at[entries])
                out.append((bucket, kind, marks[used].tobytes(), idx,
                            pack5(keys[entries]) if kind == _ASKED else keys[entries].tobytes()))

            more = np.sort(order[rank >= 2])
            if len(more):
                put((int(marks[0]) + block) % buckets, _KNOWN, more)
            sent = np.sort(order[rank < 2])
            bucket = (keys[sent] >> np.uint64(40)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            sent, bucket = sent[by], bucket[by]
            cut = np.flatnonzero(np.diff(bucket)) + 1
            for lo, hi in zip(np.append(0, cut), np.append(cut, len(sent))):
                put(int(bucket[lo]), _ASKED, sent[lo:hi])
            yield from packed_rows(out, _BLOB)

    names = ["mark", "shared"] if counted else ["mark", "key"]

    def answer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, keys = [], []

        def out(m, k):
            cols = np.unique(m, return_counts=True) if counted else (m, k)
            for lo in range(0, len(cols[0]), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[lo:lo + 100_000].astype(np.int64)) for x in cols], names=names)

        for batch in batches:
            for bucket, kind, m, idx, key in zip(*(c.to_pylist() for c in batch.columns)):
                (m,) = named(idx, m)
                if kind == _KNOWN:
                    yield from out(m, np.frombuffer(key, np.uint64))
                else:
                    marks.append(m)
                    keys.append(unpack5(key) | np.uint64(bucket) << np.uint64(40))
        if not keys:
            return
        m, k = np.concatenate(marks), np.concatenate(keys)
        marks.clear(), keys.clear()
        order = np.lexsort((m, k))
        k, m = k[order], m[order]
        fresh = np.ones(len(k), bool)  # one entry for each key and mark
        fresh[1:] = (k[1:] != k[:-1]) | (m[1:] != m[:-1])
        k, m = k[fresh], m[fresh]
        same = k[1:] == k[:-1]
        shared = np.zeros(len(k), bool)
        shared[1:] |= same
        shared[:-1] |= same
        yield from out(m[shared], k[shared])

    return (frame.select("mark", "text").mapInArrow(send, BLOB).repartitionById(buckets, "bucket")
            .mapInArrow(answer, ", ".join(f"{x} long" for x in names)))
