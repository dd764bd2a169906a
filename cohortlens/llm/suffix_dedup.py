"""Suffix-array dedup of repeated byte strings.

Copies of a whole text collapse first. Of the rest only bytes near a gram that
another text holds too are looked at: every string of ``length`` bytes holds
an anchor (the smallest gram hash of the string), equal strings have equal
anchors, so fragments around equal anchors meet in one bucket and no repeated
string is missed. Equal fragments collapse to the smallest document that has
them; buckets then build Burrows-Wheeler transforms of shards of the different
fragments and merge them by interleave refinement (``bwt``), whose common
prefixes give the repeated strings and with them the smallest document of each.

Removal: a byte covered by a string of ``length`` bytes that also starts in a
document with a smaller doc_id; strings are judged on the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.bwt import least_holders
from cohortlens.llm.common import prepare, table, text_copies
from cohortlens.llm.exchange import (PACKET, buckets_of, fold, gathered, named, pack5, packed_rows, packed_schema,
                                     packets, ranges_of, refs, shared_keys, unpack5)
from cohortlens.llm.kernels import (PACKED, _sliding, byte_hashes, column, mix, pack_texts, packed_blocks, runs,
                                    valid_starts)

LENGTH = 50
_SLICE = 1 << 18  # bytes hashed at a time, so that the arrays stay in the cache
_MERGE = 1 << 18  # bytes of fragments looked at together, which the merge keeps in the cache
_ASK_DDL = "bucket int, kind int, docs binary, marks binary, idx binary, places binary, keys binary, sums binary, body binary"
_ASK = packed_schema(_ASK_DDL)
_OPEN, _SETTLED = 0, 1
_PRIME = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = []


def _gram(length: int) -> int:
    return max(1, 2 * length // 5)


def _slices(offs: np.ndarray) -> Iterator[tuple[int, int]]:
    row, n = 0, len(offs) - 1
    while row < n:
        last = min(n, max(row + 1, int(np.searchsorted(offs, offs[row] + _SLICE, side="right")) - 1))
        yield row, last
        row = last


def _anchors(buf: np.ndarray, offs: np.ndarray, length: int):
    """(gram hashes, smallest gram hash of each string (0: leaves its
    document), anchor positions) of a slice."""
    gram = _gram(length)
    span = length - gram + 1
    hashes = byte_hashes(buf, gram)
    if len(buf) < length:
        return hashes, hashes[:0], np.zeros(0, np.int64)
    low = _sliding(hashes, span, np.minimum)
    low = np.where(valid_starts(offs, len(buf), length), low, np.uint64(0))
    pad = np.zeros(span - 1, np.uint64)
    high = _sliding(np.concatenate([pad, low, pad]), span, np.maximum)
    return hashes, low, np.flatnonzero((high == hashes) & (high > 0))


def _span_hashes(buf: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """A hash of each buf[lo:hi]."""
    if not _POWERS or len(_POWERS[0]) < len(buf) + 1:
        powers = []
        for p in (_PRIME, pow(_PRIME, -1, 2**64)):
            x = np.full(max(len(buf), _SLICE * 2) + 1, p, np.uint64)
            x[0] = 1
            powers.append(np.multiply.accumulate(x))
        _POWERS[:] = powers
    value = (buf.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93) * _POWERS[0][:len(buf)]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value)])
    return mix((total[hi] - total[lo]) * _POWERS[1][lo] + (hi - lo).astype(np.uint64))


def _fragments(buf: np.ndarray, offs: np.ndarray, asked: np.ndarray, length: int, buckets: int):
    """(row, start, size, folded key) of the fragments around the anchors of a
    slice whose (row, key), packed in ``asked``, repeats elsewhere. A fragment
    holds exactly the strings that have the anchor as their smallest gram."""
    hashes, low, spots = _anchors(buf, offs, length)
    span = length - _gram(length) + 1
    row = np.searchsorted(offs, spots, side="right") - 1
    keys = fold(hashes[spots], buckets)
    keep = np.isin(mix(keys ^ mix(row.astype(np.uint64))), asked)
    spots, row, keys = spots[keep], row[keep], keys[keep]
    first = np.empty(len(spots), np.int64)
    last = np.empty(len(spots), np.int64)
    for lo in range(0, len(spots), 20_000):
        p = spots[lo:lo + 20_000]
        near = p[:, None] + np.arange(-(span - 1), 1)
        ok = (near >= 0) & (near < len(low))
        ok &= low[np.clip(near, 0, max(0, len(low) - 1))] == hashes[p][:, None]
        first[lo:lo + 20_000] = p - (span - 1) + ok.argmax(1)
        last[lo:lo + 20_000] = p - ok[:, ::-1].argmax(1)
    return row, first, last - first + length, keys


def _least(groups: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(out, groups, values)
    return out


def repeated_ranges(packed: DataFrame, length: int, buckets: int) -> DataFrame:
    """(doc_id, mark, ranges) of ``packed`` (doc_id, mark, size, packed, keys):
    byte ranges covered by strings that start in a smaller document too."""

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=1)
        for block, (rows, buf, offs) in enumerate(packed_blocks(batches)):
            docs, marks = column(rows, "doc_id"), column(rows, "mark")
            lists = rows.column(rows.schema.get_field_index("keys"))
            cuts, wanted = np.asarray(lists.offsets), lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            cuts = cuts - cuts[0]
            parts = []
            for a, b in _slices(offs):
                own = np.repeat(np.arange(b - a, dtype=np.uint64), np.diff(cuts[a:b + 1]))
                asked = mix(wanted[cuts[a]:cuts[b]] ^ mix(own))
                text, cut = buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
                row, start, size, keys = _fragments(text, cut, asked, length, buckets)
                sums = _span_hashes(text, start, start + size)
                parts.append((row + a, start + offs[a], size, keys, sums))
            row, start, size, keys, sums = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 5
            if not len(row):
                continue
            order = np.lexsort((sums, keys))
            head = np.ones(len(order), bool)
            head[1:] = (keys[order][1:] != keys[order][:-1]) | (sums[order][1:] != sums[order][:-1])
            frag = np.empty(len(order), np.int64)
            frag[order] = np.cumsum(head) - 1
            lead = order[head]  # one place of each different fragment
            ask = docs[row] == _least(frag, docs[row], len(lead))[frag]
            local = start - offs[row]
            out = []

            def put(bucket: int, kind: int, part: np.ndarray, *more: bytes) -> None:
                used, idx = refs(row[part])
                out.append((bucket, kind, docs[used].tobytes(), marks[used].tobytes(), idx, *more))

            def ints(*arrays: np.ndarray) -> bytes:
                flat = np.concatenate([np.array([len(x) for x in arrays]), *arrays]).astype(np.int32)
                return len(flat).to_bytes(4, "little") + codec.compress(flat, asbytes=True)

            own = np.flatnonzero(~ask)  # a smaller document of the block has the whole fragment
            if len(own):
                put((int(docs[0]) * 31 + block) % buckets, _SETTLED, own, ints(local[own], size[own]), b"", b"", b"")
            sent = np.flatnonzero(ask)
            bucket = (keys[sent] >> np.uint64(40)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            sent, bucket = sent[by], bucket[by]
            cut = np.flatnonzero(np.diff(bucket)) + 1
            for lo, hi in zip(np.append(0, cut), np.append(cut, len(sent))):
                part = sent[lo:hi]
                used, first, which = np.unique(frag[part], return_index=True, return_inverse=True)
                turn = np.argsort(first)  # fragments in the order in which the entries name them
                name = np.empty(len(used), np.int64)
                name[turn] = np.arange(len(used))
                f = lead[used[turn]]
                reach = np.cumsum(size[f])
                at = np.repeat(start[f] - (reach - size[f]), size[f]) + np.arange(int(reach[-1]))
                put(int(bucket[lo]), _OPEN, part, ints(local[part], np.diff(name[which], prepend=0), size[f]), pack5(keys[f]),
                    sums[f].tobytes(), codec.compress(buf[at], asbytes=True))
            yield from packed_rows(out, _ASK)

    def settle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        d, m, at, frag, keys, sums, sizes, bodies, n = [], [], [], [], [], [], [], [], 0
        for batch in batches:
            for bucket, kind, docs, marks, idx, ints, k, s, text in zip(*(c.to_pylist() for c in batch.columns)):
                docs, marks = named(idx, docs, marks)
                flat = np.frombuffer(codec.decompress(ints[4:], 4 * int.from_bytes(ints[:4], "little"), asbytes=True), np.int32)
                if kind == _SETTLED:
                    place, z = np.split(flat[2:], [flat[0]])
                    yield from packets(docs, marks, place, z, buckets)
                    continue
                place, which, z = np.split(flat[3:], np.cumsum(flat[:2]))
                d.append(docs), m.append(marks), at.append(place)
                frag.append(np.cumsum(which, dtype=np.int64) + n)
                keys.append(unpack5(k) | np.uint64(bucket) << np.uint64(40))
                sums.append(np.frombuffer(s, np.uint64))
                sizes.append(z)
                bodies.append(codec.decompress(text, int(z.sum()), asbytes=True))
                n += len(z)
        if not n:
            return
        d, m, at, frag, keys, sums, size = (np.concatenate(x) for x in (d, m, at, frag, keys, sums, sizes))
        body = np.frombuffer(b"".join(bodies), np.uint8)
        bodies.clear()
        begin = np.cumsum(size, dtype=np.int64) - size
        order = np.lexsort((sums, keys))  # equal fragments collapse
        head = np.ones(n, bool)
        head[1:] = (keys[order][1:] != keys[order][:-1]) | (sums[order][1:] != sums[order][:-1])
        same = np.empty(n, np.int64)
        same[order] = np.cumsum(head) - 1
        lead = order[head]
        frag, keys, size, begin = same[frag], keys[lead], size[lead].astype(np.int64), begin[lead]
        holder = _least(frag, d, len(lead))
        gone = d > holder[frag]
        yield from packets(d[gone], m[gone], at[gone], size[frag[gone]], buckets)
        d, m, at, frag = d[~gone], m[~gone], at[~gone], frag[~gone]
        for pick in _batches(keys, size):
            reach = np.cumsum(size[pick])
            text = body[np.repeat(begin[pick] - (reach - size[pick]), size[pick]) + np.arange(int(reach[-1]))]
            pick, text = _meeting(pick, text, size, length)
            if not len(pick):
                continue
            offs = np.concatenate([[0], np.cumsum(size[pick])])
            own = np.repeat(holder[pick], size[pick])
            least = least_holders(text, offs, holder[pick], length)
            starts = np.flatnonzero((least >= 0) & (least < own))
            if not len(starts):
                continue
            cover = np.zeros(len(text) + 1, np.int64)
            cover[starts] += 1
            np.add.at(cover, starts + length, -1)
            mask = np.cumsum(cover)[:-1] > 0
            edge = np.zeros(len(mask) + 1, bool)
            edge[offs[:-1]] = True  # ranges end with their fragment
            change = np.flatnonzero(edge[:-1] | np.diff(np.concatenate([[0], mask.view(np.int8)])).astype(bool))
            stop = np.append(change[1:], len(mask))
            inside = mask[change]
            lo, hi = change[inside], stop[inside]
            f = np.searchsorted(offs, lo, side="right") - 1
            yield from _spread(pick[f], lo - offs[f], hi - lo, d, m, at, frag, buckets)

    settled = packed.mapInArrow(send, _ASK_DDL).repartitionById(buckets, "bucket").mapInArrow(settle, PACKET)
    return gathered(settled, buckets)


def _batches(keys: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
    """Different fragments of keys that have several, some 100 KB at a time; a
    key's fragments (in order already) stay together."""
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    many = np.repeat(np.diff(np.append(first, len(keys))) > 1, np.diff(np.append(first, len(keys))))
    pick = np.flatnonzero(many)
    if not len(pick):
        return
    total = np.cumsum(size[pick])
    fresh = np.flatnonzero(np.append(True, keys[pick][1:] != keys[pick][:-1]))
    part = (total - size[pick])[fresh] // _MERGE
    cut = fresh[np.flatnonzero(np.append(True, part[1:] != part[:-1]))]
    for lo, hi in zip(cut, np.append(cut[1:], len(pick))):
        yield pick[lo:hi]


def _meeting(pick: np.ndarray, text: np.ndarray, size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The fragments (and their text) with a string whose hash another one has."""
    offs = np.concatenate([[0], np.cumsum(size[pick])])
    ok = valid_starts(offs, len(text), length)
    at = np.flatnonzero(ok)
    hashes = byte_hashes(text, length)[at]
    frag = np.searchsorted(offs, at, side="right") - 1
    order = np.argsort(hashes, kind="stable")
    h, f = hashes[order], frag[order]
    twice = np.zeros(len(h), bool)
    same = (h[1:] == h[:-1])
    twice[1:] |= same
    twice[:-1] |= same
    keep = np.zeros(len(pick), bool)
    keep[f[twice]] = True
    return pick[keep], text[np.repeat(keep, size[pick])]


def _spread(f: np.ndarray, lo: np.ndarray, size: np.ndarray, d, m, at, frag,
            groups: int) -> Iterator[pa.RecordBatch]:
    """Ranges of fragments, given to every place of the fragment."""
    order = np.argsort(frag, kind="stable")
    left, right = np.searchsorted(frag[order], f, "left"), np.searchsorted(frag[order], f, "right")
    count = right - left
    which = np.repeat(np.arange(len(f)), count)
    place = order[np.repeat(left - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))]
    yield from packets(d[place], m[place], at[place] + lo[which], size[which], groups)


def remove_repeated_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored):
    doc_id, n_bytes, n_removed, n_spans, spans (``start:end`` byte ranges
    removed, comma-joined), kept_bytes, kept_sha256.

    A null text is empty. Rows with a null doc_id take no part: nothing of
    theirs is removed, and nothing because of them. Rows that share a doc_id
    never remove each other's bytes. Texts shorter than ``length`` stay whole.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    known = docs.where("doc_id is not null")
    buckets = buckets_of(docs)

    def grams(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for a, b in _slices(offs):
            hashes, _, spots = _anchors(buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a], length)
            at.append(np.searchsorted(offs, spots + offs[a], side="right") - 1)
            keys.append(hashes[spots])
        return np.concatenate(at), np.concatenate(keys)

    firsts, copies = text_copies(known)
    keys = shared_keys(known, grams).groupBy("mark").agg(F.collect_set("key").alias("keys"))
    packed = known.mapInArrow(pack_texts, PACKED).join(firsts.join(keys, "mark"), ["doc_id", "mark"])
    hits = repeated_ranges(packed, length, buckets)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in packed_blocks(batches):
            edge = np.zeros(len(buf) + 1, np.int64)
            copy = rows.column(rows.schema.get_field_index("copy")).to_pylist()
            for i in range(len(copy)):
                if copy[i] and offs[i + 1] - offs[i] >= length:
                    edge[offs[i]] += 1
                    edge[offs[i + 1]] -= 1
            row, start, size = ranges_of(rows)
            np.add.at(edge, offs[row] + start, 1)
            np.add.at(edge, offs[row] + start + size, -1)
            gone = np.cumsum(edge)[:-1] > 0
            removed = np.concatenate([[0], np.cumsum(gone)])[offs]
            kept_offs = offs - removed
            kept = buf[~gone].tobytes()
            texts, digests, spans, n_spans = [], [], [], []
            for i in range(len(offs) - 1):
                part = kept[kept_offs[i]:kept_offs[i + 1]]
                texts.append(part)
                digests.append(hashlib.sha256(part).hexdigest())
                if removed[i + 1] > removed[i]:
                    lo, hi = runs(gone[offs[i]:offs[i + 1]])
                    spans.append(",".join(f"{x}:{y}" for x, y in zip(lo, hi)))
                    n_spans.append(len(lo))
                else:
                    spans.append("")
                    n_spans.append(0)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(np.diff(offs)), pa.array(np.diff(removed)), pa.array(n_spans, type=pa.int64()),
                 pa.array(spans, type=pa.string()), pa.array(texts, type=pa.binary()), pa.array(digests, type=pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept_bytes", "kept_sha256"])

    joined = docs.mapInArrow(pack_texts, PACKED).join(hits, ["doc_id", "mark"], "left").join(copies, ["doc_id", "mark"], "left")
    return joined.select("doc_id", "mark", "size", "packed", "ranges", "copy").mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, spans string, kept_bytes binary, kept_sha256 string")


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated strings of 50 bytes removed from all documents."""
    found = remove_repeated_bytes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
