"""Vectorised text kernels for the operators' Arrow tasks.

Every kernel works on one block: the UTF-8 bytes of a few documents, end to
end, with ``offs`` (n + 1 offsets). A block holds at most a few MB of text
(or one longer document), so a task's memory does not depend on the Arrow
batch or the partition it was given.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20
BLOCK_ROWS = 1 << 15

_WS = np.zeros(256, dtype=bool)
_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _table(seed: int) -> tuple[np.ndarray, np.uint64]:
    rng = np.random.default_rng(seed)
    table = rng.integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return table, np.uint64(int(rng.integers(1, 2**62)) * 2 + 1)


_TABLES = {seed: _table(seed) for seed in (1, 2)}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def string_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as the empty string."""
    if col.null_count:
        col = col.fill_null("")
    big = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    offs = np.frombuffer(off, dtype=np.int64 if big else np.int32)
    offs = offs[col.offset:col.offset + len(col) + 1].astype(np.int64)
    if data is None or not len(offs):
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    buf = np.frombuffer(data, dtype=np.uint8)[offs[0]:offs[-1]]
    return buf, offs - offs[0]


def text_blocks(batches: Iterable[pa.RecordBatch], column: str = "text",
                limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut Arrow batches into (rows, bytes, offsets) blocks of bounded size."""
    for batch in batches:
        buf, offs = string_bytes(batch.column(batch.schema.get_field_index(column)))
        n, row = batch.num_rows, 0
        while row < n:
            last = int(np.searchsorted(offs, offs[row] + limit, side="right")) - 1
            last = min(n, row + BLOCK_ROWS, max(last, row + 1))
            lo, hi = offs[row], offs[last]
            yield batch.slice(row, last - row), buf[lo:hi], offs[row:last + 1] - lo
            row = last


def pack_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, mark, text) to (doc_id, mark, size, packed): each text's bytes
    under zstd, which halves what a shuffle of whole texts writes."""
    codec = pa.Codec("zstd", compression_level=1)
    for rows, buf, offs in text_blocks(batches):
        packed = [codec.compress(buf[a:b], asbytes=True) if b > a else b"" for a, b in zip(offs[:-1], offs[1:])]
        yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(np.diff(offs)),
                                          pa.array(packed, type=pa.binary())], names=["doc_id", "mark", "size", "packed"])


PACKED = "doc_id long, mark long, size long, packed binary"


def packed_blocks(batches: Iterable[pa.RecordBatch], limit: int = BLOCK_BYTES
                  ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """``text_blocks`` over rows of ``pack_texts`` (with any further columns)."""
    codec = pa.Codec("zstd")
    for batch in batches:
        sizes = column(batch, "size")
        offs = np.concatenate([[0], np.cumsum(sizes)])
        n, row = batch.num_rows, 0
        packed = batch.column(batch.schema.get_field_index("packed"))
        while row < n:
            last = int(np.searchsorted(offs, offs[row] + limit, side="right")) - 1
            last = min(n, row + BLOCK_ROWS, max(last, row + 1))
            parts = [codec.decompress(packed[i].as_buffer(), int(sizes[i]), asbytes=True) if sizes[i] else b""
                     for i in range(row, last)]
            yield batch.slice(row, last - row), np.frombuffer(b"".join(parts), np.uint8), offs[row:last + 1] - offs[row]
            row = last


def column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A null-free long column as int64."""
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False).astype(np.int64)


def word_spans(buf: np.ndarray, offs: np.ndarray, gaps: np.ndarray = _WS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of ``[^\\x20\\x09-\\x0D]+`` words, and word offsets per
    document (n + 1). ``gaps`` says of each byte value whether it parts words."""
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    black = ~gaps[buf]
    first = black.copy()
    first[1:] &= ~black[:-1]
    last = black.copy()
    last[:-1] &= ~black[1:]
    cut = np.unique(offs[(offs > 0) & (offs < n)])
    first[cut] = black[cut]
    last[cut - 1] = black[cut - 1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs, side="left")


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1,
                lower: bool = False) -> np.ndarray:
    """One 64-bit hash per word, a function of its bytes alone."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    table, prime = _TABLES[seed]
    if lower:
        table = table[_LOWER]
    size = ends - starts
    first = np.cumsum(size) - size
    at = np.arange(int(size.sum()), dtype=np.int64)
    within = at - np.repeat(first, size)
    power = np.ones(int(size.max()), np.uint64)
    power[1:] = prime
    power = np.multiply.accumulate(power)
    value = table[buf[np.repeat(starts, size) + within]] * power[within]
    return mix(np.add.reduceat(value, first) + size.astype(np.uint64))


def window_hashes(words: np.ndarray, length: int, seed: int = 1) -> np.ndarray:
    """Hash of the ``length`` words from each position on (the last
    ``length - 1`` positions are left out)."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    prime = _TABLES[seed][1]
    out = words[:n].copy()
    for j in range(1, length):
        out = out * prime + words[j:j + n]
    return mix(out)


def valid_starts(counts_offs: np.ndarray, total: int, length: int) -> np.ndarray:
    """Which of the first ``total - length + 1`` positions start a window
    that stays inside its document."""
    n = total - length + 1
    if n <= 0:
        return np.zeros(0, bool)
    ok = np.zeros(total + 1, np.int64)
    lo, hi = counts_offs[:-1], np.maximum(counts_offs[1:] - length + 1, counts_offs[:-1])
    np.add.at(ok, lo, 1)
    np.add.at(ok, hi, -1)
    return np.cumsum(ok)[:n] > 0


def _sliding(x: np.ndarray, width: int, op) -> np.ndarray:
    """op over x[i : i + width], for every full window, by doubling."""
    span, out = 1, x
    while span * 2 <= width:
        out = op(out[:-span], out[span:])
        span *= 2
    return op(out[:len(out) - (width - span)], out[width - span:]) if span < width else out


def anchors(hashes: np.ndarray, offs: np.ndarray, gram: int, span: int) -> np.ndarray:
    """Positions of grams that hold the smallest hash (ties: all) of some run
    of ``span`` consecutive grams of one document.

    ``hashes`` has one value per position where a gram of ``gram`` units
    starts; ``offs`` are the unit offsets of the documents. Equal strings of
    ``gram + span - 1`` units have equal anchors, so two documents that share
    such a string share the hash of one of its anchors.
    """
    total = int(offs[-1])
    if total < gram + span - 1:
        return np.zeros(0, np.int64)
    low = _sliding(hashes, span, np.minimum)
    low = np.where(valid_starts(offs, total, gram + span - 1), low, np.uint64(0))
    pad = np.zeros(span - 1, np.uint64)
    high = _sliding(np.concatenate([pad, low, pad]), span, np.maximum)
    return np.flatnonzero((high == hashes) & (high > 0))


def byte_hashes(buf: np.ndarray, length: int, seed: int = 1) -> np.ndarray:
    """Hash of the ``length`` bytes from each position on."""
    n = len(buf) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    table, prime = _TABLES[seed]
    out, span = table[buf], 1
    bits = bin(length)[3:]
    base = out
    p = int(prime)
    for bit in bits:  # doubling: H(2s) = H(s) * p^s + H(s shifted)
        out = out[:-span] * np.uint64(pow(p, span, 2**64)) + out[span:]
        span *= 2
        if bit == "1":
            out = out[:-1] * prime + base[span:span + len(out) - 1]
            span += 1
    return mix(out)


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def joined_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, wo: np.ndarray, keep: np.ndarray) -> list[bytes]:
    """Each document's kept words, joined by one space."""
    first, size = starts[keep], (ends - starts)[keep]
    edge = np.concatenate([[0], np.cumsum(keep)])[wo]  # kept words before each document
    glued = size + 1
    glued[edge[1:][edge[1:] > edge[:-1]] - 1] -= 1     # no space after a document's last
    at = np.cumsum(glued) - glued
    out = np.full(int(glued.sum()), 0x20, np.uint8)
    within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(at, size) + within] = buf[np.repeat(first, size) + within]
    cuts = np.append(at, len(out))[edge]
    flat = out.tobytes()
    return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
