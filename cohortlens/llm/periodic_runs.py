"""Periodic runs of words, by catching squares over dyadic blocks.

A square is a stretch of 2q words whose halves are equal; squares of one
period that touch make a run. Every completed block of 2^k words that starts
at a multiple of 2^k has a catcher. Its catch is the periods 2^(k+1) to
2^(k+2) - 1 (from 1 on at k = 0): the first half of such a square holds a whole
block, and the block's words come again q words later. So each appended word
advances, on every level, the comparison of the last 2^k words with the few
blocks whose catch they are in, and a catcher ends once its catch is behind:
some 2 comparisons a word and level, by a hash of the 2^k words.

A block of texts is appended at once: all comparisons of one level and period
are one vector operation. Catches of one period in neighbouring blocks are
merged, and what is left is extended word-wise to both sides by halving steps
(it ends within a block, or a neighbour had caught too). A stretch of at least
two periods is a run; multiples of its period catch the same stretch, so the
smallest stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.common import prepare, table
from cohortlens.llm.kernels import joined_words, mix, text_blocks, word_hashes, word_spans

SHORTEST = 12
_CELLS = 1 << 21  # comparisons at once

_EMPTY = np.zeros(0, np.int64)


def _catches(hashes: np.ndarray, size: int, blocks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(period, first block, last block) of chains of blocks of ``size`` words
    that come again one period later. ``blocks``: starts of blocks, ascending."""
    low, high = (1, 4) if size == 1 else (2 * size, 4 * size)
    step = max(1, _CELLS // max(1, len(blocks)))
    for q in range(low, high, step):
        width = min(step, high - q)
        own = blocks[:np.searchsorted(blocks, len(hashes) - q)]
        if not len(own):
            return
        inside = own[:np.searchsorted(own, len(hashes) - q - width + 1)]
        again = sliding_window_view(hashes, width)[inside + q] if len(inside) else np.zeros((0, width), hashes.dtype)
        at, nth = np.nonzero(again == hashes[inside, None])
        found = [(nth + q, inside[at])]
        for block in own[len(inside):]:  # the last ones, which have fewer words behind them
            nth = np.flatnonzero(hashes[block + q:block + q + width] == hashes[block])
            found.append((nth + q, np.full(len(nth), block)))
        period, start = (np.concatenate(x) for x in zip(*found))
        if len(period):
            order = np.lexsort((start, period))
            period, start = period[order], start[order]
            first = np.ones(len(period), bool)
            first[1:] = (period[1:] != period[:-1]) | (start[1:] != start[:-1] + size)
            head = np.flatnonzero(first)
            yield period[head], start[head], start[np.append(head[1:], len(period)) - 1]


def word_runs(words: np.ndarray, offs: np.ndarray, shortest: int = SHORTEST
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, period) of all runs of at least ``shortest``
    words and two periods, by document, start and period. ``words`` are 64-bit
    hashes of the words of all documents, ``offs`` their offsets."""
    n_docs, sizes = len(offs) - 1, np.diff(offs)
    doc = np.repeat(np.arange(n_docs), sizes)
    ids = np.empty(len(words) + n_docs, np.uint64)  # a border of its own after every document
    place = np.arange(len(words)) + doc
    ids[place] = words
    border = offs[1:] + np.arange(n_docs)
    ids[border] = mix(np.arange(1, n_docs + 1, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D))
    reach = np.repeat(sizes, sizes + 1)  # words of the document of a position
    levels, found, size = [ids], [], 1
    while size == 1 or (reach >= max(shortest, 4 * size)).any():
        hashes = levels[-1]
        blocks = np.arange(0, len(hashes), size)
        blocks = blocks[reach[blocks] >= max(shortest, 4 * size if size > 1 else 2)]
        for period, lo, last in _catches(hashes, size, blocks):
            hi = last + size
            for k in range(len(levels) - 2, -1, -1):
                step, h = 1 << k, levels[k]
                at = lo - step
                lo = np.where((at >= 0) & (h[np.maximum(at, 0)] == h[np.maximum(at, 0) + period]), at, lo)
                far = np.minimum(hi + period, len(h) - 1)
                hi = np.where((hi + period < len(h)) & (h[np.minimum(hi, far)] == h[far]), hi + step, hi)
            long = (hi - lo >= period) & (hi - lo + period >= shortest)
            found.append((lo[long], hi[long] + period[long], period[long]))
        if 2 * size >= len(ids):
            break
        h = levels[-1]
        levels.append(mix(h[:len(h) - size] * np.uint64(0xD6E8FEB86659FD93) + h[size:]))
        size *= 2
    if not found:
        return (_EMPTY,) * 4
    lo, hi, period = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((period, hi, lo))
    lo, hi, period = lo[order], hi[order], period[order]
    smallest = np.ones(len(lo), bool)
    smallest[1:] = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    lo, hi, period = lo[smallest], hi[smallest], period[smallest]
    own = np.searchsorted(border, lo)
    start = lo - (offs[:-1] + np.arange(n_docs))[own]
    order = np.lexsort((period, start, own))
    return own[order], start[order], (hi - lo)[order], period[order]


_RUN = "array<struct<start:long,length:long,period:long>>"


def find_runs(docs: DataFrame, shortest: int = SHORTEST, keep_text: bool = True) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored):
    doc_id, n_words, runs (word number of the start, length, smallest period;
    by start, then period), collapsed_sha256 and, with ``keep_text``,
    collapsed: the words but those that some run holds after its first
    period, joined by one space.

    A null or empty text has no words and no runs. Null, repeated and shared
    doc_ids are rows like any other; equal rows give equal results. Memory
    follows the longest text: some 8 bytes a word and level, a level for each
    doubling of its length.
    """
    prepare(docs.sparkSession)
    schema = f"doc_id long, n_words long, runs {_RUN}, collapsed_sha256 string" + ", collapsed string" * keep_text

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_blocks(batches):
            starts, ends, wo = word_spans(buf, offs)
            doc, start, length, period = word_runs(word_hashes(buf, starts, ends), wo, shortest)
            gone = np.zeros(len(starts) + 1, np.int64)
            np.add.at(gone, wo[doc] + start + period, 1)
            np.add.at(gone, wo[doc] + start + length, -1)
            texts = joined_words(buf, starts, ends, wo, np.cumsum(gone)[:-1] == 0)
            runs = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(doc, np.arange(len(wo))), type=pa.int32()),
                pa.StructArray.from_arrays([pa.array(x, type=pa.int64()) for x in (start, length, period)], names=["start", "length", "period"]))
            out = [rows.column(0), pa.array(np.diff(wo)), runs, pa.array([hashlib.sha256(t).hexdigest() for t in texts], type=pa.string())]
            names = ["doc_id", "n_words", "runs", "collapsed_sha256"]
            if keep_text:
                out, names = [*out, pa.array(texts, type=pa.binary()).cast(pa.string())], [*names, "collapsed"]
            yield pa.RecordBatch.from_arrays(out, names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(find, schema)


def with_repeats(docs: DataFrame) -> DataFrame:
    """The texts that the query is asked of: every tenth document (by the
    CRC-32 of its id) goes on periodically from one of its words."""
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    first = g % F.size("w")
    period = 1 + F.floor((F.size("w") - first) / (3 + g % 8))
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", g.alias("g"), F.when(h % 10 == 0, words).alias("w"))
    chosen = chosen.select("doc_id", "text", "w", F.when(F.size("w") > 0, F.struct(first.alias("a"), period.alias("p"))).alias("r"))
    at = lambda i: F.when(i < F.col("r.a"), i).otherwise(F.col("r.a") + (i - F.col("r.a")) % F.col("r.p"))
    turned = F.transform(F.sequence(F.lit(0).cast("long"), F.size("w").cast("long") - 1), lambda i: F.get("w", at(i).cast("int")))
    return chosen.select("doc_id", F.when(F.col("r").isNotNull(), F.array_join(turned, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents' words, after ``with_repeats``."""
    found = find_runs(with_repeats(table(spark, sf_dir, "documents")), keep_text=False)
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    return found.withColumn("top", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"), (-F.col("top.n")).alias("length"), F.col("top.period").alias("period"),
        F.floor(1000 * -F.col("top.n") / F.col("top.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"), "collapsed_sha256")
