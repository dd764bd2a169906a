"""Benchmark decontamination with a generalised suffix automaton.

The normalised test items become a generalised suffix automaton over words.
Training texts are streamed through it word by word; the state's length is the
longest suffix of what was read that some item holds. Where it reaches the
window (or a whole item shorter than that ends), the words are hit.
``clean_documents`` removes hit spans beyond a length limit and whole
documents beyond a coverage limit.

The items are cut into shards of bounded size, each shard's automaton is built
by one task and has a known number of bytes; as many as fit ``GROUP_BYTES`` go
along with one pass over the documents. More items mean more passes in the
same narrow stage, each adding to what the one before has found, so neither
the documents nor what is found about them cross a shuffle.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.automaton import Automaton, Lookup
from cohortlens.llm.common import prepare, table, write_shared
from cohortlens.llm.kernels import runs, string_bytes, text_blocks, word_hashes, word_spans

WINDOW = 10
SHARD_WORDS = 100_000   # words of an automaton: some 25 MB with its tables
GROUP_BYTES = 64 << 20  # automata that go along with one pass

# Bytes outside the words 0-9, a-z and all of U+0080 on; A-Z count as a-z.
GAPS = np.ones(256, bool)
GAPS[0x30:0x3A] = GAPS[0x41:0x5B] = GAPS[0x61:0x7B] = GAPS[0x80:] = False


def _words(buf: np.ndarray, offs: np.ndarray, seed: int = 1):
    starts, ends, wo = word_spans(buf, offs, GAPS)
    return starts, ends, wo, word_hashes(buf, starts, ends, seed, lower=True)


def _pieces(window: int, most: int):
    """(item_id, text) to pieces of at most ``most`` words; neighbours share
    ``window - 1`` words, so every window lies in a piece."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_blocks(batches):
            starts, ends, wo = word_spans(buf, offs, GAPS)
            ids, sizes, texts = [], [], []
            for item, lo, hi in zip(rows.column(0).to_pylist(), wo[:-1], wo[1:]):
                for a in range(lo, max(min(lo + 1, hi), hi - window + 1), most - window + 1):
                    b = min(hi, a + most)
                    ids.append(item)
                    sizes.append(int(b - a))
                    texts.append(buf[starts[a]:ends[b - 1]].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, type=pa.string()), pa.array(sizes, type=pa.int64()),
                                              pa.array(texts, type=pa.binary()).cast(pa.string())], names=["item_id", "size", "text"])

    return cut


def _dump(items: pa.Table, window: int) -> bytes:
    """The automaton of a shard's items, with its vocabulary and item ids."""
    buf, offs = string_bytes(items.column("text").combine_chunks())
    _, _, wo, hashes = _words(buf, offs)
    again = _words(buf, offs, 2)[3]
    vocabulary, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    names = items.column("item_id").to_pylist()
    known = sorted({x for x in names if x is not None})
    at = {x: i for i, x in enumerate(known)}
    owners = np.array([at.get(x, len(known)) for x in names], np.int64)
    automaton = Automaton([number[a:b] for a, b in zip(wo[:-1], wo[1:])], owners, window)
    return pickle.dumps((Lookup(vocabulary), again[first], automaton, [*known, None]), protocol=5)


def automata(items: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(shard, n_bytes, automaton) of test items (item_id, text), written to
    the shared folder. A null text has no words; a null item_id has windows but
    counts as no item; rows that share an item_id are one item."""
    spark = items.sparkSession
    prepare(spark)
    most = max(2 * window, shard_words // 2)
    pieces = write_shared(items.select(F.col("item_id").cast("string").alias("item_id"), "text")
                          .mapInArrow(_pieces(window, most), "item_id string, size long, text string").distinct(), "items")
    shards = max(1, -(-(pieces.agg(F.sum("size")).first()[0] or 0) // most))
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(shards))

    def build(items: pa.Table) -> pa.Table:
        dump = _dump(items, window)
        return pa.table({"shard": items.column("shard")[:1], "n_bytes": [len(dump)], "automaton": pa.array([dump], pa.binary())})

    return write_shared(pieces.withColumn("shard", shard).groupBy("shard")
                        .applyInArrow(build, "shard long, n_bytes long, automaton binary"), "automata")


_FOUND = "n_words long, ranges array<struct<start:int,end:int>>, items array<string>"
_RANGE = pa.struct([("start", pa.int32()), ("end", pa.int32())])


def _matched(block, loaded: list) -> tuple[np.ndarray, np.ndarray, dict[int, set[str]], np.ndarray]:
    """(row, hit words mask's flags, items by row, word offsets) of a block."""
    rows, buf, offs = block
    starts, ends, wo, hashes = _words(buf, offs)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(wo))
    place = np.arange(len(starts)) + doc  # one border after each document
    edge = np.zeros(len(starts) + len(offs), np.int64)
    items: dict[int, set[str]] = {}
    for vocabulary, again, automaton, names in loaded:
        ids = np.full(len(starts) + len(offs) - 1, -1, np.int64)
        ids[place] = vocabulary(hashes)
        while True:
            end, long, state = automaton.windows(ids)
            mask = np.zeros(len(ids) + 1, np.int64)
            np.add.at(mask, end + 1 - long, 1)
            np.add.at(mask, end + 1, -1)
            hit = np.flatnonzero((np.cumsum(mask)[:-1] > 0)[place])
            # a word of a match is compared by a second hash; one that differs is of no item
            wrong = hit[word_hashes(buf, starts[hit], ends[hit], 2, lower=True) != again[ids[place[hit]]]]
            if not len(wrong):
                break
            ids[place[wrong]] = -1
        edge[:len(mask)] += mask
        of_place = np.full(len(ids), -1, np.int64)
        of_place[place] = doc
        for row, owner in zip(*(x.tolist() for x in automaton.owners_of(of_place[end], state))):
            if names[owner] is not None:
                items.setdefault(row, set()).add(names[owner])
    return wo, (np.cumsum(edge)[:-1] > 0)[place], items, doc


def _pass(dumps: list[bytes]):
    """Adds the findings of some automata to rows (..., text, n_words,
    ranges, items)."""

    def match(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = [pickle.loads(x) for x in dumps]
        for block in text_blocks(batches):
            rows = block[0]
            wo, hit, items, doc = _matched(block, loaded)
            before = rows.column(rows.schema.get_field_index("ranges"))
            earlier = rows.column(rows.schema.get_field_index("items")).to_pylist()
            for i, x in enumerate(before.to_pylist()):
                for r in x or ():
                    hit[wo[i] + r["start"]:wo[i] + r["end"]] = True
            flags = np.zeros(len(hit) + len(wo), bool)  # one border after each document
            flags[np.arange(len(hit)) + doc] = hit
            lo, hi = runs(flags)
            border = wo[1:] + np.arange(len(wo) - 1)
            row = np.searchsorted(border, lo)
            base = (wo[:-1] + np.arange(len(wo) - 1))[row]
            ranges = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(row, np.arange(len(wo))), type=pa.int32()),
                pa.StructArray.from_arrays([pa.array(lo - base, type=pa.int32()), pa.array(hi - base, type=pa.int32())], fields=list(_RANGE)))
            named = pa.array([sorted(items.get(i, set()).union(x or ())) for i, x in enumerate(earlier)], type=pa.list_(pa.string()))
            found = {"n_words": pa.array(np.diff(wo)), "ranges": ranges, "items": named}
            yield pa.RecordBatch.from_arrays([found.get(f.name, rows.column(i)) for i, f in enumerate(rows.schema)], names=rows.schema.names)

    return match


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS,
                  group_bytes: int = GROUP_BYTES, keep_text: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored):
    doc_id, n_words, ranges (hit words as [start, end), merged, ascending),
    items (distinct ids with occurring windows, sorted as strings), and the
    text with ``keep_text``.

    A window is ``window`` consecutive words of an item, or a whole item of
    fewer words; items without words, and null texts, have none. Null,
    repeated and shared doc_ids are rows like any other. With no items
    nothing is hit.
    """
    built = automata(items, window, shard_words)
    groups, size = [[]], 0
    for shard, n in built.select("shard", "n_bytes").orderBy("shard").collect():  # a number a shard
        if groups[-1] and size + n > group_bytes:
            groups.append([])
            size = 0
        groups[-1].append(shard)
        size += n
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.lit(0).cast("long").alias("n_words"),
                       F.lit(None).cast("array<struct<start:int,end:int>>").alias("ranges"), F.lit(None).cast("array<string>").alias("items"))
    for i, group in enumerate(groups):  # at most group_bytes, or one automaton, at a time
        dumps = [bytes(r[0]) for r in built.where(F.col("shard").isin(group)).orderBy("shard").select("automaton").collect()] if group else []
        last = i == len(groups) - 1 and not keep_text
        match = _pass(dumps)
        rows = rows.mapInArrow(_without_text(match) if last else match, f"doc_id long, {'' if last else 'text string, '}{_FOUND}")
    return rows


def _without_text(match):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in match(batches):
            yield batch.drop_columns(["text"])

    return run


def clean_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW, longest_span: int = WINDOW - 1,
                    most_covered: float = 0.5, shard_words: int = SHARD_WORDS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(doc_id, text, n_words, n_removed, coverage) of the documents that
    stay: hit spans of more than ``longest_span`` words are cut out of the text
    (from the first word's first to the last word's last byte); documents of
    which more than ``most_covered`` of the words are hit go whole. Null,
    empty and clean texts stay as they are."""
    found = contamination(docs, items, window, shard_words, group_bytes, keep_text=True)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_blocks(batches):
            spans = rows.column(rows.schema.get_field_index("ranges")).to_pylist()
            old = rows.column(rows.schema.get_field_index("text"))
            texts, removed, covered = [], [], []
            starts, ends, wo = word_spans(buf, offs, GAPS)
            for i, found in enumerate(spans):
                n = int(wo[i + 1] - wo[i])
                gone = [(x["start"], x["end"]) for x in found or () if x["end"] - x["start"] > longest_span]
                covered.append(sum(x["end"] - x["start"] for x in found or ()) / n if n else 0.0)
                removed.append(sum(b - a for a, b in gone))
                if not gone:
                    texts.append(old[i].as_py())
                    continue
                at, parts = offs[i], []
                for a, b in gone:
                    parts.append(buf[at:starts[wo[i] + a]].tobytes())
                    at = ends[wo[i] + b - 1]
                texts.append(b"".join([*parts, buf[at:offs[i + 1]].tobytes()]).decode())
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(texts, type=pa.string()), rows.column(rows.schema.get_field_index("n_words")),
                 pa.array(removed, type=pa.int64()), pa.array(covered, type=pa.float64())],
                names=["doc_id", "text", "n_words", "n_removed", "coverage"])

    return (found.mapInArrow(cut, "doc_id long, text string, n_words long, n_removed long, coverage double")
            .where(F.col("coverage") <= most_covered))


def op12_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' words inside 10-word windows (or whole shorter items) of
    the benchmark."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("ranges", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))
