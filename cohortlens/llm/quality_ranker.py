"""Quality classifier: Bradley-Terry pairwise ranking.

A document's strength is linear in features of its text. Preference pairs (a
document labelled 1 beats one labelled 0) are learned by logistic loss on the
features' difference, so the labels' base rate plays no part; the threshold
is the quantile of the training scores that the labels' share of 0 gives, and
the reported score is a logistic curve through it (``THRESHOLD`` there).

Features come from one vectorised pass over the whole texts and are written
once; training reads those of every labelled row, scoring reads all. Rivals
and the threshold follow from places in a sorted order, which is dealt over
range partitions (``numbered``): no task sorts or gathers a whole class.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.llm.common import prepare, table, write_shared
from cohortlens.llm.kernels import runs, text_blocks, word_hashes, word_spans
from cohortlens.operators.ordering import running_totals

RIVALS = 3
THRESHOLD = 0.3
STEPS, RIDGE = 12, 1e-3
FEATURES = ("words", "word_length", "upper", "digits", "sentence_marks", "symbols", "symbol_ends", "symbol_words",
            "doubled", "repeated", "top_word", "long_runs", "symbol_tail", "line_words")

_CLASS = np.full(256, 4, np.uint8)  # 0 lower, 1 upper, 2 digit, 3 sentence mark, 4 symbol or control, 5 white, 6 not ASCII
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]] = 3
_CLASS[[32, 9, 10, 11, 12, 13]] = 5
_CLASS[128:] = 6


def _sums(mask: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[offs[1:]] - total[offs[:-1]]


def features_of(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """(documents, FEATURES) for a block; an empty text has zeros."""
    kinds = _CLASS[buf]
    starts, ends, wo = word_spans(buf, offs)
    n_docs, n_words = len(offs) - 1, np.diff(wo)
    per_word = np.maximum(n_words, 1)
    black = np.maximum(_sums(kinds != 5, offs), 1)
    doc = np.repeat(np.arange(n_docs), n_words)
    words = word_hashes(buf, starts, ends, lower=True)
    tail = kinds[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    letters = np.maximum(_sums(kinds <= 1, offs), 1)
    has_letter = np.concatenate([[0], np.cumsum((kinds <= 2) | (kinds == 6))])
    bare = has_letter[ends] == has_letter[starts]
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    order = np.lexsort((words, doc))
    head = np.ones(len(words), bool)
    head[1:] = (words[order][1:] != words[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    first = np.flatnonzero(head)
    top = np.zeros(n_docs, np.int64)
    if len(first):
        np.maximum.at(top, doc[order][first], np.diff(np.append(first, len(words))))
    distinct = np.bincount(doc[order][first], minlength=n_docs)
    lines = _sums(buf == 10, offs) + 1
    # two symbols in a row at a word's end
    double = np.zeros(len(ends), bool)
    if len(ends):
        long = ends - starts >= 2
        double = long & (kinds[np.maximum(ends - 2, 0)] >= 3) & (kinds[np.maximum(ends - 2, 0)] <= 4) & (tail >= 3) & (tail <= 4)
    lo, hi = runs(again)
    long_runs = np.bincount(doc[lo], weights=(hi - lo) * (hi - lo >= 3), minlength=n_docs) if len(lo) else np.zeros(n_docs)
    share = lambda flags: np.sqrt(np.bincount(doc, weights=flags, minlength=n_docs) / per_word)
    # square roots: the first few junk words of a text tell more than the next
    return np.column_stack([
        np.log1p(n_words), black / per_word, np.sqrt(_sums(kinds == 1, offs) / letters), np.sqrt(_sums(kinds == 2, offs) / black),
        _sums(kinds == 3, offs) / black, np.sqrt(_sums(kinds == 4, offs) / black), share(tail == 4), share(bare), share(again),
        1 - distinct / per_word, np.sqrt(np.maximum(top - 1, 0) / per_word), np.sqrt(long_runs / per_word), share(double),
        np.log1p(n_words / lines)]).astype(np.float64) * (n_words > 0)[:, None]


def text_features(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, x array<double>) per row of docs (doc_id, mark, text)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_blocks(batches):
            x = features_of(buf, offs)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), lists], names=["doc_id", "mark", "x"])

    return docs.select("doc_id", "mark", "text").mapInArrow(run, "doc_id long, mark long, x array<double>")


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0


def numbered(rows: DataFrame, group: str, order: str) -> DataFrame:
    """``rows`` with ``i``, a row's place (from 0) in the order of ``order``
    among those of its ``group``. Rows are sorted within range partitions and
    written with their place there; only one row a partition and group, where
    it begins, meets the others."""
    placed = write_shared(rows.repartitionByRange(group, order).sortWithinPartitions(group, order)
                          .withColumn("_at", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    starts = placed.groupBy("_part", group).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = starts.select("_part", group, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(starts), ["_part", group]).select(
        *rows.columns, (F.col("_before") + F.col("_at") - F.col("_first")).alias("i"))


def quantile(rows: DataFrame, value: str, share: float) -> float:
    """The exact quantile of ``value`` at ``share`` of the way, interpolated
    between its two neighbours, as ``percentile`` gives it. Equal values are
    counted first and are one row."""
    counts = running_totals(rows.groupBy(value).agg(F.count("*").alias("n")), F.col(value), ["n"], totals_prefix="all_")
    at = F.lit(float(share)) * (F.col("all_n") - 1)
    near = counts.where((F.col("cum_n") > F.floor(at)) & (F.col("cum_n") - F.col("n") <= F.ceil(at)))
    got = near.select(value, at.alias("at")).orderBy(value).collect()  # two rows at most
    part = got[0]["at"] - math.floor(got[0]["at"])
    return (1 - part) * got[0][value] + part * got[-1][value]


def preference_pairs(labelled: DataFrame, rivals: int = RIVALS) -> DataFrame:
    """(d array<double>): features of a document labelled 1 less those of one
    labelled 0; every 1 meets ``rivals`` zeros dealt by hash, every 0 at least
    as many ones."""
    ranked = numbered(labelled, "y", "h")
    ones, zeros = ranked.where("y = 1"), ranked.where("y = 0")
    sizes = {r["y"]: r["n"] for r in labelled.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not (sizes.get(1) and sizes.get(0)):
        return labelled.select(F.col("x").alias("d")).limit(0)
    pairs = None
    for k in range(rivals):
        for a, b, n in ((ones, zeros, sizes[0]), (zeros, ones, sizes[1])):
            met = a.withColumn("j", F.pmod(F.xxhash64("h", F.lit(k)), F.lit(n))).alias("a").join(
                b.alias("b"), F.col("a.j") == F.col("b.i"))
            sign = 1.0 if a is ones else -1.0
            d = met.select(F.zip_with("a.x", "b.x", lambda p, q: (p - q) * sign).alias("d"))
            pairs = d if pairs is None else pairs.unionByName(d)
    return pairs


def fit_strengths(pairs: DataFrame, size: int, steps: int = STEPS, ridge: float = RIDGE) -> np.ndarray:
    """Weights by Newton steps on the mean logistic loss; a step sums one
    gradient and one Hessian a partition."""
    weights = np.zeros(size)
    for _ in range(steps):
        def part(batches: Iterable[pa.RecordBatch], w: np.ndarray = weights) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size * size + size + 1)
            for batch in batches:
                d = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
                p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))  # that the loser would win
                total += np.concatenate([(d * p[:, None]).sum(0), ((d * (p * (1 - p))[:, None]).T @ d).ravel(), [len(d)]])
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["i", "v"])

        sums = pairs.select("d").mapInArrow(part, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
        got = np.array([r["v"] for r in sums.orderBy("i").collect()])
        if not len(got) or got[-1] == 0:
            return weights
        gradient = got[:size] / got[-1] - ridge * weights
        hessian = got[size:-1].reshape(size, size) / got[-1] + ridge * np.eye(size)
        move = np.linalg.solve(hessian, gradient)
        move *= min(1.0, 4.0 / max(1e-12, np.abs(move).max()))
        weights = weights + move
        if np.abs(move).max() < 1e-3:
            break
    return weights


def rank_quality(docs: DataFrame, labels: DataFrame, max_labelled: int | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored):
    doc_id, mark, held_out, score, predicted.

    Every labelled row is learned from, unless the caller bounds them: then
    about ``max_labelled`` at most, by hash. ``labels`` has doc_id and quality; rows whose crc32(doc_id) mod 5 is 0,
    null or other qualities and ids not in ``docs`` are not learned from. A
    null or empty text has zero features and a score like any other. Without
    labels of both kinds every score is the threshold. A null doc_id has a
    null held_out.
    """
    spark = docs.sparkSession
    prepare(spark)
    size = len(FEATURES)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    feats = write_shared(text_features(rows), "features")
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
             .where("y in (0, 1)").where(~held_out(F.col("doc_id"))).distinct())
    sample = feats.join(known, "doc_id").withColumn("h", F.xxhash64("doc_id", "mark"))
    total = feats.select("doc_id").join(known, "doc_id").count() if max_labelled is not None else 0
    if max_labelled is not None and total > max_labelled:  # a share of the hashes, so no task gathers more than its part of the sample
        sample = sample.where(F.pmod("h", F.lit(1 << 30)) < int((1 << 30) * max_labelled / total))
    sample = write_shared(sample.select("h", "x", "y"), "labelled")
    stats = sample.select("y", F.posexplode("x").alias("i", "v")).groupBy("i").agg(
        F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).orderBy("i").collect()
    mean = [r["m"] for r in stats] or [0.0] * size
    scale = [max(r["s"], 1e-6) for r in stats] or [1.0] * size

    def standard(x: str) -> Column:
        m, s = F.array(*map(F.lit, mean)), F.array(*map(F.lit, scale))
        z = F.zip_with(F.zip_with(x, m, lambda a, b: a - b), s, lambda a, b: a / b)
        return F.transform(z, lambda v: F.least(F.lit(8.0), F.greatest(F.lit(-8.0), v)))

    sample = sample.withColumn("x", standard("x"))
    pairs = write_shared(preference_pairs(sample), "pairs")
    weights = fit_strengths(pairs, size)

    def strength(x: Column | str) -> Column:
        w = F.array(*(F.lit(float(v)) for v in weights))
        return F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)

    graded = sample.select("y", strength("x").alias("g"))
    share = graded.agg(F.avg(1 - F.col("y")).alias("q")).first()["q"]
    cut = quantile(graded, "g", share) if share is not None else 0.0
    at = math.log(THRESHOLD / (1 - THRESHOLD)) + 1e-9
    score = 1 / (1 + F.exp(-(F.col("g") - F.lit(float(cut)) + F.lit(at))))
    return (feats.select("doc_id", "mark", held_out(F.col("doc_id")).alias("held_out"), strength(standard("x")).alias("g"))
            .select("doc_id", "mark", "held_out", score.alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def op7_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from labels.quality."""
    ranked = rank_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return ranked.select("doc_id", "held_out", "score", "predicted")
