"""Mixing sources to target weights by pivotal dependent rounding.

A source's rate is its target over its size, both in words. Every document
gets the whole part of the rate as copies, and the fraction is rounded:
pairs of fractional copy probabilities transfer mass, at random and without
bias, until one of the two is integral. Mass is counted in words, so a
source's expected words stay exactly what they are at every transfer.

The transfers run as a reduction tree: blocks of about ``BLOCK`` documents of
a source, dealt by hash, reduce to one fractional residual each; residuals
are dealt to blocks again, until a source has a single residual, which is
rounded by itself. A source's taken words therefore miss its target by less
than one document; in a block long documents go first, so what stays
fractional is nearly always a short one. All draws are hashes, so reruns agree; all of it is
DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.llm.common import prepare, table, write_shared

BLOCK = 64
WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2.0
WORD = r"[^\x20\x09-\x0D]+"
KEY = ["doc_id", "mark", "source", "dup"]


def units(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, source, dup, size) per row of ``docs``: its words (null
    text: 0), a hash of the text, and a number that tells equal rows apart."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"),
                       F.col("source").cast("string").alias("source"),
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    return numbered(rows)


def numbered(rows: DataFrame) -> DataFrame:
    return rows.withColumn("dup", F.row_number().over(W.partitionBy("doc_id", "mark", "source").orderBy(F.lit(0))))


def targets(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target): ``share`` times all sizes dealt by
    weight (sources in code-point order, null last, weights repeating), none
    above ``most`` times its source's size, the excess dealt again.

    The fixed point of that resharing is least(cap, level * weight) with one
    level for all: with the sources in the order of cap / weight, the level
    after the first k are capped is what remains over the weights that remain.
    """
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(float(x)) for x in weights)),
                          ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = sums.select("source", "source_size", weight.alias("w"), (F.lit(most) * F.col("source_size")).alias("cap"))
    whole = W.partitionBy(F.lit(0))
    up_to = whole.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = up_to.rowsBetween(W.unboundedPreceding, -1)
    s = s.withColumn("left_mass", F.lit(share) * F.sum("source_size").over(whole)
                     - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    s = s.withColumn("left_w", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    s = s.withColumn("level", F.col("left_mass") / F.col("left_w"))
    # a source is capped while the level of its turn lifts it to its cap; the first that is not fixes the level
    s = s.withColumn("level1", F.first(F.when(F.col("level") * F.col("w") < F.col("cap"), F.col("level")), ignorenulls=True).over(
        up_to.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return s.select("source", "source_size",
                    F.coalesce(F.least(F.col("cap"), F.col("level1") * F.col("w")), F.col("cap")).alias("target"))


def _draw(*parts: Column) -> Column:
    """A uniform number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _transfer(state: Column, u: Column) -> Column:
    """One pairing of the carried unit with the next: mass moves up (to the
    carried) or down until one of them is integral; that one goes to ``done``
    and the other is carried."""
    c = state["c"]
    room_up = F.least(c["size"] * (1 - c["x"]), u["size"] * u["x"])
    room_down = F.least(c["size"] * c["x"], u["size"] * (1 - u["x"]))
    up = _draw(c["h"], u["h"]) * (room_up + room_down) < room_down
    carried_ends = F.when(up, c["size"] * (1 - c["x"]) <= u["size"] * u["x"]).otherwise(
        c["size"] * c["x"] <= u["size"] * (1 - u["x"]))
    sign = F.when(up, F.lit(1.0)).otherwise(F.lit(-1.0))
    moved = F.when(up, room_up).otherwise(room_down) * sign
    clip = lambda x: F.least(F.lit(1.0), F.greatest(F.lit(0.0), x))
    ended_c = c.withField("x", F.when(up, F.lit(1.0)).otherwise(F.lit(0.0)))
    ended_u = u.withField("x", F.when(up, F.lit(0.0)).otherwise(F.lit(1.0)))
    left_u = u.withField("x", clip(u["x"] - moved / u["size"]))
    left_c = c.withField("x", clip(c["x"] + moved / c["size"]))
    return F.struct(F.when(carried_ends, left_u).otherwise(left_c).alias("c"),
                    F.concat(state["done"], F.array(F.when(carried_ends, ended_c).otherwise(ended_u))).alias("done"))


def _reduce(level: DataFrame) -> DataFrame:
    """One level of the tree: rows (source, block, unit) to rows (source,
    unit, residual)."""
    blocks = level.groupBy("source", "block").agg(F.sort_array(F.collect_list("unit")).alias("us"))
    first = F.element_at("us", 1)
    state = F.aggregate(F.slice("us", 2, F.greatest(F.size("us") - 1, F.lit(1))),
                        F.struct(first.alias("c"), F.array_remove(F.slice("us", 1, 0), first).alias("done")), _transfer)
    out = blocks.select("source", state.alias("s"))
    return out.select("source", F.explode(F.concat(
        F.transform("s.done", lambda x: F.struct(x.alias("unit"), F.lit(False).alias("residual"))),
        F.array(F.struct(F.col("s.c").alias("unit"), F.lit(True).alias("residual"))))).alias("r")).select("source", "r.*")


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST,
                seed: int = 0) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source; other columns are
    ignored): doc_id, mark, source, dup, size, source_size, target, copies,
    taken.

    A null text has size 0 and no copies beyond the whole part of its
    source's rate, which take no words. Null sources are one source, last in
    order; a null doc_id is a document like any other; repeated rows are
    rounded each for itself. A source without words has target 0.
    """
    prepare(docs.sparkSession)
    rows = write_shared(units(docs), "mix-units")
    goal = write_shared(targets(rows, weights, share, most), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    dealt = (rows.join(goal, rows.source.eqNullSafe(goal.source))
             .drop(goal.source).withColumn("rate", rate).withColumn("base", F.floor("rate"))
             .withColumn("x", F.col("rate") - F.col("base")))
    unit = F.struct((-F.col("size")).alias("turn"), F.xxhash64(*KEY, F.lit(seed)).alias("h"), "doc_id", "mark", "dup",
                    F.col("size").cast("double").alias("size"), "x")
    whole = dealt.where("size = 0 or x = 0").select(*KEY, "size", "source_size", "target", "rate", F.lit(0.0).alias("x"))
    level = dealt.where("size > 0 and x > 0").select("source", unit.alias("unit"))
    settled, depth = [], 0
    while True:
        counts = level.groupBy("source").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("blocks"))
        counts = counts.withColumnRenamed("source", "s")
        cut = level.join(counts, F.col("source").eqNullSafe(F.col("s"))).drop("s")
        block = F.pmod(F.xxhash64("unit.h", F.lit(depth)), F.col("blocks"))
        done = write_shared(_reduce(cut.withColumn("block", block)), f"mix-level{depth}")
        settled.append(done.where("not residual").select("source", "unit"))
        level, depth = done.where("residual").select("source", "unit"), depth + 1
        if not level.groupBy("source").count().where("count > 1").take(1):
            break
    last = level.select("source", F.col("unit").withField(
        "x", F.when(_draw("unit.h", F.lit(seed), F.lit("last")) < F.col("unit.x"), 1.0).otherwise(0.0)).alias("unit"))
    for part in settled:
        last = last.unionByName(part)
    rounded = (last.join(goal.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select(
        "unit.doc_id", "unit.mark", "source", "unit.dup", F.col("unit.size").cast("long").alias("size"), "source_size",
        "target", rate.alias("rate"), F.col("unit.x").alias("x")))
    return (whole.unionByName(rounded).withColumn("copies", (F.floor("rate") + F.col("x")).cast("long"))
            .withColumn("taken", F.col("copies") * F.col("size"))
            .select(*KEY, "size", "source_size", "target", "copies", "taken"))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    copies = mix_sources(docs, **how).select(*KEY, "copies").where("copies > 0")
    on = [F.col(f"d.{k}").eqNullSafe(F.col(f"c.{k}")) for k in KEY]
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row")).select(
        F.col("row.doc_id").cast("long").alias("doc_id"), F.xxhash64("row.text").alias("mark"),
        F.col("row.source").cast("string").alias("source"), "row")
    joined = numbered(rows).alias("d").join(copies.alias("c"), on[0] & on[1] & on[2] & on[3])
    return joined.select(F.col("d.row").alias("row"), F.explode(F.sequence(F.lit(1), F.col("c.copies"))).alias("n")).select("row.*")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by weights 3, 1, 2 to 150 % of their words."""
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
