"""L2-penalised logistic regression on sparse samples.

Samples are rows ``(<id>, y double, x array<struct<i int, v double>>)`` (see
``cohortlens.sources.svmlight.parse_svmlight``), the id unique
(``with_sample_id``). A model is a weights table ``(feature_index int, weight
double)``; absent features weigh 0. Rows with a null label are left out of
training (and of its sample count); scoring keeps them.

* ``score`` / ``classify``: explode the features, join the weights (broadcast
  after a size check, shuffle join beyond it), sum per sample.
* ``train_gd``: full-batch gradient descent; each step is a hash aggregation
  per sample and one per feature with map-side partial sums. A different
  algorithm from the original single-pass SGD (it averages the gradient over
  all samples).
* ``train_sgd``: the original per-sample SGD step, run sequentially inside
  hash shards of bounded size and mixed by averaging (parameter mixing;
  Zinkevich et al. 2010, McDonald et al. 2010). One shard is the sequential
  algorithm; more are an approximation of it.

Update rules: ``rule='textbook'`` is w_i += eta * x_i * (y - sigma(w.x));
``rule='as_coded'`` reproduces the original tool's code, which uses
sigma(|w.x|) and w_i += eta * (y - x_i * sigma). Both then shrink every
weight by (1 - 2 * eta * mu).
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.functions import sigmoid
from cohortlens.operators.exact import exact_sum
from cohortlens.operators.joins import DEFAULT_BROADCAST_BYTES, broadcast_if_small
from cohortlens.session import checkpoint_dir, ship_package
from cohortlens.sources.folders import write_once

RULES = ("textbook", "as_coded")
# Defaults of the original training command: step size and L2 strength.
DEFAULT_ETA = 0.01
DEFAULT_MU = 0.0
# Samples of one SGD shard, about: a task holds one shard's weights at a time.
ROWS_PER_SHARD = 50_000
# Samples of one SGD task, about, where shards are small: it takes several in turn.
ROWS_PER_TASK = 100_000

WEIGHTS_SCHEMA = T.StructType([
    T.StructField("feature_index", T.IntegerType(), False),
    T.StructField("weight", T.DoubleType(), False),
])


def zero_weights(spark) -> DataFrame:
    """The initial model: no stored weight, i.e. every weight 0."""
    return spark.createDataFrame([], WEIGHTS_SCHEMA)


def _weights_side(weights: DataFrame, broadcast_bytes: int | None) -> DataFrame:
    w = weights.select(F.col("feature_index").alias("_fi"), F.col("weight").alias("_w"))
    return broadcast_if_small(w, broadcast_bytes) if broadcast_bytes is not None else w


def margins(samples: DataFrame, weights: DataFrame, id_col: str = "sample_id",
            broadcast_bytes: int | None = DEFAULT_BROADCAST_BYTES, exact: bool = True) -> DataFrame:
    """(id, y, margin) with margin = sum_i w_i * v_i; no features -> 0.

    ``id_col`` must be unique (``with_sample_id``). With ``exact`` the
    products are summed by ``exact_sum``, as the original's compensated sum
    does it: the same bits on any partitioning. Without it by a plain partial
    aggregation, whose last digits follow the order of the rows; input
    hash-partitioned by the id is summed without a shuffle either way."""
    exploded = samples.select(id_col, "y", F.explode_outer("x").alias("_e"))
    joined = exploded.join(_weights_side(weights, broadcast_bytes),
                           F.col("_e.i") == F.col("_fi"), "left")
    terms = joined.select(id_col, "y", (F.col("_w") * F.col("_e.v")).alias("_t"))
    if exact:
        sums = exact_sum(terms, [id_col], "_t", "margin", carry=("y",))
    else:
        sums = terms.groupBy(id_col).agg(F.first("y").alias("y"), F.sum("_t").alias("margin"))
    return sums.select(id_col, "y", F.coalesce("margin", F.lit(0.0)).alias("margin"))


def score(samples: DataFrame, weights: DataFrame, id_col: str = "sample_id",
          broadcast_bytes: int | None = DEFAULT_BROADCAST_BYTES, exact: bool = True) -> DataFrame:
    """(id, y, margin, prob) with prob = 1 / (1 + e^-margin), one row for
    each sample; ``exact`` as for ``margins``."""
    m = margins(samples, weights, id_col, broadcast_bytes, exact)
    return m.withColumn("prob", sigmoid(F.col("margin")))


def classify(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Add ``prediction`` = 1 iff prob > threshold (strict: 0.5 -> 0)."""
    return scored.withColumn("prediction",
                             F.when(F.col("prob") > threshold, F.lit(1)).otherwise(F.lit(0)))


def check_feature_range(samples: DataFrame, n_feature: int) -> None:
    """Raise if an index is negative or >= n_feature (one aggregation)."""
    row = samples.select(F.explode("x").alias("e")).agg(
        F.min("e.i").alias("lo"), F.max("e.i").alias("hi")).first()
    if row is not None and row["hi"] is not None and (row["lo"] < 0 or row["hi"] >= n_feature):
        raise IndexError(f"feature index outside [0, {n_feature}): {row['lo']}..{row['hi']}")


def _residual(y: Column, margin: Column, v: Column, rule: str) -> Column:
    if rule == "textbook":
        return v * (y - sigmoid(margin))
    if rule == "as_coded":
        return y - v * sigmoid(F.abs(margin))
    raise ValueError(f"rule must be one of {RULES}")


def gd_step(samples: DataFrame, weights: DataFrame, eta: float, mu: float,
            n_samples: int, id_col: str = "sample_id", rule: str = "textbook",
            broadcast_bytes: int | None = DEFAULT_BROADCAST_BYTES, exact: bool = False) -> DataFrame:
    """One full-batch step: w <- (w + eta / N * g) * (1 - 2 eta mu) with
    g_i = sum over samples of the per-sample update term of feature i.

    Margins are a hash aggregation per sample; a hash join by sample brings
    them back to the features. On samples that are hash-partitioned by the id
    neither shuffles or sorts the exploded features. With ``exact`` the margins
    and the gradient are sums that do not depend on the partitioning, so that
    the weights are the same bits on any."""
    known = samples.where(F.col("y").isNotNull())
    m = margins(known, weights, id_col, broadcast_bytes, exact).select(id_col, "margin")
    exploded = (known.select(id_col, "y", F.explode("x").alias("_e"))
                .where(F.col("_e.i").isNotNull() & F.col("_e.v").isNotNull()))
    with_margin = exploded.join(m.hint("shuffle_hash"), id_col)
    term = _residual(F.col("y"), F.col("margin"), F.col("_e.v"), rule)
    terms = with_margin.select(F.col("_e.i").alias("feature_index"), term.alias("_t"))
    if exact:
        grad = exact_sum(terms, ["feature_index"], "_t", "_g")
    else:
        grad = terms.groupBy("feature_index").agg(F.sum("_t").alias("_g"))
    shrink = 1.0 - 2.0 * eta * mu
    old = weights.select("feature_index", F.col("weight").alias("_old"))
    return old.join(grad, "feature_index", "full_outer").select(
        F.col("feature_index").cast("int").alias("feature_index"),
        ((F.coalesce(F.col("_old"), F.lit(0.0))
          + F.lit(eta / max(n_samples, 1)) * F.coalesce(F.col("_g"), F.lit(0.0)))
         * F.lit(shrink)).alias("weight"))


def train_gd(samples: DataFrame, steps: int, eta: float = DEFAULT_ETA, mu: float = DEFAULT_MU,
             id_col: str = "sample_id", rule: str = "textbook",
             weights: DataFrame | None = None, colocate: bool = True, exact: bool = False) -> DataFrame:
    """``steps`` full-batch steps from zero weights (or ``weights``).

    The labelled samples are hash-partitioned by id once (``colocate``; skip
    it for input already partitioned by id) and persisted (memory and disk)
    while the steps run. Each step's weight table, at most one row per
    feature, is written with a reliable checkpoint: the next step's size check
    and join read it, and the lineage stays one step long. N counts labelled
    samples.
    """
    spark = samples.sparkSession
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    checkpoint_dir(spark)
    data = samples.select(id_col, "y", "x").where(F.col("y").isNotNull())
    if colocate:
        data = data.repartition(id_col)
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = data.count()
        w = weights if weights is not None else zero_weights(spark)
        for _ in range(steps):
            w = gd_step(data, w, eta, mu, n, id_col, rule, exact=exact).checkpoint(eager=True)
    finally:
        data.unpersist()
    return w


# ---------------------------------------------------------------- SGD ----

class _Shard:
    """One shard's sequential pass: weights of the features that occur in it,
    carried from batch to batch. The shrink of weights that a sample does not
    touch is put off until one does, and made up for at the end."""

    def __init__(self, features: np.ndarray, weights: np.ndarray, eta: float, mu: float, rule: str):
        self.features, self.start, self.w = features, weights, weights.copy()
        self.seen, self.n = np.zeros(len(features)), 0
        self.eta, self.shrink, self.rule = eta, 1.0 - 2.0 * eta * mu, rule

    def learn(self, ys: np.ndarray, offsets: np.ndarray, features: np.ndarray, values: np.ndarray) -> None:
        index, w, r = np.searchsorted(self.features, features), self.w, self.shrink
        for k, y in enumerate(ys):
            own = slice(offsets[k], offsets[k + 1])
            i, v = index[own], values[own]
            w[i] *= r ** (self.n - self.seen[i])
            margin = math.fsum((w[i] * v).tolist())
            if self.rule == "textbook":
                move = v * (y - 1.0 / (1.0 + np.exp(-margin)))
            else:
                move = y - v / (1.0 + np.exp(-abs(margin)))
            np.add.at(w, i, self.eta * move)
            w[i] *= r
            self.n += 1
            self.seen[i] = self.n

    def deltas(self, limit: int = 100_000) -> Iterator[pa.RecordBatch]:
        """The end weights less what shrinking alone would have left."""
        moved = self.w * self.shrink ** (self.n - self.seen) - self.start * self.shrink ** self.n
        for lo in range(0, len(moved), limit):
            yield pa.RecordBatch.from_arrays([pa.array(self.features[lo:lo + limit], pa.int32()), pa.array(moved[lo:lo + limit], pa.float64())],
                                             names=["feature_index", "delta"])


def _sgd_stream(eta: float, mu: float, rule: str):
    """Rows sorted by shard, weights before samples, to the shards' deltas: a
    task holds one shard's weights and one batch of samples."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state, known = None, None, []

        def begun() -> _Shard:
            parts = [(np.asarray(b.column("feature_index")), np.asarray(b.column("weight"))) for b in known]
            features, weights = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int32), np.zeros(0))
            known.clear()
            return _Shard(features, weights, eta, mu, rule)

        for batch in batches:
            shard, sample = np.asarray(batch.column("shard")), np.asarray(batch.column("kind")) == 1
            cuts = np.flatnonzero((shard[1:] != shard[:-1]) | (sample[1:] != sample[:-1])) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(shard)]):
                if hi == lo:
                    continue
                if shard[lo] != own:
                    if state is not None:
                        yield from state.deltas()
                    own, state = shard[lo], None
                    known.clear()
                part = batch.slice(lo, hi - lo)
                if not sample[lo]:
                    known.append(part)
                    continue
                if state is None:
                    state = begun()
                lists, values = part.column("xi"), part.column("xv")
                offsets = np.asarray(lists.offsets).astype(np.int64)
                state.learn(np.asarray(part.column("y")), offsets - offsets[0], np.asarray(lists.flatten()), np.asarray(values.flatten()))
        if state is not None:
            yield from state.deltas()

    return run


def shard_of(id_col: Column, shards: int) -> Column:
    """Shard number by md5, the same in any engine that has it."""
    return F.pmod(F.conv(F.substring(F.md5(id_col.cast("string")), 1, 8), 16, 10).cast("long"), F.lit(shards)).cast("int")


def train_sgd(samples: DataFrame, n_feature: int, eta: float = DEFAULT_ETA,
              mu: float = DEFAULT_MU, shards: int | None = None, epochs: int = 1,
              id_col: str = "sample_id", rule: str = "textbook",
              weights: DataFrame | None = None, rows_per_shard: int = ROWS_PER_SHARD,
              validate: bool = True, order_col: str | None = None) -> DataFrame:
    """Sharded SGD with parameter mixing; returns (feature_index, weight).

    Labelled samples go to shards by md5 of the id; their number follows the
    samples (``rows_per_shard`` each, about) unless given. A task takes several
    small shards one after the other (``ROWS_PER_TASK``); the samples are
    computed once. A shard runs the
    sequential step over its samples in the order of ``order_col`` (ties, and
    without it, by id): rows are sorted within their shard by Spark and stream
    through the task, which holds one batch and weights for the features that
    occur in the shard. With ``shards=1`` and the lines' place in their file
    (``sources.file_order``) that is the original's single pass in file order.
    The new weights are the mean over the non-empty shards. Weights travel as
    rows ahead of the samples that use them: no dense vector anywhere, no bound
    on the features.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    spark = samples.sparkSession
    ship_package(spark)
    checkpoint_dir(spark)
    fine = F.filter("x", lambda e: e["i"].isNotNull() & e["v"].isNotNull())
    place = [F.col(order_col).alias("_place")] if order_col else []
    samples = write_once(samples.select(F.col(id_col).alias("_id"), *place, "y", "x"), "sgd-samples")
    if validate:
        check_feature_range(samples, n_feature)
    data = samples.where(F.col("y").isNotNull()).withColumn("x", fine)
    n = data.count()
    k = shards or max(1, -(-n // rows_per_shard))
    tasks = min(k, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // ROWS_PER_TASK)))
    data = data.select(shard_of(F.col("_id"), k).alias("shard"), F.lit(1).alias("kind"), *(["_place"] if place else []), "_id", "y",
                       F.col("x.i").alias("xi"), F.col("x.v").alias("xv"))
    uses = data.select("shard", F.explode("xi").alias("feature_index")).distinct()
    used = data.select("shard").distinct().count()
    sizes = data.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    whole = sizes.agg(F.sum(F.pow(F.lit(1.0 - 2.0 * eta * mu), F.col("n"))).alias("s")).first()["s"] or 0.0
    order = ["shard", "kind", "feature_index", *(["_place"] if place else []), "_id"]

    w = weights if weights is not None else zero_weights(spark)
    for _ in range(epochs):
        start = (uses.join(w, "feature_index", "left")
                 .select("shard", F.lit(0).alias("kind"), "feature_index", F.coalesce("weight", F.lit(0.0)).alias("weight")))
        rows = data.unionByName(start, allowMissingColumns=True).repartitionById(tasks, F.col("shard") % tasks).sortWithinPartitions(*order)
        moves = (rows.select("shard", "kind", "feature_index", "weight", "y", "xi", "xv")
                 .mapInArrow(_sgd_stream(eta, mu, rule), "feature_index int, delta double")
                 .groupBy("feature_index").agg(F.sum("delta").alias("delta")))
        # shards that do not touch a weight only shrink it
        w = w.join(moves, "feature_index", "full_outer").select(
            F.col("feature_index").cast("int").alias("feature_index"),
            ((F.coalesce("weight", F.lit(0.0)) * F.lit(float(whole)) + F.coalesce("delta", F.lit(0.0)))
             / F.lit(float(max(used, 1)))).alias("weight")).checkpoint(eager=True)
    return w
