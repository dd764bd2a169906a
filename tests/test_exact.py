"""Order-independent sums, scores that do not depend on the partitioning, and
the streaming SGD shard."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import score, train_gd, train_sgd
from cohortlens.operators.exact import exact_sum
from cohortlens.sources import file_order


def _groups(seed=5):
    """Addends of all sizes, cancelling ones, subnormal ones, repeated ones."""
    rng, out = random.Random(seed), {}

    def anything():
        while True:
            v = struct.unpack("<d", rng.randbytes(8))[0]
            if math.isfinite(v) and abs(v) < 1e300:
                return v

    for g in range(120):
        n = rng.randint(1, 50)
        kind = g % 6
        if kind == 0:
            xs = [anything() for _ in range(n)]
        elif kind == 1:
            xs = [rng.gauss(0, 1) for _ in range(n)]
        elif kind == 2:
            xs = [rng.gauss(0, 1) * 10 ** rng.randint(-20, 20) for _ in range(n)]
            xs += [-x for x in xs[:-1]]
        elif kind == 3:
            xs = [rng.choice([5e-324, -5e-324, 1e-310, 2.2e-308]) for _ in range(n)]
        elif kind == 4:
            xs = [0.1] * n + [None, 0.0, -0.0]
        else:
            xs = [1e16, 1.0, -1e16, 2.0 ** -60] * n
        rng.shuffle(xs)
        out[g] = xs
    return out


def test_exact_sum_equals_fsum_on_any_partitioning(spark):
    groups = _groups()
    df = spark.createDataFrame([(g, x) for g, xs in groups.items() for x in xs], "g long, x double")
    got = [{r.g: r.total for r in exact_sum(df.repartition(p), ["g"], "x").collect()} for p in (1, 7, 50)]
    for g, xs in groups.items():
        want = math.fsum(x for x in xs if x is not None)
        assert len({struct.pack("<d", x[g]) for x in got}) == 1
        assert abs(got[0][g] - want) <= math.ulp(want)


def test_exact_sum_of_odd_values(spark):
    inf = float("inf")
    data = [(0, None, "a"), (1, 0.0, None), (1, None, "b"), (2, inf, "c"), (2, 1.0, "c"), (3, float("nan"), None), (4, inf, None), (4, -inf, None),
            (5, 1.7e308, None), (5, 1.7e308, None), (None, 2.0, "d")]
    got = {r.g: (r.total, r.tag) for r in exact_sum(spark.createDataFrame(data, "g int, x double, tag string"), ["g"], "x", carry=("tag",)).collect()}
    assert got[0] == (None, "a") and got[1] == (0.0, "b") and got[2] == (inf, "c") and got[5] == (inf, None) and got[None] == (2.0, "d")
    assert math.isnan(got[3][0]) and math.isnan(got[4][0])
    assert exact_sum(spark.createDataFrame([], "g int, x double"), ["g"], "x").count() == 0


def _toy(spark, n=400, features=60, seed=1):
    rng = np.random.default_rng(seed)
    data = []
    for k in range(n):
        i = np.sort(rng.choice(features, rng.integers(0, min(40, features)), replace=False))
        data.append((f"s{k:04d}", float(rng.integers(0, 2)), [(int(a), float(b)) for a, b in zip(i, rng.normal(size=len(i)) * 10.0 ** rng.integers(-8, 8, len(i)))]))
    return data, spark.createDataFrame(data, "sample_id string, y double, x array<struct<i:int,v:double>>")


def test_score_is_the_same_bits_on_any_partitioning(spark):
    data, df = _toy(spark)
    w = np.random.default_rng(2).normal(size=60)
    weights = spark.createDataFrame([(i, float(x)) for i, x in enumerate(w)], "feature_index int, weight double")
    got = [{r.sample_id: (r.margin, r.prob) for r in score(df.repartition(p), weights).collect()} for p in (1, 7, 50)]
    assert got[0] == got[1] == got[2]
    for name, _, x in data:
        want = math.fsum(w[i] * v for i, v in x)
        assert abs(got[0][name][0] - want) <= math.ulp(want)


def test_exact_descent_is_the_same_bits_on_any_partitioning(spark):
    _, df = _toy(spark, 80, 20)
    got = [sorted(map(tuple, train_gd(df.repartition(p), 2, 0.5, 0.1, exact=True).collect())) for p in (1, 7)]
    assert got[0] == got[1]


def _loop(samples, eta, mu, rule="textbook"):
    w = {}
    for y, x in samples:
        margin = math.fsum(w.get(i, 0.0) * v for i, v in x)
        for i, v in x:
            move = v * (y - 1 / (1 + math.exp(-margin))) if rule == "textbook" else y - v / (1 + math.exp(-abs(margin)))
            w[i] = w.get(i, 0.0) + eta * move
        w = {i: v * (1 - 2 * eta * mu) for i, v in w.items()}
    return w


@pytest.mark.parametrize("rule", ["textbook", "as_coded"])
def test_one_shard_in_file_order_is_the_sequential_pass(spark, tmp_path, rule):
    rng = np.random.default_rng(7)
    samples = [(float(rng.integers(0, 2)), [(int(i), round(float(rng.random()), 3)) for i in np.sort(rng.choice(30, 5, replace=False))]) for _ in range(900)]
    lines = [f"{y:.0f} " + " ".join(f"{i}:{v}" for i, v in x) for y, x in samples]
    for k in range(3):
        (tmp_path / f"{k}.txt").write_text("\n".join(lines[k * 300:(k + 1) * 300]) + "\n")
    data = file_order(spark, str(tmp_path)).withColumn("sample_id", F.md5(F.to_json("position")))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")  # many batches a shard
    try:
        got = {r.feature_index: r.weight for r in train_sgd(data, 30, 0.3, 0.05, shards=1, rule=rule, order_col="position").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = _loop(samples, 0.3, 0.05, rule)
    assert sorted(got) == sorted(want)
    assert [got[i] for i in sorted(got)] == pytest.approx([want[i] for i in sorted(want)], rel=1e-9, abs=1e-12)


def test_shards_in_order_over_two_epochs(spark):
    data, df = _toy(spark, 60, 12, seed=4)
    df = df.withColumn("x", F.transform("x", lambda e: F.struct(e["i"].alias("i"), F.signum(e["v"]).alias("v")))).withColumn("place", -F.substring("sample_id", 2, 9).cast("int"))
    small = [(name, y, [(i, math.copysign(1.0, v)) for i, v in x]) for name, y, x in data]
    got = {r.feature_index: r.weight for r in train_sgd(df, 12, 0.1, 0.01, shards=1, epochs=2, order_col="place").collect()}
    backwards = [(y, x) for _, y, x in reversed(small)]
    want = _loop(backwards * 2, 0.1, 0.01)
    assert [got[i] for i in sorted(got)] == pytest.approx([want[i] for i in sorted(want)], abs=1e-9)
