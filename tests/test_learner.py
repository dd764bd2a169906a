"""Parsing, split, scoring, training and evaluation."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import (
    auc,
    classify,
    confusion_counts,
    gd_step,
    hash_split,
    roc_points,
    score,
    train_gd,
    train_sgd,
    with_sample_id,
    zero_weights,
)
from cohortlens.sources import load_model, parse_svmlight, read_svmlight, save_model
from cohortlens.operators.split import train_test_split
from helpers import rows


def _lines_df(spark, lines):
    return parse_svmlight(spark.createDataFrame([(i, s) for i, s in enumerate(lines)],
                                                "sid long, value string"))


def test_parse_label_only_and_pairs(spark):
    df = _lines_df(spark, ["1 0:0.5 12:1.000", "0", "  1.0   3:2  "])
    got = {r["sid"]: (r["y"], [(e["i"], e["v"]) for e in r["x"]]) for r in df.collect()}
    assert got == {0: (1.0, [(0, 0.5), (12, 1.0)]), 1: (0.0, []), 2: (1.0, [(3, 2.0)])}


HAND = [[{"i": 0, "v": 1.0}], [{"i": 0, "v": 0.5}, {"i": 1, "v": 0.5}]]


@pytest.mark.parametrize("rule,expected", [
    ("textbook", [-0.08367854075811292, 0.11882145924188708]), ("as_coded", [0.12867854075811294, 0.3311785407581129])])
def test_sgd_hand_fixture(spark, rule, expected):
    df = _samples_df(spark, [0.0, 1.0], HAND)
    w = {r["feature_index"]: r["weight"] for r in train_sgd(df, 2, eta=0.5, mu=0.1, shards=1, rule=rule).collect()}
    assert [w[0], w[1]] == pytest.approx(expected, abs=1e-15)


def _dense_loop(ys, xs, n, eta, mu, rule="textbook", start=None):
    """Textbook per-sample loop with the dense shrink after every sample."""
    w = list(start or [0.0] * n)
    for y, x in zip(ys, xs):
        g = math.fsum(w[e["i"]] * e["v"] for e in x)
        if rule == "textbook":
            s = 1.0 / (1.0 + math.exp(-g))
            for e in x:
                w[e["i"]] += eta * e["v"] * (y - s)
        else:
            s = 1.0 / (1.0 + math.exp(-abs(g)))
            for e in x:
                w[e["i"]] += eta * (y - e["v"] * s)
        w = [wi - 2 * eta * mu * wi for wi in w]
    return w


def _toy(n_rows=200, n_feature=12, seed=3):
    rnd = random.Random(seed)
    ys, xs = [], []
    for _ in range(n_rows):
        k = rnd.randint(0, 4)
        idx = rnd.sample(range(n_feature), k)
        x = [{"i": i, "v": round(rnd.random(), 3)} for i in sorted(idx)]
        y = 1.0 if sum(e["v"] for e in x if e["i"] < n_feature // 2) > 0.6 else 0.0
        ys.append(y)
        xs.append(x)
    return ys, xs


def _samples_df(spark, ys, xs):
    data = [(i, y, [(e["i"], e["v"]) for e in x]) for i, (y, x) in enumerate(zip(ys, xs))]
    return spark.createDataFrame(data, "sample_id long, y double, x array<struct<i:int,v:double>>")


@pytest.mark.parametrize("rule", ["textbook", "as_coded"])
def test_train_sgd_one_shard_equals_sequential(spark, rule):
    ys, xs = _toy()
    df = _samples_df(spark, ys, xs)
    w = {r["feature_index"]: r["weight"]
         for r in train_sgd(df, 12, eta=0.3, mu=0.05, shards=1, rule=rule).collect()}
    order = sorted(range(len(ys)))                          # ids are numbers: numeric order
    expected = _dense_loop([ys[i] for i in order], [xs[i] for i in order], 12, 0.3, 0.05, rule)
    assert [w.get(i, 0.0) for i in range(12)] == pytest.approx(expected, abs=1e-12)


@pytest.mark.parametrize("epochs", [1, 3])
def test_train_sgd_shards_average(spark, epochs):
    ys, xs = _toy(300)
    df = _samples_df(spark, ys, xs)
    shards = 3
    got = {r["feature_index"]: r["weight"]
           for r in train_sgd(df, 12, eta=0.3, mu=0.05, shards=shards, epochs=epochs).collect()}
    member = {i: int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) % shards for i in range(len(ys))}
    mean = [0.0] * 12
    for _ in range(epochs):
        per = []
        for s in range(shards):
            ids = [i for i in range(len(ys)) if member[i] == s]
            if ids:
                per.append(_dense_loop([ys[i] for i in ids], [xs[i] for i in ids], 12, 0.3, 0.05, start=mean))
        mean = np.mean(np.array(per), axis=0).tolist()
    assert [got.get(i, 0.0) for i in range(12)] == pytest.approx(mean, abs=1e-12)


def test_train_sgd_shards_follow_the_rows(spark):
    ys, xs = _toy(120)
    df = _samples_df(spark, ys, xs)
    a = {r["feature_index"]: r["weight"] for r in train_sgd(df, 12, eta=0.3, rows_per_shard=50).collect()}
    b = {r["feature_index"]: r["weight"] for r in train_sgd(df, 12, eta=0.3, shards=3).collect()}
    assert a == b


def _counted(df):
    """``df`` and the number of its rows computed so far."""
    seen = df.sparkSession.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema), seen


def test_train_sgd_computes_its_samples_once(spark):
    ys, xs = _toy(120)
    df, seen = _counted(_samples_df(spark, ys, xs))
    train_sgd(df, 12, eta=0.3, shards=3, epochs=2).collect()
    assert seen.value == 120


def test_train_sgd_task_takes_several_small_shards(spark):
    ys, xs = _toy(300)
    df = _samples_df(spark, ys, xs)
    sc = spark.sparkContext
    sc.setJobGroup("small-shards", "")
    try:
        got = {r["feature_index"]: r["weight"] for r in train_sgd(df, 12, eta=0.3, mu=0.05, shards=70).collect()}
        jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup("small-shards")]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    stages = [sc.statusTracker().getStageInfo(s) for j in jobs for s in j.stageIds]
    assert max(s.numTasks for s in stages if s) < 70
    per = []
    for s in range(70):
        ids = [i for i in range(300) if int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) % 70 == s]
        if ids:
            per.append(_dense_loop([ys[i] for i in ids], [xs[i] for i in ids], 12, 0.3, 0.05))
    assert [got.get(i, 0.0) for i in range(12)] == pytest.approx(np.mean(np.array(per), axis=0).tolist(), abs=1e-12)


def test_train_sgd_any_number_of_features(spark):
    df = _samples_df(spark, [1.0, 0.0], [[{"i": 2_000_000_000, "v": 1.0}], [{"i": 5, "v": 1.0}]])
    w = {r["feature_index"]: r["weight"] for r in train_sgd(df, 2_000_000_001, eta=0.5, shards=1).collect()}
    assert w[2_000_000_000] == pytest.approx(0.25) and w[5] == pytest.approx(-0.25)


def test_null_labels_are_left_out_everywhere(spark):
    df = spark.createDataFrame([(1, 1.0, [(0, 1.0)]), (2, None, [(0, 1.0)]), (3, 0.0, [(1, 0.5)])],
                               "sample_id long, y double, x array<struct<i:int,v:double>>")
    known = df.where("y is not null")
    for train in (lambda d: train_gd(d, 2, eta=0.3), lambda d: train_sgd(d, 2, eta=0.3, shards=1)):
        assert rows(train(df)) == rows(train(known))
    scored = score(df, train_gd(df, 1, eta=0.3))
    assert scored.count() == 3
    a, c = auc(scored).first(), confusion_counts(scored).first()
    assert (a["n_pos"], a["n_neg"]) == (1, 1) and c["tp"] + c["fp"] + c["tn"] + c["fn"] == 2


def test_two_lines_of_one_patient_are_two_samples(spark):
    lines = spark.createDataFrame([(4, "1 0:0.5"), (4, "1 0:0.5"), (5, "0 1:1.0")], ["patientid", "save_feature"])
    samples = parse_svmlight(with_sample_id(lines), "save_feature")
    weights = spark.createDataFrame([(0, 1.0)], "feature_index int, weight double")
    assert sorted(r["margin"] for r in score(samples, weights).collect()) == [0.0, 0.5, 0.5]


@pytest.mark.parametrize("line,y,x", [
    ("\t1 0:0.5", 1.0, [(0, 0.5)]), ("1 0:0.5\t", 1.0, [(0, 0.5)]), ("1\t0:0.5", 1.0, [(0, 0.5)]),
    ("1 0:0.5 junk", 1.0, [(0, 0.5), (None, None)]), ("x 0:0.5", None, [(0, 0.5)]), ("", None, []), ("  ", None, [])])
def test_odd_lines(spark, line, y, x):
    r = _lines_df(spark, [line]).first()
    assert r["y"] == y and [(e["i"], e["v"]) for e in r["x"]] == x


def test_train_sgd_rejects_out_of_range_index(spark):
    df = _samples_df(spark, [1.0], [[{"i": 5, "v": 1.0}]])
    with pytest.raises(IndexError):
        train_sgd(df, 3)


def test_score_and_classify(spark):
    df = _lines_df(spark, ["1 0:1.0 1:2.0", "0", "0 2:1.0"])
    weights = spark.createDataFrame([(0, 0.5), (1, -1.0)], "feature_index int, weight double")
    out = {r["sid"]: (r["margin"], r["prob"], r["prediction"])
           for r in classify(score(df, weights, id_col="sid")).collect()}
    assert out[0][0] == pytest.approx(-1.5)
    assert out[0][1] == pytest.approx(1 / (1 + math.exp(1.5)))
    assert out[1] == (0.0, 0.5, 0)       # no features: 0.5, strict threshold -> 0
    assert out[2] == (0.0, 0.5, 0)       # unknown feature weighs 0


def test_gd_step_matches_numpy(spark):
    ys, xs = _toy(100, 6)
    df = _samples_df(spark, ys, xs)
    w = train_gd(df, 2, eta=0.5, mu=0.1)
    got = {r["feature_index"]: r["weight"] for r in w.collect()}
    X = np.zeros((len(ys), 6))
    for r, x in enumerate(xs):
        for e in x:
            X[r, e["i"]] += e["v"]
    y = np.array(ys)
    wv = np.zeros(6)
    for _ in range(2):
        s = 1 / (1 + np.exp(-(X @ wv)))
        wv = (wv + 0.5 / len(ys) * (X.T @ (y - s))) * (1 - 2 * 0.5 * 0.1)
    assert [got.get(i, 0.0) for i in range(6)] == pytest.approx(wv.tolist(), abs=1e-12)
    assert gd_step(df, zero_weights(spark), 0.1, 0.0, 100).count() > 0


def test_auc_equals_pair_count(spark):
    rnd = random.Random(7)
    data = [(float(rnd.randint(0, 1)), float(rnd.randint(0, 9))) for _ in range(300)]
    df = spark.createDataFrame(data, "y double, prob double")
    got = auc(df, num_partitions=4).first()
    pos = [s for y, s in data if y == 1]
    neg = [s for y, s in data if y == 0]
    pairs = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    assert got["auc"] == pytest.approx(pairs / (len(pos) * len(neg)), abs=1e-12)
    assert (got["n_pos"], got["n_neg"]) == (len(pos), len(neg))


def test_roc_points_and_trapezoid(spark):
    rnd = random.Random(11)
    data = [(float(rnd.randint(0, 1)), rnd.random()) for _ in range(120)]
    df = spark.createDataFrame(data, "y double, prob double")
    pts = sorted(((r["fpr"], r["tpr"]) for r in roc_points(df, num_partitions=5).collect()))
    assert pts[0] == (0.0, 0.0) and pts[-1] == (1.0, 1.0)
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(pts, pts[1:]))
    assert area == pytest.approx(auc(df).first()["auc"], abs=1e-12)


def test_auc_one_class_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.2), (1.0, 0.7)], "y double, prob double")
    assert auc(df).first()["auc"] is None


def test_confusion_counts(spark):
    df = spark.createDataFrame([(1.0, 0.9), (0.0, 0.6), (0.0, 0.5), (1.0, 0.1)], "y double, prob double")
    r = confusion_counts(df).first()
    assert (r["tp"], r["fp"], r["tn"], r["fn"]) == (1, 1, 1, 1)


def test_hash_split_disjoint_complete_and_stable(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "patientid")
    t1, r1 = hash_split(df.repartition(7))
    t2, _ = hash_split(df.repartition(3))
    a = {r[0] for r in t1.collect()}
    assert a == {r[0] for r in t2.collect()}
    b = {r[0] for r in r1.collect()}
    assert not a & b and len(a | b) == 2000
    assert 300 < len(a) < 500


def test_write_and_read_back_samples(spark, tmp_path):
    samples = spark.createDataFrame([(1, "0 0:1.000 3:0.500"), (2, "1 1:0.250")],
                                    ["patientid", "save_feature"])
    train_test_split(samples, str(tmp_path / "train"), str(tmp_path / "test"))
    back = read_svmlight(spark, str(tmp_path / "train")).unionByName(
        read_svmlight(spark, str(tmp_path / "test")))
    assert sorted(r["line"] for r in back.collect()) == ["0 0:1.000 3:0.500", "1 1:0.250"]


def test_model_roundtrip(spark, tmp_path):
    w = spark.createDataFrame([(0, 0.5), (3, -1.0)], "feature_index int, weight double")
    save_model(w, str(tmp_path / "m"), eta=0.1, mu=0.0, n_feature=4)
    back, params = load_model(spark, str(tmp_path / "m"))
    assert rows(back) == [(0, 0.5), (3, -1.0)]
    assert {k: params[k] for k in ("eta", "mu", "n_feature", "rule", "version")} == {
        "eta": 0.1, "mu": 0.0, "n_feature": 4, "rule": "textbook", "version": 1}


def test_gd_as_coded_matches_numpy(spark):
    ys, xs = _toy(80, 5, seed=5)
    df = _samples_df(spark, ys, xs)
    got = {r["feature_index"]: r["weight"]
           for r in train_gd(df, 2, eta=0.5, mu=0.1, rule="as_coded").collect()}
    wv = np.zeros(5)
    for _ in range(2):
        g = np.zeros(5)
        for y, x in zip(ys, xs):
            m = sum(wv[e["i"]] * e["v"] for e in x)
            s = 1 / (1 + np.exp(-abs(m)))
            for e in x:
                g[e["i"]] += y - e["v"] * s
        wv = (wv + 0.5 / len(ys) * g) * (1 - 2 * 0.5 * 0.1)
    assert [got.get(i, 0.0) for i in range(5)] == pytest.approx(wv.tolist(), abs=1e-12)


def test_read_svmlight_skips_blank_lines(spark, tmp_path):
    path = tmp_path / "s.txt"
    path.write_text("1 0:0.5\n\n   \n0\n")
    got = sorted((r["y"], len(r["x"])) for r in read_svmlight(spark, str(path)).collect())
    assert got == [(0.0, 0), (1.0, 1)]


def test_score_without_broadcast_check(spark):
    df = _lines_df(spark, ["1 0:2.0", "0 1:1.0"])
    w = spark.createDataFrame([(0, 1.0), (1, -1.0)], "feature_index int, weight double")
    a = {r["sid"]: r["margin"] for r in score(df, w, id_col="sid", broadcast_bytes=None).collect()}
    assert a == {0: 2.0, 1: -1.0}


def test_malformed_pair_is_null_not_error(spark):
    df = _lines_df(spark, ["1 0:0.5 x:y 2:1.0"])
    x = df.first()["x"]
    assert [(e["i"], e["v"]) for e in x] == [(0, 0.5), (None, None), (2, 1.0)]
    w = train_gd(df.select(F.col("sid").alias("sample_id"), "y", "x"), 1, eta=1.0)
    assert sorted(r["feature_index"] for r in w.collect()) == [0, 2]


def test_sgd_skips_malformed_pairs(spark):
    df = _samples_df(spark, [0.0], [[{"i": 0, "v": 1.0}, {"i": None, "v": None}]])
    assert rows(train_sgd(df, 1, eta=0.5, mu=0.1, shards=1)) == [(0, pytest.approx(-0.225))]
