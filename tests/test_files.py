"""Written splits, checked sources and versioned models on real folders."""

import datetime as dt
import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from cohortlens.operators import hash_split, read_split, train_test_split, write_samples
from cohortlens.sources import (
    file_order,
    load_model,
    model_versions,
    read_events_checked,
    read_mortality_checked,
    read_svmlight_checked,
    save_model,
    source_report,
    svmlight_report,
)
from cohortlens.sources.folders import replace_folders
from helpers import rows


def _samples(spark, n=500):
    return spark.range(n).select(F.col("id").alias("patientid"), F.concat(F.lit("1 "), F.col("id").cast("string"), F.lit(":1.000")).alias("save_feature"))


def _jobs(spark, group, action):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        out = action()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return out, len(sc.statusTracker().getJobIdsForGroup(group))


def test_split_is_one_job_and_equals_hash_split(spark, tmp_path):
    train, test = str(tmp_path / "o" / "train"), str(tmp_path / "o" / "test")
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    samples = _samples(spark).repartition(3)
    counted_samples = samples.mapInArrow(counted, samples.schema)
    counts, jobs = _jobs(spark, "split", lambda: train_test_split(counted_samples, train, test))
    # one job writes (the other is the repartition's map stage); every sample is computed once
    assert seen.value == 500 and jobs <= 2
    a, b = hash_split(samples)
    assert counts == {"train": b.count(), "test": a.count()}
    assert rows(read_split(spark, train, test)) == sorted(
        [("train", r.save_feature) for r in b.collect()] + [("test", r.save_feature) for r in a.collect()])
    assert sorted(os.listdir(tmp_path / "o")) == ["test", "train"]  # nothing is left beside them


def test_split_replaces_only_on_success(spark, tmp_path):
    train, test = str(tmp_path / "train"), str(tmp_path / "test")
    train_test_split(_samples(spark, 50), train, test)
    before = rows(read_split(spark, train, test))

    def broken(batches):
        for b in batches:
            yield b
        raise ValueError("the input broke off")

    bad = _samples(spark, 90)
    with pytest.raises(Exception, match="broke off"):
        train_test_split(bad.mapInArrow(broken, bad.schema), train, test)
    assert rows(read_split(spark, train, test)) == before
    assert sorted(os.listdir(tmp_path)) == ["test", "train"]
    train_test_split(_samples(spark, 70), train, test)
    assert read_split(spark, train, test).count() == 70


def test_split_without_rows(spark, tmp_path):
    train, test = str(tmp_path / "train"), str(tmp_path / "test")
    train_test_split(_samples(spark, 50), train, test)
    assert train_test_split(_samples(spark, 0), train, test) == {"train": 0, "test": 0}
    assert read_split(spark, train, test).count() == 0


def test_failed_move_puts_the_old_folders_back(spark, tmp_path):
    write_samples(_samples(spark, 5), str(tmp_path / "a"))
    write_samples(_samples(spark, 6), str(tmp_path / "new"))
    (tmp_path / "file").write_text("not a folder")
    with pytest.raises(Exception):  # noqa: B017 - the file system's own error
        replace_folders(spark, {str(tmp_path / "new"): str(tmp_path / "a"), str(tmp_path / "none"): str(tmp_path / "file" / "b")})
    assert spark.read.text(str(tmp_path / "a")).count() == 5


EVENTS = """1,DIAG1,text,2000-01-02,1.5
bad,DIAG2,text,2000-01-02,1.5
3,DIAG3,text,x,1.5
4,DIAG4,text,2000-01-02,oops
5,DIAG5,text,2000-01-02
6,DIAG6,text,2000-01-02,1.0,extra
7,"a,b",text,,1.0

,,,,
"8,DIAG,t,2000-01-02,1.0
"""


def test_events_with_a_bad_record_channel(spark, tmp_path):
    path = tmp_path / "e.csv"
    path.write_text(EVENTS)
    lines = [x for x in EVENTS.splitlines() if x]
    got = read_events_checked(spark, str(path))
    day = dt.date(2000, 1, 2)
    assert rows(got) == sorted([
        (1, "DIAG1", day, 1.5, None), (None, "DIAG2", day, 1.5, lines[1]), (3, "DIAG3", None, 1.5, lines[2]), (4, "DIAG4", day, None, lines[3]),
        (5, "DIAG5", day, None, lines[4]), (6, "DIAG6", day, 1.0, lines[5]), (7, "a,b", None, 1.0, None), (None, None, None, None, None),
        (None, None, None, None, lines[8])], key=repr)
    report = source_report(got).first().asDict()
    assert report == {"n_lines": 9, "n_bad_lines": 6, "n_no_patient": 3, "n_no_date": 4}
    # the same lines are bad whatever columns a query uses
    assert got.select("patientid", "bad_record").where("bad_record is not null").count() == 6
    # and the counts come with the rows, from one scan
    counts = Observation()
    _, jobs = _jobs(spark, "scan", lambda: read_events_checked(spark, str(path), counts).write.parquet(str(tmp_path / "out")))
    assert counts.get == report and jobs == 1


def test_mortality_with_a_bad_record_channel(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("1,2000-01-02,1\n2,2000-13-02,0\n3,2000-01-02,no\n")
    got = read_mortality_checked(spark, str(path))
    assert rows(got) == [(1, dt.date(2000, 1, 2), 1, None), (2, None, 0, "2,2000-13-02,0"), (3, dt.date(2000, 1, 2), None, "3,2000-01-02,no")]
    assert source_report(got).first().asDict() == {"n_lines": 3, "n_bad_lines": 2, "n_no_patient": 0, "n_no_date": 1}


def test_svmlight_with_a_bad_record_channel(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1 0:0.5 1:x\n\n0\nx 2:1.0\n1 3:0.5 four 5:6\n")
    got = read_svmlight_checked(spark, str(tmp_path))
    assert rows(got, "line", "bad_record") == sorted([("1 0:0.5 1:x",) * 2, ("0", None), ("x 2:1.0",) * 2, ("1 3:0.5 four 5:6",) * 2], key=repr)
    assert svmlight_report(got).first().asDict() == {"n_lines": 4, "n_bad_lines": 3, "n_no_label": 1, "n_bad_pairs": 2}


def test_file_order(spark, tmp_path):
    lines = [f"{i % 2} {i}:1.0" for i in range(4000)]
    for k in range(4):
        (tmp_path / f"part-{k}.txt").write_text("\n".join(lines[k * 1000:(k + 1) * 1000]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        got = [r.line for r in file_order(spark, str(tmp_path)).orderBy("position").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == lines


def _weights(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "feature_index int, weight double")


def test_versions_are_appended_and_loaded_by_number(spark, tmp_path):
    path = str(tmp_path / "m")
    assert model_versions(spark, path).count() == 0
    with pytest.raises(FileNotFoundError):
        load_model(spark, path)
    assert save_model(_weights(spark, 0.5), path, 0.1, 0.0, 1) == 1
    assert save_model(_weights(spark, 1.0, 2.0), path, 0.2, 0.1, 2, "as_coded") == 2
    assert save_model(_weights(spark), path, 0.2, 0.1, 0) == 3  # no weights: all are zero
    assert rows(load_model(spark, path, 1)[0]) == [(0, 0.5)]
    w, params = load_model(spark, path, 2)
    assert rows(w) == [(0, 1.0), (1, 2.0)] and params["rule"] == "as_coded" and params["n_feature"] == 2
    assert rows(load_model(spark, path)[0]) == [] and load_model(spark, path)[1]["version"] == 3
    with pytest.raises(FileNotFoundError):
        load_model(spark, path, 4)
    assert rows(model_versions(spark, path).select("version", "n_weights")) == [(1, 1), (2, 2), (3, 0)]


def test_a_half_written_version_is_never_read(spark, tmp_path):
    path = str(tmp_path / "m")
    save_model(_weights(spark, 0.5, 0.25), path, 0.1, 0.0, 2)
    # weights without their parameters, and parameters with one weight of two
    _weights(spark, 9.0).withColumn("saved_by", F.lit("a")).write.parquet(f"{path}/version=2")
    half = _weights(spark, 9.0).withColumn("saved_by", F.lit("b")).unionByName(
        spark.createDataFrame([(2, "b", 0.1, 0.0, 2, "textbook")], "n_weights long, saved_by string, eta double, mu double, n_feature int, rule string"),
        allowMissingColumns=True)
    half.write.parquet(f"{path}/version=3")
    os.makedirs(f"{path}/version=4/_temporary/0")
    w, params = load_model(spark, path)
    assert rows(w) == [(0, 0.5), (1, 0.25)] and params["version"] == 1
    assert [r.version for r in model_versions(spark, path).collect()] == [1]
    assert save_model(_weights(spark, 7.0), path, 0.1, 0.0, 1) == 4
    assert rows(load_model(spark, path)[0]) == [(0, 7.0)]


def test_two_writers_of_one_number(spark, tmp_path):
    path = str(tmp_path / "m")
    save_model(_weights(spark, 0.5), path, 0.1, 0.0, 1)
    other = str(tmp_path / "other")
    save_model(_weights(spark, 1.5, 2.5), other, 0.1, 0.0, 2)
    spark.read.parquet(f"{other}/version=1").write.mode("append").parquet(f"{path}/version=1")
    w, params = load_model(spark, path)
    assert w.count() == params["n_weights"] and model_versions(spark, path).count() == 1
