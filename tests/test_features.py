"""Feature operators: rules, edge cases and invariants."""

import datetime as dt

from pyspark.sql import functions as F

from cohortlens.operators import (
    aggregate_events,
    calculate_index_dates,
    dense_index,
    filter_events,
    generate_feature_mapping,
    normalization,
    svmlight_convert,
    svmlight_samples,
    unmapped_codes,
    with_sample_id,
)
from cohortlens.plans import build_samples
from cohortlens.plans.sample_build import release
from helpers import rows


def test_filter_events_window(spark):
    events = spark.createDataFrame(
        [(7, "LAB3", "1990-01-01", 1.0), (7, "LAB4", "1997-06-30", 1.0), (7, "LAB5", "1999-01-01", 1.0),
         (8, "DRUG6", "1993-03-03", 1.0), (9, "DRUG6", "1997-01-01", 1.0)],
        ["patientid", "eventid", "etimestamp", "value"])
    index = spark.createDataFrame([(7, "1998-01-01"), (8, "1994-01-01")], ["patientid", "index_date"])
    out = filter_events(events, index)
    assert out.columns == ["patientid", "eventid", "etimestamp", "value"]
    assert rows(out, "patientid", "eventid") == [(7, "LAB4"), (8, "DRUG6")]


def test_window_ends_inclusive(spark):
    events = spark.createDataFrame(
        [(1, "A", dt.date(2000, 1, 1), 1.0),                     # index date
         (1, "B", dt.date(2000, 1, 1) - dt.timedelta(2000), 1.0),  # window start
         (1, "C", dt.date(2000, 1, 1) - dt.timedelta(2001), 1.0)],  # outside
        ["patientid", "eventid", "etimestamp", "value"])
    index = spark.createDataFrame([(1, dt.date(2000, 1, 1))], ["patientid", "index_date"])
    assert rows(filter_events(events, index), "eventid") == [("A",), ("B",)]


def test_aggregate_counts_rows_not_values(spark):
    data = [(1, "LAB1", "1998-02-03", 5.0, "1999-01-01", 332)] * 4 + [(1, "LAB2", "1998-02-03", 0.0, "1999-01-01", 332)] \
        + [(2, "LAB1", "1998-02-03", None, "1999-01-01", 332)] * 3
    df = spark.createDataFrame(data, "patientid long, eventid string, etimestamp string, value double, "
                                     "index_date string, time_difference int")
    assert rows(aggregate_events(df), "patientid", "eventid", "feature_value") == [(1, "LAB1", 4), (1, "LAB2", 1), (2, "LAB1", 3)]


def test_feature_mapping_in_code_order(spark):
    df = spark.createDataFrame([(1, "LAB10", 0.5), (1, "DRUG2", 1.0), (2, "LAB10", 1.0), (3, "DIAG9", 0.25)],
                               ["patientid", "eventid", "normalized_feature_value"])
    assert rows(generate_feature_mapping(df), "eventid", "event_index") == [("DIAG9", 0), ("DRUG2", 1), ("LAB10", 2)]


def test_feature_mapping_null_code_excluded(spark):
    df = spark.createDataFrame([(1, None, 0), (1, "B", 1), (2, "A", 3)],
                               "patientid int, eventid string, feature_value long")
    assert rows(generate_feature_mapping(df)) == [("A", 0), ("B", 1)]


def test_dense_index_is_dense_on_any_partitioning(spark):
    codes = spark.range(0, 900).select(
        F.concat(F.lit("C"), F.lpad((F.col("id") * 7919 % 900).cast("string"), 4, "0"))
        .alias("code"))
    expected = sorted(f"C{i:04d}" for i in range(900))
    for parts in (1, 4, 50):
        out = dense_index(codes.repartition(parts), "code", "idx", num_partitions=parts)
        got = sorted((r["idx"], r["code"]) for r in out.collect())
        assert [i for i, _ in got] == list(range(900))
        assert [c for _, c in got] == expected


def test_normalization_by_the_codes_maximum(spark):
    df = spark.createDataFrame([(1, "A", 1), (1, "B", 40), (2, "A", 8), (3, "A", 3)], ["patientid", "eventid", "feature_value"])
    expected = [(1, "A", 0.125), (1, "B", 1.0), (2, "A", 1.0), (3, "A", 0.375)]
    assert rows(normalization(df)) == expected == rows(normalization(df, broadcast_bytes=None)) == rows(normalization(df, broadcast_bytes=1))


def test_normalization_tiny_ratio_rounds_to_zero(spark):
    df = spark.createDataFrame([(1, "X", 1), (2, "X", 2001)],
                               ["patientid", "eventid", "feature_value"])
    assert rows(normalization(df), "patientid", "normalized_feature_value") == [(1, 0.0), (2, 1.0)]


def test_svmlight_indices_in_numeric_order(spark):
    normalized = spark.createDataFrame([(5, "X", 1.0), (5, "Y", 0.25), (5, "Z", 0.5), (6, "Z", 0.125)],
                                       ["patientid", "eventid", "normalized_feature_value"])
    mapping = spark.createDataFrame([("X", 10), ("Y", 3), ("Z", 100)], ["eventid", "event_index"])
    out = {r["patientid"]: r["sparse_feature"] for r in svmlight_convert(normalized, mapping).collect()}
    assert out == {5: ["3:0.250", "10:1.000", "100:0.500"], 6: ["100:0.125"]}


def test_svmlight_convert_drops_zero_and_unmapped(spark):
    normalized = spark.createDataFrame(
        [(1, "A", 0.0), (1, "B", 0.5), (1, "Z", 1.0)],
        ["patientid", "eventid", "normalized_feature_value"])
    mapping = spark.createDataFrame([("A", 0), ("B", 1)], ["eventid", "event_index"])
    out = [(r["patientid"], r["sparse_feature"]) for r in svmlight_convert(normalized, mapping).collect()]
    assert out == [(1, ["1:0.500"])]
    assert rows(unmapped_codes(normalized, mapping)) == [("Z", 1)]


def test_svmlight_samples_label_and_fan_out(spark):
    svm = spark.createDataFrame([(5, ["3:0.250"]), (6, ["1:1.000", "9:0.500"]), (7, ["2:0.100"])], ["patientid", "sparse_feature"])
    mortality = spark.createDataFrame([(6, dt.date(2001, 2, 3), 1), (6, dt.date(2001, 2, 9), 1), (7, dt.date(2001, 1, 1), 0)],
                                      ["patientid", "mtimestamp", "label"])
    out = svmlight_samples(svm, mortality)
    assert rows(out) == [(5, "0 3:0.250"), (6, "1 1:1.000 9:0.500"), (6, "1 1:1.000 9:0.500"), (7, "0 2:0.100")]
    ids = rows(with_sample_id(out.repartition(3)), "patientid", "sample_id")
    assert len({i for _, i in ids}) == 4 and ids == rows(with_sample_id(out.coalesce(1)), "patientid", "sample_id")


def test_index_dates_semantics(spark):
    events = spark.createDataFrame(
        [(1, "A", "2000-01-10", 1.0), (1, "A", "2000-03-01", 1.0),   # alive
         (2, "B", "2000-02-01", 1.0),                                  # dead
         (3, "C", "2000-04-01", 1.0)],                                 # null label
        ["patientid", "eventid", "etimestamp", "value"])
    mortality = spark.createDataFrame(
        [(2, "2000-01-30", 1), (3, "2000-05-01", None), (4, "2000-03-01", 1)],
        "patientid long, mtimestamp string, label int")
    out = rows(calculate_index_dates(events, mortality))
    assert out == sorted([
        (1, dt.date(2000, 3, 1)),
        (2, dt.date(1999, 12, 31)),          # death 2000-01-30 minus 30 days
        (3, dt.date(2000, 4, 1)),            # null label: alive max ...
        (3, dt.date(2000, 4, 1)),            # ... and death - 30 (2000-04-01)
        (4, dt.date(2000, 1, 31)),           # dead without events still indexed
    ], key=repr)


def test_bad_date_string_is_null(spark):
    events = spark.createDataFrame([(1, "A", "x", 1.0)], ["patientid", "eventid", "etimestamp", "value"])
    index = spark.createDataFrame([(1, "2000-01-01")], ["patientid", "index_date"])
    assert filter_events(events, index).count() == 0


def test_build_samples_end_to_end(spark):
    events = spark.createDataFrame(
        [(1, "DIAG1", "2000-01-01", 1.0), (1, "DIAG1", "2000-01-02", 1.0), (1, "LAB2", "2000-01-03", 1.0),
         (2, "DIAG1", "2000-01-05", 1.0), (2, "LAB2", "2000-01-20", 1.0)],
        ["patientid", "eventid", "etimestamp", "value"])
    mortality = spark.createDataFrame([(2, "2000-03-01", 1)], ["patientid", "mtimestamp", "label"])
    out = build_samples(events, mortality)
    assert rows(out["samples"]) == [(1, "0 0:1.000 1:1.000"), (2, "1 0:0.500 1:1.000")]
    release(out)


def test_build_samples_equals_operator_chain(spark):
    from test_metrics import _fanout_inputs
    events, mortality = _fanout_inputs(spark)
    idx = calculate_index_dates(events, mortality)
    out = build_samples(events, mortality)
    assert rows(out["index_dates"]) == rows(idx)
    agg = aggregate_events(filter_events(events, idx))
    assert rows(out["agg_events"]) == rows(agg)
    chain = svmlight_samples(svmlight_convert(normalization(agg), generate_feature_mapping(agg)),
                             mortality)
    assert rows(out["samples"]) == rows(chain)
    # a map fitted elsewhere goes through the separate-join path
    again = build_samples(events, mortality, event_map=out["event_map"])
    assert rows(again["samples"]) == rows(chain)
    assert rows(build_samples(events, mortality, cache=False)["samples"]) == rows(chain)
    release(out)
    release(again)


def test_dense_index_with_default_coalesced_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        codes = spark.range(0, 5000).select(
            F.concat(F.lit("C"), F.lpad((F.col("id") * 7919 % 5000).cast("string"), 5, "0"))
            .alias("code"))
        got = sorted((r["idx"], r["code"]) for r in dense_index(codes.repartition(13), "code", "idx").collect())
        assert [i for i, _ in got] == list(range(5000))
        assert [c for _, c in got] == sorted(c for _, c in got)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
