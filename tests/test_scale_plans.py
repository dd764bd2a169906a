"""Skewed input and plan shape: a patient holding a third of all events
must give the same results as the plain operator chain, and the plans must
keep the partial steps before their shuffles."""

import contextlib
import io

from pyspark.sql import functions as F

from cohortlens.operators import (
    aggregate_events,
    calculate_index_dates,
    filter_events,
    generate_feature_mapping,
    normalization,
    svmlight_convert,
    svmlight_samples,
    tag_cohort,
)
from cohortlens.operators.metrics import (
    cohort_metrics,
    common_codes,
    common_codes_from_tagged,
    patient_profile,
    profile_from_tagged,
)
from cohortlens.plans.sample_build import build_samples, release
from helpers import rows


def _skewed(spark, n=9000):
    # patient 0 holds a third of the rows; the rest spread over 300 patients
    ev = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 300 + 1).alias("patientid"),
        F.concat(F.element_at(F.array(F.lit("DIAG"), F.lit("LAB"), F.lit("DRUG")),
                              (F.col("id") % 3 + 1).cast("int")),
                 (F.col("id") % 37).cast("string")).alias("eventid"),
        F.date_add(F.lit("2001-01-01").cast("date"), (F.col("id") % 900).cast("int")).alias("etimestamp"),
        F.lit(1.0).alias("value"))
    mo = spark.range(0, 301, 2).select(
        F.col("id").alias("patientid"),
        F.date_add(F.lit("2003-06-01").cast("date"), (F.col("id") % 40).cast("int")).alias("mtimestamp"),
        F.lit(1).alias("label"))
    return ev, mo


def test_hot_patient_metrics_equal_event_level(spark):
    ev, mo = _skewed(spark)
    tagged = tag_cohort(ev, mo)
    assert rows(patient_profile(ev, mo)) == rows(profile_from_tagged(tagged))
    assert rows(common_codes(ev, mo, 5)) == rows(common_codes_from_tagged(tagged, 5))
    m = {r["cohort"]: r for r in cohort_metrics(patient_profile(ev, mo)).collect()}
    assert m["dead"]["events_max"] == 3000        # the hot patient (id 0) is dead


def test_profile_keeps_no_copy_of_the_events(spark):
    from cohortlens.plans import cohort_profile
    ev, mo = _skewed(spark)
    res = cohort_profile(ev, mo, 5)
    for df in res.values():
        assert "InMemoryTableScan" not in _plan(df)
    assert _plan(res["patients"]).count("Exchange") <= 4


def test_hot_patient_is_split_by_construction(spark):
    """Default settings: the hot patient's rows carry several part numbers on
    both sides of the window join, the others one."""
    from cohortlens.operators.joins import hot_keys, salted_join
    ev, mo = _skewed(spark)
    idx = calculate_index_dates(ev, mo)
    assert [tuple(r) for r in hot_keys(ev, "patientid", 500).collect()] == [(0, 6)]
    plan = _plan(salted_join(ev, idx, "patientid", 500))
    assert "hashpartitioning(patientid" in plan and "_part" in plan
    assert rows(filter_events(ev, idx, hot_rows=500)) == rows(filter_events(ev, idx)) == rows(filter_events(ev, idx, hot_rows=1))
    out = build_samples(ev, mo, hot_rows=100)
    assert rows(out["agg_events"]) == rows(aggregate_events(filter_events(ev, idx)))
    release(out)


def test_null_patients_do_not_reach_the_join(spark):
    ev, mo = _skewed(spark, 900)
    lost = ev.limit(5).withColumn("patientid", F.lit(None).cast("bigint"))
    tagged = tag_cohort(ev.unionByName(lost), mo)
    assert tagged.where("patientid is null and cohort = 'alive'").count() == 5
    assert tagged.count() == 905


def test_counts_are_not_shuffled_by_code(spark):
    ev, mo = _skewed(spark)
    agg = aggregate_events(filter_events(ev, calculate_index_dates(ev, mo)))
    for df in (normalization(agg), svmlight_convert(normalization(agg), generate_feature_mapping(agg))):
        assert "hashpartitioning(eventid" not in _plan(df)


def test_broadcast_is_bound_by_bytes(spark):
    from cohortlens.operators.joins import broadcast_if_small, size_in_bytes
    wide = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("t"))
    assert size_in_bytes(wide) == 100 * (2 * 16 + 1000)
    assert "ResolvedHint" not in wide._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in broadcast_if_small(wide)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in broadcast_if_small(wide, 1000)._jdf.queryExecution().analyzed().toString()


def test_exact_median_of_large_cohorts(spark):
    from cohortlens.operators.metrics import medians
    n = 2_000_000
    values = spark.range(0, 2 * n, 1, 16).select(
        F.when(F.col("id") % 2 == 0, F.lit("alive")).otherwise(F.lit("dead")).alias("cohort"),
        (F.col("id") * 7919 % (2 * n)).alias("days"))
    got = {r["cohort"]: r["days_median"] for r in medians(values, ("days",)).collect()}
    exact = {r["cohort"]: r["m"] for r in values.groupBy("cohort").agg(
        F.expr("percentile_disc(0.5) within group (order by days)").alias("m")).collect()}
    assert got == {k: int(v) for k, v in exact.items()} == {"alive": n - 2, "dead": n - 1}
    plan = _plan(medians(values, ("days",)))
    assert "percentile" not in plan and "partial_sum" not in plan and "partial_count" in plan


def test_hot_patient_samples_equal_operator_chain(spark):
    ev, mo = _skewed(spark)
    idx = calculate_index_dates(ev, mo)
    agg = aggregate_events(filter_events(ev, idx))
    chain = svmlight_samples(svmlight_convert(normalization(agg), generate_feature_mapping(agg)), mo)
    out = build_samples(ev, mo)
    assert rows(out["samples"]) == rows(chain)
    release(out)


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_common_codes_limits_before_shuffle(spark):
    ev, mo = _skewed(spark)
    plan = _plan(common_codes(ev, mo, 5))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_profile_aggregates_before_shuffle(spark):
    ev, mo = _skewed(spark)
    plan = _plan(patient_profile(ev, mo))
    assert "partial_count" in plan and "partial_max" in plan


def test_gd_step_on_colocated_samples_has_no_per_step_shuffle(spark):
    from cohortlens.operators.linear import gd_step, zero_weights
    from cohortlens.sources import parse_svmlight
    lines = spark.createDataFrame([(f"{i % 2} {i % 7}:1.0 {i % 11}:0.5",) for i in range(500)],
                                  "value string")
    samples = parse_svmlight(lines).withColumn("sid", F.monotonically_increasing_id())
    data = samples.select("sid", "y", "x").repartition("sid").persist()   # as train_gd does
    data.count()
    plan = _plan(gd_step(data, zero_weights(spark), 0.1, 0.0, 500, id_col="sid"))
    per_step = [ln for ln in plan.splitlines()
                if "hashpartitioning(sid" in ln and "ENSURE_REQUIREMENTS" in ln]
    assert per_step == [] and "Window" not in plan
    assert not [ln for ln in plan.splitlines() if " Sort [sid" in ln]
    data.unpersist()
