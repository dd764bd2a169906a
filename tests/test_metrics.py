"""Cohort split, metrics and top codes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import (
    common_codes,
    common_codes_by_class,
    encounter_count_metrics,
    event_count_metrics,
    record_length_metrics,
    split_alive_dead,
    tag_cohort,
    top_codes,
    validate_unique,
)
from cohortlens.operators.metrics import (
    cohort_metrics,
    common_codes_from_tagged,
    patient_profile,
    profile_from_tagged,
)
from helpers import rows

# (patientid, n_events, n_encounters, record_days), own figures
ALIVE = [(11, 40, 5, 9), (12, 90, 20, 300)]
DEAD = [(21, 30, 4, 6), (22, 60, 10, 50), (23, 99, 30, 61)]


def _patient_events(pid, n_events, n_enc, days):
    start = dt.date(2000, 1, 1)
    # n_enc distinct dates from start to start + days (both ends used)
    dates = [start + dt.timedelta(days=round(i * days / (n_enc - 1))) for i in range(n_enc)]
    assert len(set(dates)) == n_enc
    out = []
    for k in range(n_events):
        out.append((pid, f"DIAG{k % 3}", dates[k % n_enc].isoformat(), 1.0))
    return out


@pytest.fixture(scope="module")
def cohort(spark):
    data = []
    for p in ALIVE + DEAD:
        data += _patient_events(*p)
    events = spark.createDataFrame(data, ["patientid", "eventid", "etimestamp", "value"])
    mortality = spark.createDataFrame([(p[0], "2001-01-01", 1) for p in DEAD],
                                      "patientid long, mtimestamp string, label int")
    return split_alive_dead(events, mortality)


def test_event_counts(cohort):
    alive, dead = event_count_metrics(*cohort)
    assert alive.columns == ["avg", "min", "max"]
    assert tuple(alive.first()) == (65.0, 40, 90) and tuple(dead.first()) == (63.0, 30, 99)


def test_encounters(cohort):
    alive, dead = encounter_count_metrics(*cohort)
    assert alive.columns == ["avg", "median", "min", "max"]
    assert tuple(alive.first()) == (12.5, 5, 5, 20)            # lower median of two
    a = dead.first()
    assert a["avg"] == pytest.approx(44 / 3) and (a["median"], a["min"], a["max"]) == (10, 4, 30)


def test_record_lengths(cohort):
    alive, dead = record_length_metrics(*cohort)
    assert tuple(alive.first()) == (154.5, 9, 9, 300) and tuple(dead.first()) == (39.0, 50, 6, 61)


def test_cohort_semantics(spark):
    events = spark.createDataFrame(
        [(1, "DIAG1", "2000-01-01", 1.0), (2, "DIAG1", "2000-01-01", 1.0),
         (3, "DIAG1", "2000-01-01", 1.0), (4, "LAB1", "2000-01-01", 1.0)],
        ["patientid", "eventid", "etimestamp", "value"])
    mortality = spark.createDataFrame(
        [(2, "2000-02-01", 1), (3, "2000-02-01", 0), (4, "2000-02-01", None)],
        "patientid long, mtimestamp string, label int")
    alive, dead = split_alive_dead(events, mortality)
    assert rows(alive, "patientid") == [(1,), (4,)]   # no row, or null label
    assert rows(dead, "patientid") == [(2,)]          # label 0 is in neither cohort


def test_empty_cohort_gives_null_row(spark):
    events = spark.createDataFrame([(1, "DIAG1", "2000-01-01", 1.0)],
                                   ["patientid", "eventid", "etimestamp", "value"])
    mortality = spark.createDataFrame([], "patientid long, mtimestamp string, label int")
    m = {r["cohort"]: r for r in cohort_metrics(patient_profile(events, mortality)).collect()}
    assert m["alive"]["events_max"] == 1
    assert m["dead"]["events_avg"] is None and m["dead"]["days_median"] is None
    alive, dead = event_count_metrics(*split_alive_dead(events, mortality))
    assert dead.first()["avg"] is None


def test_top_codes_ties_by_code(spark):
    events = spark.createDataFrame(
        [(1, c, "2000-01-01", 1.0) for c in ["B", "A", "C", "C", "D", "E", "F"]],
        ["patientid", "eventid", "etimestamp", "value"])
    out = [tuple(r) for r in top_codes(events, 3).collect()]
    assert out == [("C", 2), ("A", 1), ("B", 1)]


def test_common_codes_contains_rule_and_limit(spark):
    data = []
    for code, n in [("DIAG1", 5), ("DIAG2", 4), ("LABDIAG", 3), ("LAB1", 6), ("DRUG9", 2)]:
        data += [(1, code, "2000-01-01", 1.0)] * n
    events = spark.createDataFrame(data, ["patientid", "eventid", "etimestamp", "value"])
    mortality = spark.createDataFrame([], "patientid long, mtimestamp string, label int")
    tidy = common_codes(events, mortality, k=2)
    got = rows(tidy, "cohort", "code_class", "rank", "eventid", "code_count")
    assert got == sorted([
        ("alive", "DIAG", 1, "DIAG1", 5), ("alive", "DIAG", 2, "DIAG2", 4),
        ("alive", "LAB", 1, "LAB1", 6), ("alive", "LAB", 2, "LABDIAG", 3),
        ("alive", "DRUG", 1, "DRUG9", 2)], key=repr)
    six = common_codes_by_class(*split_alive_dead(events, mortality), k=2)
    assert [f.columns[1] for f in six] == ["diag_count", "lab_count", "med_count"] * 2
    assert [tuple(r) for r in six[0].collect()] == [("DIAG1", 5), ("DIAG2", 4)]
    assert six[3].count() == 0


def test_validate_unique(spark):
    mortality = spark.createDataFrame([(1, "2000-01-01", 1), (1, "2000-02-01", 1), (2, "2000-01-01", 1)],
                                      ["patientid", "mtimestamp", "label"])
    assert rows(validate_unique(mortality)) == [(1, 2)]


def test_csv_reader_roundtrip(spark, tmp_path):
    from cohortlens.sources import read_events, read_mortality
    ev = tmp_path / "events.csv"
    ev.write_text("501,DIAG77,desc,1996-05-06,1.0\nbad,DIAG1,d,x,oops\n")
    mo = tmp_path / "mortality.csv"
    mo.write_text("502,1999-07-08,1\n")
    e = read_events(spark, str(ev))
    assert e.columns == ["patientid", "eventid", "etimestamp", "value"]
    got = rows(e)
    assert (501, "DIAG77", dt.date(1996, 5, 6), 1.0) in got
    assert (None, "DIAG1", None, None) in got
    assert rows(read_mortality(spark, str(mo))) == [(502, dt.date(1999, 7, 8), 1)]
    assert e.where(F.col("patientid").isNull()).count() == 1


def _fanout_inputs(spark):
    events = spark.createDataFrame(
        [(p, c, f"2000-01-{d:02d}", 1.0)
         for p in range(1, 7) for d in range(1, 4 + p) for c in ("DIAG1", "LAB2", "DRUG3")[: 1 + d % 3]]
        + [(6, None, "2000-02-01", 1.0), (6, "DIAG1", None, 1.0)],
        "patientid long, eventid string, etimestamp string, value double")
    mortality = spark.createDataFrame(
        [(2, "2000-03-01", 1), (3, "2000-03-01", 1), (3, "2000-03-05", 1),   # duplicate dead rows
         (4, "2000-03-01", None), (4, "2000-03-02", None),                   # two null-label rows
         (5, "2000-03-01", 0), (6, "2000-03-01", None), (6, "2000-03-01", 1)],
        "patientid long, mtimestamp string, label int")
    return events, mortality


def test_patient_level_tagging_equals_event_level_join(spark):
    events, mortality = _fanout_inputs(spark)
    tagged = tag_cohort(events, mortality)
    assert rows(patient_profile(events, mortality)) == rows(profile_from_tagged(tagged))
    assert rows(common_codes(events, mortality, 3)) == rows(common_codes_from_tagged(tagged, 3))


def test_explicit_broadcast_check_same_result(spark):
    from cohortlens.operators.cohort import with_cohorts
    events, mortality = _fanout_inputs(spark)
    per_patient = events.groupBy("patientid").agg(F.count(F.lit(1)).alias("n"))
    base = rows(with_cohorts(per_patient, mortality))
    assert rows(with_cohorts(per_patient, mortality, broadcast_bytes=100_000)) == base   # broadcast
    assert rows(with_cohorts(per_patient, mortality, broadcast_bytes=2)) == base     # shuffle join
    assert rows(tag_cohort(events, mortality, broadcast_bytes=100_000)) == rows(tag_cohort(events, mortality))
