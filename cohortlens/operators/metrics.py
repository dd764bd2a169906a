"""Cohort profile metrics and most-frequent codes.

Everything is two aggregation levels: one per-patient aggregation
computing every per-patient figure in one pass (partial aggregation on the
map side, so a patient with a huge share of events is combined before the
shuffle), then one ``groupBy(cohort)`` computing every cohort figure. The
cohort tag is joined to per-patient rows, never to event rows. The
original tool ran 28 separate driver collects for the same numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.operators.cohort import ALIVE, COHORTS, DEAD, _events, with_cohorts

# Code classes, and their count-column names.
CODE_CLASSES = ("DIAG", "LAB", "DRUG")
CLASS_COUNT_COLUMN = {"DIAG": "diag_count", "LAB": "lab_count", "DRUG": "med_count"}


def _cohort_list(spark) -> DataFrame:
    return spark.range(1).select(
        F.explode(F.array(*[F.lit(c) for c in COHORTS])).alias("cohort"))


def _finish_profile(df: DataFrame) -> DataFrame:
    return df.select("cohort", "patientid", "n_events", "n_encounters", "first_date",
                     "last_date", F.datediff("last_date", "first_date").alias("record_days"))


def patient_profile(events: DataFrame, mortality: DataFrame) -> DataFrame:
    """(cohort, patientid, n_events, n_encounters, first_date, last_date,
    record_days) for every patient of the alive and dead cohorts.

    Aggregates per patient first (map-side partial aggregation; the
    distinct-day count is planned as two partial steps keyed by patient and
    date), then tags the per-patient rows with their cohorts.
    n_encounters counts distinct non-null event dates; record_days is the
    number of days between the first and the last event.
    """
    ev = _events(events)
    per_patient = ev.groupBy("patientid").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_distinct("etimestamp").alias("n_encounters"),
        F.min("etimestamp").alias("first_date"),
        F.max("etimestamp").alias("last_date"))
    tagged = with_cohorts(per_patient, mortality)
    return _finish_profile(tagged.withColumn("n_events", F.col("_n") * F.col("copies")))


def profile_from_tagged(tagged: DataFrame) -> DataFrame:
    """Same columns as ``patient_profile`` from events already carrying a
    ``cohort`` column (null = in no cohort)."""
    per_patient = (tagged.where(F.col("cohort").isNotNull())
                   .groupBy("cohort", "patientid")
                   .agg(F.count(F.lit(1)).alias("n_events"),
                        F.count_distinct("etimestamp").alias("n_encounters"),
                        F.min("etimestamp").alias("first_date"),
                        F.max("etimestamp").alias("last_date")))
    return _finish_profile(per_patient)


def medians(profile: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(cohort, <column>_median ...): the exact lower median of each column,
    nulls left out: the first value whose running count reaches half.

    A histogram by (cohort, column, value) is counted with map-side partial
    sums; only its rows, as many as there are different values (days, or days
    with events), are ordered by a window.
    """
    kinds = F.explode(F.array(*(F.struct(F.lit(c).alias("kind"), F.col(c).cast("long").alias("value"))
                                for c in columns))).alias("v")
    hist = (profile.select("cohort", kinds).select("cohort", "v.kind", "v.value").where(F.col("value").isNotNull())
            .groupBy("cohort", "kind", "value").agg(F.count(F.lit(1)).alias("n")))
    own = Window.partitionBy("cohort", "kind")
    upto = own.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = hist.select("cohort", "kind", "value", F.sum("n").over(upto).alias("cum"), F.sum("n").over(own).alias("all"))
    return (ranked.where(F.col("cum") * 2 >= F.col("all")).groupBy("cohort")
            .agg(*(F.min(F.when(F.col("kind") == c, F.col("value"))).alias(f"{c}_median") for c in columns)))


def cohort_metrics(profile: DataFrame) -> DataFrame:
    """One row per cohort ('alive', 'dead'), always both: an empty cohort
    gives a row of nulls instead of an error.

    Columns: events_avg/min/max, encounters_avg/median/min/max,
    days_avg/median/min/max; medians are the lower ones, exact.
    """
    agg = profile.groupBy("cohort").agg(
        F.avg("n_events").alias("events_avg"),
        F.min("n_events").alias("events_min"),
        F.max("n_events").alias("events_max"),
        F.avg("n_encounters").alias("encounters_avg"),
        F.min("n_encounters").alias("encounters_min"),
        F.max("n_encounters").alias("encounters_max"),
        F.avg("record_days").alias("days_avg"),
        F.min("record_days").alias("days_min"),
        F.max("record_days").alias("days_max"),
    )
    mid = medians(profile, ("n_encounters", "record_days")).select(
        "cohort", F.col("n_encounters_median").alias("encounters_median"),
        F.col("record_days_median").cast("int").alias("days_median"))
    # ``agg`` and ``mid`` have at most one row per cohort (two): a proven broadcast bound.
    return (_cohort_list(profile.sparkSession).join(F.broadcast(agg), "cohort", "left")
            .join(F.broadcast(mid), "cohort", "left")
            .select("cohort", "events_avg", "events_min", "events_max", "encounters_avg", "encounters_median",
                    "encounters_min", "encounters_max", "days_avg", "days_median", "days_min", "days_max"))


def _tag_pair(alive_events: DataFrame, dead_events: DataFrame) -> DataFrame:
    a = _events(alive_events).select("patientid", "eventid", "etimestamp")
    d = _events(dead_events).select("patientid", "eventid", "etimestamp")
    return (a.withColumn("cohort", F.lit(ALIVE))
            .unionByName(d.withColumn("cohort", F.lit(DEAD))))


def _per_cohort(metrics: DataFrame, names: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    cols = [F.col(src).alias(dst) for src, dst in names.items()]
    return (metrics.where(F.col("cohort") == ALIVE).select(*cols),
            metrics.where(F.col("cohort") == DEAD).select(*cols))


def event_count_metrics(alive_events: DataFrame, dead_events: DataFrame):
    """(alive, dead) one-row frames (avg, min, max) of events per patient."""
    m = cohort_metrics(profile_from_tagged(_tag_pair(alive_events, dead_events)))
    return _per_cohort(m, {"events_avg": "avg", "events_min": "min", "events_max": "max"})


def encounter_count_metrics(alive_events: DataFrame, dead_events: DataFrame):
    """(alive, dead) one-row frames (avg, median, min, max) of distinct
    event days per patient."""
    m = cohort_metrics(profile_from_tagged(_tag_pair(alive_events, dead_events)))
    return _per_cohort(m, {"encounters_avg": "avg", "encounters_median": "median",
                           "encounters_min": "min", "encounters_max": "max"})


def record_length_metrics(alive_events: DataFrame, dead_events: DataFrame):
    """(alive, dead) one-row frames (avg, median, min, max) of days between
    first and last event per patient."""
    m = cohort_metrics(profile_from_tagged(_tag_pair(alive_events, dead_events)))
    return _per_cohort(m, {"days_avg": "avg", "days_median": "median",
                           "days_min": "min", "days_max": "max"})


def top_codes(events: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most frequent codes (eventid, count); ties by eventid.

    A global top-k: Spark plans it as TakeOrderedAndProject, i.e. a
    per-partition top-k before a single small merge.
    """
    return (events.groupBy("eventid").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col("eventid").asc())
            .limit(k))


def _top_per_class(counted: DataFrame, k: int) -> DataFrame:
    classes = F.array(*[F.lit(c) for c in CODE_CLASSES])
    by_class = counted.select(
        "cohort", "eventid", "code_count",
        F.explode(F.filter(classes, lambda c: F.col("eventid").contains(c))).alias("code_class"))
    order = Window.partitionBy("cohort", "code_class").orderBy(
        F.col("code_count").desc(), F.col("eventid").asc())
    ranked = by_class.withColumn("rank", F.row_number().over(order))
    return (ranked.where(F.col("rank") <= k)
            .select("cohort", "code_class", "rank", "eventid", "code_count"))


def common_codes(events: DataFrame, mortality: DataFrame, k: int = 5) -> DataFrame:
    """Top-``k`` codes per (cohort, code class) in one job.

    (cohort, code_class, rank, eventid, code_count). The class test is
    "contains" (LIKE '%DIAG%'), so one code may count in two classes.
    Events are counted per (patient, code) first (map-side partial
    aggregation), tagged per patient, summed per (cohort, code), and only
    those rows get classes; ``row_number() <= k`` is planned as a partial
    window-group limit before the shuffle.
    """
    per_code = (_events(events).groupBy("patientid", "eventid")
                .agg(F.count(F.lit(1)).alias("_n")))
    return _codes_per_cohort(per_code, mortality, k)


def _codes_per_cohort(per_code: DataFrame, mortality: DataFrame, k: int) -> DataFrame:
    tagged = with_cohorts(per_code, mortality)
    counted = (tagged.groupBy("cohort", "eventid")
               .agg(F.sum(F.col("_n") * F.col("copies")).alias("code_count")))
    return _top_per_class(counted, k)


def common_codes_from_tagged(tagged: DataFrame, k: int = 5) -> DataFrame:
    """``common_codes`` for events already carrying a ``cohort`` column."""
    counted = (tagged.where(F.col("cohort").isNotNull())
               .groupBy("cohort", "eventid")
               .agg(F.count(F.lit(1)).alias("code_count")))
    return _top_per_class(counted, k)


def common_codes_by_class(alive_events: DataFrame, dead_events: DataFrame, k: int = 5):
    """Six frames in the original order: alive diag, lab, med, dead diag,
    lab, med; each (eventid, <class>_count) sorted by rank."""
    tidy = common_codes_from_tagged(_tag_pair(alive_events, dead_events), k)
    out = []
    for cohort in COHORTS:
        for cls in CODE_CLASSES:
            out.append(tidy.where((F.col("cohort") == cohort) & (F.col("code_class") == cls))
                       .orderBy("rank")
                       .select("eventid", F.col("code_count").alias(CLASS_COUNT_COLUMN[cls])))
    return tuple(out)
