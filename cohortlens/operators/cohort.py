"""Cohort operators: alive/dead tagging, index dates, observation window,
duplicate-key report.

Semantics kept from the original tool:
* alive = no mortality row, or a mortality row whose label is null;
  dead = label 1; label 0 is in neither cohort (metrics only);
* index date: alive -> last event date; every mortality row (any label)
  -> death date minus 30 days, so a null-label patient with events gets two
  index rows and a dead patient without events still gets one;
* duplicate mortality rows fan out the joins (``validate_unique`` reports
  them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import as_date
from cohortlens.operators.joins import DEFAULT_BROADCAST_BYTES, DEFAULT_HOT_ROWS, broadcast_if_small, key_filter, salted_join
from cohortlens.session import checkpoint_dir

ALIVE = "alive"
DEAD = "dead"
COHORTS = (ALIVE, DEAD)

# Fixed window lengths (days) of the original tool.
INDEX_OFFSET_DAYS = 30
OBSERVATION_DAYS = 2000


def _events(events: DataFrame) -> DataFrame:
    if "etimestamp" in events.columns:
        return events.withColumn("etimestamp", as_date(events, "etimestamp"))
    return events


def _mortality(mortality: DataFrame) -> DataFrame:
    if "mtimestamp" in mortality.columns:
        return mortality.withColumn("mtimestamp", as_date(mortality, "mtimestamp"))
    return mortality


def mortality_weights(mortality: DataFrame) -> DataFrame:
    """(patientid, n_dead_rows, n_null_rows): how many mortality rows of a
    patient have label 1 and label null.

    Joining event rows with mortality multiplies each event by the number
    of matching rows; these counts let per-patient aggregates reproduce
    that fan-out exactly without joining event-level rows.
    """
    return mortality.groupBy("patientid").agg(
        F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).cast("long").alias("n_dead_rows"),
        F.sum(F.when(F.col("label").isNull(), 1).otherwise(0)).cast("long").alias("n_null_rows"))


def with_cohorts(per_patient: DataFrame, mortality: DataFrame,
                 broadcast_bytes: int | None = None) -> DataFrame:
    """Tag per-patient rows: adds ``cohort`` and ``copies`` (the number of
    joined rows the original event-level join would give that cohort).

    alive: no mortality row (1 copy) or label-null rows (one copy each);
    dead: label-1 rows (one copy each); label 0 is in neither. A patient
    can be in both cohorts. The join is one row per patient on both sides,
    so a patient with a huge share of events costs nothing extra here.

    By default the planner picks the join from size statistics and AQE
    re-checks the real size at run time. With ``broadcast_bytes`` the
    per-patient mortality summary is broadcast if its size is within it (one
    job over that summary).
    """
    summary = mortality_weights(mortality)
    if broadcast_bytes is not None:
        summary = broadcast_if_small(summary, broadcast_bytes)
    j = per_patient.join(summary, "patientid", "left")
    alive = F.when(F.col("n_dead_rows").isNull(), F.lit(1)).otherwise(F.col("n_null_rows"))
    dead = F.coalesce(F.col("n_dead_rows"), F.lit(0))
    tags = F.array(F.struct(F.lit(ALIVE).alias("cohort"), alive.cast("long").alias("copies")),
                   F.struct(F.lit(DEAD).alias("cohort"), dead.cast("long").alias("copies")))
    keep = [c for c in per_patient.columns]
    return (j.select(*keep, F.explode(tags).alias("_t"))
            .where(F.col("_t.copies") > 0)
            .select(*keep, F.col("_t.cohort").alias("cohort"), F.col("_t.copies").alias("copies")))


def tag_cohort(events: DataFrame, mortality: DataFrame,
               broadcast_bytes: int | None = None) -> DataFrame:
    """events + ``label`` + ``cohort`` ('alive', 'dead' or null for label 0).

    One left join on patientid tags both cohorts at once, instead of two
    filtered copies of the join. The mortality side is broadcast when the
    planner's size estimate or AQE's run-time size is below the broadcast
    threshold, or — with ``broadcast_bytes`` — when an explicit size check is
    within it; otherwise a shuffle join, where AQE splits a patient holding
    a large share of the events. Events without a patient id can match no
    mortality row: they are tagged alive beside the join, so that they do not
    meet in one partition of it.
    """
    ev = _events(events)
    deaths = mortality.select("patientid", "label")
    if broadcast_bytes is not None:
        deaths = broadcast_if_small(deaths, broadcast_bytes)
    tagged = ev.where(F.col("patientid").isNotNull()).join(deaths, "patientid", "left")
    nobody = ev.where(F.col("patientid").isNull()).withColumn("label", F.lit(None).cast(mortality.schema["label"].dataType))
    tagged = tagged.unionByName(nobody)
    cohort = (F.when(F.col("label").isNull(), F.lit(ALIVE))
              .when(F.col("label") == 1, F.lit(DEAD)))
    return tagged.withColumn("cohort", cohort)


def split_alive_dead(events: DataFrame, mortality: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(alive_events, dead_events), both with the input event columns."""
    tagged = tag_cohort(events, mortality)
    cols = [c for c in _events(events).columns]
    alive = tagged.where(F.col("cohort") == ALIVE).select(*cols)
    dead = tagged.where(F.col("cohort") == DEAD).select(*cols)
    return alive, dead


def calculate_index_dates(events: DataFrame, mortality: DataFrame,
                          offset_days: int = INDEX_OFFSET_DAYS) -> DataFrame:
    """(patientid, index_date date).

    alive (no mortality row, or a null label): last event date, one row per
    patient; dead: every mortality row's date minus ``offset_days``.
    The last event date is aggregated per patient (map-side partial max)
    before the alive/dead tag is joined, one row per patient on each side.
    """
    ev = _events(events)
    mo = _mortality(mortality)
    last = ev.groupBy("patientid").agg(F.max("etimestamp").alias("index_date"))
    alive_index = (with_cohorts(last, mo).where(F.col("cohort") == ALIVE)
                   .select("patientid", "index_date"))
    dead_index = mo.select("patientid",
                           F.date_sub(F.col("mtimestamp"), offset_days).alias("index_date"))
    return alive_index.unionByName(dead_index)


def index_bounds(index_dates: DataFrame, window_days: int = OBSERVATION_DAYS) -> tuple:
    """(first, last) date that any patient's window has; (None, None)
    without index dates. One aggregation."""
    row = index_dates.agg(F.date_sub(F.min("index_date"), window_days).alias("lo"), F.max("index_date").alias("hi")).first()
    return row["lo"], row["hi"]


def prune_events(events: DataFrame, index_dates: DataFrame, window_days: int = OBSERVATION_DAYS,
                 patients: bool = True, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``events`` without the rows that no window can hold, before any
    shuffle: dates outside the bounds of all windows, as literals that reach
    the file scan, and (``patients``) patients without an index date, by a
    broadcast Bloom filter (``joins.key_filter``). A few rows of other
    patients stay; the window join drops them.

    ``index_dates`` (patientid, index_date) is read twice: pass it checkpointed.
    """
    lo, hi = index_bounds(index_dates, window_days)
    if lo is None:
        return events.limit(0)
    inside = events.where(F.col("etimestamp").between(F.lit(lo), F.lit(hi)))
    if not patients:
        return inside
    return key_filter(inside, index_dates.where(F.col("index_date").isNotNull()), "patientid", broadcast_bytes)


def filter_events(events: DataFrame, index_dates: DataFrame,
                  window_days: int = OBSERVATION_DAYS, hot_rows: int = DEFAULT_HOT_ROWS,
                  patients: bool = True) -> DataFrame:
    """Events inside [index_date - window_days, index_date], both ends
    inclusive; output keeps (patientid, eventid, etimestamp, value).

    The index dates (a few rows a patient) are checkpointed once; the events
    are pruned by them before the shuffle (``prune_events``; ``patients=False``
    leaves the Bloom filter out where all patients are known to have an index
    date). Then an equi-join on patientid with the range as a condition on its
    rows. Patients with more than ``hot_rows`` events are split over several
    tasks (``joins.salted_join``; one count job over the patient ids).
    """
    checkpoint_dir(events.sparkSession)
    ev = _events(events).select("patientid", "eventid", "etimestamp", "value")
    idx = index_dates.select("patientid", as_date(index_dates, "index_date").alias("index_date")).checkpoint(eager=True)
    ev = prune_events(ev, idx, window_days, patients)
    return (salted_join(ev, idx, "patientid", hot_rows).where(in_window(window_days))
            .select("patientid", "eventid", "etimestamp", "value"))


def in_window(window_days: int = OBSERVATION_DAYS) -> Column:
    """Whether a row's ``etimestamp`` is in its ``index_date``'s window."""
    return F.col("etimestamp").between(F.date_sub(F.col("index_date"), window_days), F.col("index_date"))


def validate_unique(df: DataFrame, key: str = "patientid") -> DataFrame:
    """(key, n_rows) for every key that occurs more than once."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))
