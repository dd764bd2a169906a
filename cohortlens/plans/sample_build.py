"""Supervised sample building: index dates -> observation window -> counts
-> code index and max-normalisation -> sparse rows -> labelled lines."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.cohort import calculate_index_dates, filter_events, in_window, index_bounds
from cohortlens.operators.features import (
    aggregate_events,
    code_stats,
    highest_index,
    normalization,
    normalized_value,
    sparse_rows,
    svmlight_convert,
    svmlight_samples,
)
from cohortlens.operators.joins import DEFAULT_BROADCAST_BYTES, DEFAULT_HOT_ROWS, broadcast_if_small
from cohortlens.sources.folders import write_once

if TYPE_CHECKING:
    from cohortlens.sources.event_table import EventTable

_CACHED = ("agg_events",)


def build_samples(events: DataFrame, mortality: DataFrame,
                  event_map: DataFrame | None = None, maxima: DataFrame | None = None,
                  broadcast_bytes: int | None = DEFAULT_BROADCAST_BYTES,
                  hot_rows: int = DEFAULT_HOT_ROWS, cache: bool = True) -> dict[str, DataFrame]:
    """All intermediate tables of the feature job.

    Plan: the last event date per patient (map-side combined) gives the index
    dates; the window join runs on the raw event rows with patients above
    ``hot_rows`` events split over tasks; its rows are counted per patient and
    code with partial sums before the shuffle. Only these counts, which feed
    the per-code table and the join with it, are persisted. The per-code table
    (maximum count and dense index together) is checkpointed and broadcast
    when its size is within ``broadcast_bytes``, so normalisation, indexing and
    the ``> 0`` filter are one map-side join. Sparse rows are one
    ``collect_list`` per patient.

    ``event_map`` / ``maxima`` may be passed in (e.g. fitted on a training
    side); by default both are fitted on all patients, as the original tool
    does. Jobs run when called: the hot-patient count and the per-code table.
    Call ``release(result)`` when done with the tables; with ``cache=False``
    the counts are written once to the shared folder instead and need no release.
    """
    index_dates = calculate_index_dates(events, mortality)
    agg = aggregate_events(filter_events(events, index_dates, hot_rows=hot_rows, patients=False))
    return {"index_dates": index_dates, **samples_from_counts(agg, mortality, event_map, maxima, broadcast_bytes, cache)}


def colocated_counts(table: EventTable, mortality: DataFrame, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """(patientid, eventid, feature_value) of a co-located event table: index
    dates, window join and counts without an exchange of its bucketed rows (the
    mortality rows are sent to the buckets). Hot patients' rows go the way of
    ``build_samples``."""
    cold = table.cold
    lo, hi = index_bounds(calculate_index_dates(cold, mortality))
    inside = cold.where(F.col("etimestamp").between(F.lit(lo), F.lit(hi))) if lo is not None else cold.limit(0)
    # of two sides one is bucketed: the other, a few rows a patient, is sent to it
    joined = inside.join(calculate_index_dates(cold, mortality).hint("shuffle_hash"), "patientid")
    counts = aggregate_events(joined.where(in_window()))
    aside = table.hot
    hot = aggregate_events(filter_events(aside, calculate_index_dates(aside, mortality), hot_rows=hot_rows))
    return counts.unionByName(hot)


def build_samples_colocated(table: EventTable, mortality: DataFrame,
                            event_map: DataFrame | None = None, maxima: DataFrame | None = None,
                            broadcast_bytes: int | None = DEFAULT_BROADCAST_BYTES,
                            hot_rows: int = DEFAULT_HOT_ROWS, cache: bool = True) -> dict[str, DataFrame]:
    """``build_samples`` over a co-located event table (without the index
    dates)."""
    return samples_from_counts(colocated_counts(table, mortality, hot_rows), mortality, event_map, maxima, broadcast_bytes, cache)


def samples_from_counts(agg: DataFrame, mortality: DataFrame,
                        event_map: DataFrame | None = None, maxima: DataFrame | None = None,
                        broadcast_bytes: int | None = DEFAULT_BROADCAST_BYTES, cache: bool = True) -> dict[str, DataFrame]:
    """The part of the feature job after the counts per patient and code."""
    agg = agg.persist(StorageLevel.MEMORY_AND_DISK) if cache else write_once(agg, "counts")
    if event_map is None and maxima is None:
        stats = code_stats(agg)
        side = broadcast_if_small(stats, broadcast_bytes) if broadcast_bytes is not None else stats
        normalized = (agg.join(side, "eventid", "inner")
                      .select("patientid", "eventid", "event_index",
                              normalized_value().alias("normalized_feature_value")))
        svmlight = sparse_rows(normalized.where(F.col("normalized_feature_value") > 0), highest_index(stats))
        event_map = stats.select("eventid", "event_index")
        maxima = stats.select("eventid", "max_value")
        normalized = normalized.drop("event_index")
    else:
        if event_map is None or maxima is None:
            fitted = code_stats(agg)
            event_map = event_map if event_map is not None else fitted.select("eventid", "event_index")
            maxima = maxima if maxima is not None else fitted.select("eventid", "max_value")
        normalized = normalization(agg, maxima, broadcast_bytes)
        svmlight = svmlight_convert(normalized, event_map, broadcast_bytes)
    samples = svmlight_samples(svmlight, mortality)
    return {
        "agg_events": agg,
        "event_map": event_map,
        "maxima": maxima,
        "normalized": normalized,
        "svmlight": svmlight,
        "samples": samples,
    }


def release(tables: dict[str, DataFrame]) -> None:
    """Unpersist the tables ``build_samples`` cached."""
    for name in _CACHED:
        if name in tables:
            tables[name].unpersist()
