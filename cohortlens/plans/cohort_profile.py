"""Cohort profile: every statistic of the original statistics run, returned as
DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortlens.operators.metrics import cohort_metrics, common_codes, patient_profile


def cohort_profile(events: DataFrame, mortality: DataFrame, k: int = 5) -> dict[str, DataFrame]:
    """{'patients', 'metrics', 'common_codes'}.

    ``metrics`` has one row per cohort with event-count, encounter and
    record-length figures; ``common_codes`` the top-k codes per cohort and
    class. Each is a direct aggregation of the columns it needs (the events
    are scanned once for either), per patient or per patient and code with
    map-side partial sums before the cohort tag is joined; no event row is
    kept or joined. Nothing runs until a result is used.
    """
    patients = patient_profile(events, mortality)
    return {
        "patients": patients,
        "metrics": cohort_metrics(patients),
        "common_codes": common_codes(events, mortality, k),
    }
