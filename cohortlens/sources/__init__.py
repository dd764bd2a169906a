"""Readers and writers."""

from cohortlens.sources.csv_events import (
    EVENTS_CSV_SCHEMA,
    MORTALITY_CSV_SCHEMA,
    ingest_events,
    ingest_mortality,
    read_csv,
    read_csv_checked,
    read_events,
    read_events_checked,
    read_mortality,
    read_mortality_checked,
    source_report,
)
from cohortlens.sources.model_store import load_model, model_versions, save_model
from cohortlens.sources.svmlight import file_order, parse_svmlight, read_svmlight, read_svmlight_checked, svmlight_report
from cohortlens.sources.tables import cohort_inputs, events_from_orders, mortality_from_customers

__all__ = [
    "EVENTS_CSV_SCHEMA", "MORTALITY_CSV_SCHEMA", "cohort_inputs", "events_from_orders", "file_order", "ingest_events",
    "ingest_mortality", "load_model", "model_versions", "mortality_from_customers", "parse_svmlight", "read_csv",
    "read_csv_checked", "read_events", "read_events_checked", "read_mortality", "read_mortality_checked", "read_svmlight",
    "read_svmlight_checked", "save_model", "source_report", "svmlight_report",
]
