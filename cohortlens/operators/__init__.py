"""Relational operators over DataFrames. Most are lazy; those that check a
size, number rows or train a model run jobs when called and say so."""

from cohortlens.operators.cohort import (
    calculate_index_dates,
    filter_events,
    mortality_weights,
    split_alive_dead,
    tag_cohort,
    validate_unique,
    with_cohorts,
)
from cohortlens.operators.evaluation import auc, confusion_counts, roc_points
from cohortlens.operators.features import (
    aggregate_events,
    code_maxima,
    code_stats,
    generate_feature_mapping,
    normalization,
    sparse_rows,
    svmlight_convert,
    svmlight_samples,
    unmapped_codes,
    with_sample_id,
)
from cohortlens.operators.linear import (
    check_feature_range,
    classify,
    gd_step,
    margins,
    score,
    train_gd,
    train_sgd,
    zero_weights,
)
from cohortlens.operators.metrics import (
    cohort_metrics,
    common_codes,
    common_codes_by_class,
    common_codes_from_tagged,
    encounter_count_metrics,
    event_count_metrics,
    medians,
    patient_profile,
    profile_from_tagged,
    record_length_metrics,
    top_codes,
)
from cohortlens.operators.ordering import dense_index, running_totals
from cohortlens.operators.split import hash_split, read_split, train_test_split, write_samples

__all__ = [
    "aggregate_events", "auc", "calculate_index_dates", "check_feature_range", "classify", "code_maxima", "code_stats",
    "cohort_metrics", "common_codes", "common_codes_by_class", "common_codes_from_tagged", "confusion_counts", "dense_index",
    "encounter_count_metrics", "event_count_metrics", "filter_events", "gd_step", "generate_feature_mapping", "hash_split",
    "margins", "medians", "mortality_weights", "normalization", "patient_profile", "profile_from_tagged",
    "read_split", "record_length_metrics", "roc_points", "running_totals", "score", "sparse_rows", "split_alive_dead", "svmlight_convert",
    "svmlight_samples", "tag_cohort", "top_codes", "train_gd", "train_sgd", "train_test_split", "unmapped_codes",
    "validate_unique", "with_cohorts", "with_sample_id", "write_samples", "zero_weights",
]
