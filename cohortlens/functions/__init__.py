"""Column-expression helpers. All return ``pyspark.sql.Column`` built from
``pyspark.sql.functions`` so they stay inside whole-stage codegen."""

from cohortlens.functions.columns import (
    as_date,
    binary_label,
    hash_fraction_below,
    hash_threshold_hex,
    sigmoid,
    svm_token,
)

__all__ = [
    "as_date",
    "binary_label",
    "hash_fraction_below",
    "hash_threshold_hex",
    "sigmoid",
    "svm_token",
]
