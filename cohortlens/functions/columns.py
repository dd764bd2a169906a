from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_date(df: DataFrame, name: str) -> Column:
    """``name`` as a DATE column whatever it is stored as.

    ISO strings go through ``try_to_date`` so a malformed value becomes null
    instead of an ANSI error; timestamps are truncated; dates pass through.
    """
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.DateType):
        return F.col(name)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.col(name).cast("date")
    return F.try_to_date(F.col(name).cast("string"))


def binary_label(label: Column) -> Column:
    """1 when the mortality label is exactly 1, else 0 (null included)."""
    return F.when(label == 1, F.lit(1)).otherwise(F.lit(0))


def svm_token(index: Column, value: Column) -> Column:
    """``"index:value"`` with the value printed with 3 decimals."""
    return F.concat_ws(":", index.cast("string"), F.format_number(value, 3))


def sigmoid(margin: Column) -> Column:
    """Logistic function 1 / (1 + e^-m); overflow gives 0.0, not an error."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def hash_threshold_hex(fraction: float) -> str:
    """Eight hex digits ``h`` such that a uniform 32-bit hash is below ``h``
    with probability ``fraction`` (0.2 -> '33333333')."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    return format(min(int(fraction * 4294967296), 4294967295), "08x")


def hash_fraction_below(key: Column, fraction: float, salt: str) -> Column:
    """Deterministic membership test: true for about ``fraction`` of keys.

    Uses the first 32 bits of ``md5("<key>:<salt>")`` compared as hex text,
    so the same keys are chosen on any partitioning, on every re-run and in
    any engine that has md5.
    """
    if fraction >= 1.0:
        return F.lit(True)
    digest = F.substring(F.md5(F.concat(key.cast("string"), F.lit(":" + salt))), 1, 8)
    return digest < F.lit(hash_threshold_hex(fraction))
