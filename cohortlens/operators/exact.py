"""Sums of doubles that do not depend on the order of the addends.

Every addend is cut, without rounding, into digits of 28 bits on a fixed grid
of exponents (bins). Digits are integers, so a bin's sum is exact and the same
however the rows are partitioned, by partial sums like any other. A group has
75 bins at most; they are put together from the largest down with their
rounding errors carried along twice, which gives the true sum within one unit
in the last place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 28
_LOWEST = -1074                       # exponent of the smallest double
_TOP = (1024 - _LOWEST) // BITS       # bin of the largest exponent
_DIGIT = 2.0 ** -BITS


def _unit(at: Column) -> Column:
    """2 to the power of a bin's lowest exponent (exact: a power of two)."""
    return F.pow(F.lit(2.0), (at * BITS + _LOWEST).cast("double"))


def _with_digits(df: DataFrame, value: str) -> DataFrame:
    """``df`` with ``_slot`` (0, 1, 2), ``_bin`` and ``_digit``: every row up
    to three times, digit * unit(bin) summing to the value; a row without
    digits (zero, null, not finite) once."""
    x, inf = F.col("_x"), F.lit(float("inf"))
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) != inf)
    rows = df.withColumn("_x", F.col(value).cast("double"))
    rows = rows.withColumn("_odd", F.when(x.isNotNull() & ~finite, x)).withColumn("_rest", F.when(finite & (x != 0), x).otherwise(0.0))
    top = F.floor((F.log2(F.abs("_rest")) - _LOWEST) / BITS)  # of zero: null
    rows = rows.withColumn("_top", F.least(F.lit(_TOP), F.greatest(F.lit(2), F.coalesce(top, F.lit(2)))).cast("int"))
    rows = rows.withColumn("_u0", _unit(F.col("_top")))
    parts = []
    for i in range(3):
        unit, digit = F.col(f"_u{i}"), F.col(f"_d{i}")
        rows = rows.withColumn(f"_d{i}", (F.col("_rest") / unit).cast("bigint"))  # the cast cuts towards zero
        rows = rows.withColumn("_rest", F.col("_rest") - digit.cast("double") * unit).withColumn(f"_u{i + 1}", unit * _DIGIT)
        parts.append(F.struct(F.lit(i).alias("_slot"), (F.col("_top") - i).alias("_bin"), digit.alias("_digit")))
    rows = rows.select(*df.columns, "_odd", "_x", F.inline(F.array(*parts)))
    return rows.where("_slot = 0 or _digit <> 0")


def _error_free(terms: Column) -> tuple[Column, Column]:
    """(sum as rounded, the errors of its steps), which together are exact."""

    def step(state: Column, t: Column) -> Column:
        total = state["s"] + t
        back = total - state["s"]
        error = (state["s"] - (total - back)) + (t - back)
        return F.struct(total.alias("s"), F.concat(state["e"], F.array(error)).alias("e"))

    start = F.struct(F.lit(0.0).alias("s"), F.array().cast("array<double>").alias("e"))
    done = F.aggregate(terms, start, step)
    return done["s"], done["e"]


def exact_sum(df: DataFrame, keys: list[str], value: str, alias: str = "total", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per group of ``keys``: the keys, the first non-null of each
    ``carry`` column, and the sum of ``value``, the same to the bit on any
    partitioning. Nulls are left out; a group without values sums to null.
    Infinities and NaN give what plain addition gives. Up to 2^35 rows a
    group."""
    rows = _with_digits(df.select(*keys, *carry, F.col(value).alias("_value")), "_value")
    own = F.col("_slot") == 0
    bins = rows.groupBy(*keys, "_bin").agg(
        F.sum("_digit").alias("_digit"), F.sum(F.when(own, F.col("_odd"))).alias("_odd"), F.count(F.when(own, F.col("_x"))).alias("_n"),
        *(F.first(c, ignorenulls=True).alias(c) for c in carry))
    sums = bins.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("_bin", "_digit")), asc=False).alias("_bins"), F.sum("_odd").alias("_odd"), F.sum("_n").alias("_n"),
        *(F.first(c, ignorenulls=True).alias(c) for c in carry))
    # a bin's sum as two doubles without rounding
    high = F.transform("_bins", lambda b: F.shiftright(b["_digit"], 32).cast("double") * 4294967296.0 * _unit(b["_bin"]))
    low = F.transform("_bins", lambda b: F.pmod(b["_digit"], F.lit(1 << 32)).cast("double") * _unit(b["_bin"]))
    sums = sums.withColumn("_terms", F.concat(high, low))
    for i in range(2):
        s, errors = _error_free(F.col("_terms"))
        sums = sums.withColumn("_pair", F.struct(s.alias("s"), errors.alias("e"))).withColumn(f"_s{i}", F.col("_pair.s")).withColumn("_terms", F.col("_pair.e"))
    rest = F.aggregate("_terms", F.lit(0.0), lambda a, t: a + t)
    total = F.col("_s0") + (F.col("_s1") + rest)
    # beyond the largest double the errors are not numbers
    total = F.when(F.abs("_s0") == float("inf"), F.col("_s0")).otherwise(total)
    return sums.select(*keys, *carry, F.when(F.col("_n") > 0, F.coalesce("_odd", total)).alias(alias))
