"""SVMLight text lines -> (y, x) rows, as a Spark job.

Line grammar: ``label i:v i:v ...`` separated by whitespace, label read as
a float; a label alone gives an empty feature list. Indices are 0-based,
which is why Spark's own ``libsvm`` source (1-based) is not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SAMPLE_X_TYPE = "array<struct<i:int,v:double>>"


def parse_svmlight(df: DataFrame, column: str = "value") -> DataFrame:
    """Add ``y double`` and ``x array<struct<i int, v double>>`` parsed from
    the text column; other columns are kept. Any white space separates and
    may surround the tokens. A blank line or a bad label gives a null y (the
    learners and the evaluation leave such rows out), a pair without a colon
    or with a bad number null fields, which the learners skip."""
    line = F.regexp_replace(F.col(column), r"^\s+|\s+$", "")
    tokens = F.split(line, r"\s+")
    pairs = F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0)))

    def field(kv, k):
        return F.get(F.split(kv, ":"), F.lit(k))

    x = F.transform(pairs, lambda kv: F.struct(field(kv, 0).try_cast("int").alias("i"),
                                               field(kv, 1).try_cast("double").alias("v")))
    y = F.get(tokens, F.lit(0)).try_cast("double")
    return df.withColumn("y", y).withColumn("x", x)


def read_svmlight(spark: SparkSession, path: str) -> DataFrame:
    """(line, y, x) for every non-empty line of the text file(s)."""
    lines = spark.read.text(path).where(F.col("value").rlike(r"\S"))
    return parse_svmlight(lines, "value").withColumnRenamed("value", "line")


def bad_pairs() -> Column:
    """How many of a parsed line's pairs have no index or no value."""
    return F.size(F.filter("x", lambda e: e["i"].isNull() | e["v"].isNull()))


def report_columns() -> list[Column]:
    """What a folder's report counts: lines, lines with any fault, lines
    without a label, and faulty pairs."""
    return [F.count(F.lit(1)).alias("n_lines"), F.count("bad_record").alias("n_bad_lines"),
            F.count(F.when(F.col("y").isNull(), 1)).alias("n_no_label"), F.coalesce(F.sum(bad_pairs()), F.lit(0)).cast("long").alias("n_bad_pairs")]


def read_svmlight_checked(spark: SparkSession, path: str, counts: Observation | None = None) -> DataFrame:
    """``read_svmlight`` with ``bad_record``: the line where the label or a
    pair does not parse, else null. With ``counts`` the first action on the
    rows takes the report in the same scan: ``counts.get`` after it."""
    rows = read_svmlight(spark, path)
    rows = rows.withColumn("bad_record", F.when(F.col("y").isNull() | (bad_pairs() > 0), F.col("line")))
    return rows.observe(counts, *report_columns()) if counts is not None else rows


def svmlight_report(checked: DataFrame) -> DataFrame:
    """One row: the counts of a checked folder (one aggregation)."""
    return checked.agg(*report_columns())


def file_order(spark: SparkSession, path: str) -> DataFrame:
    """``read_svmlight`` with ``position``, a struct that orders the lines as
    the files have them: file path, the split's start in the file, and the
    line's number within the split's task."""
    lines = spark.read.text(path).select(
        F.col("value").alias("line"), F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                                               F.monotonically_increasing_id().alias("nth")).alias("position"))
    return parse_svmlight(lines.where(F.col("line").rlike(r"\S")), "line")
