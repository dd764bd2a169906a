"""Headerless CSV inputs: raw event and mortality files, their ingest
projections (parse the ISO date, drop the free-text description), and the
channel of lines that do not fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.functions import as_date

# Fixed input layouts of the two CSV files (column order matters: no header).
EVENTS_CSV_SCHEMA = T.StructType([
    T.StructField("patientid", T.IntegerType(), True),
    T.StructField("eventid", T.StringType(), True),
    T.StructField("eventdesc", T.StringType(), True),
    T.StructField("timestamp", T.StringType(), True),
    T.StructField("value", T.FloatType(), True),
])

MORTALITY_CSV_SCHEMA = T.StructType([
    T.StructField("patientid", T.IntegerType(), True),
    T.StructField("timestamp", T.StringType(), True),
    T.StructField("label", T.IntegerType(), True),
])


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             mode: str = "PERMISSIVE") -> DataFrame:
    """Headerless CSV with an explicit schema (no inference pass).

    PERMISSIVE turns unparsable numbers into nulls, as the original tool does.
    """
    return spark.read.csv(path, header=False, schema=schema, mode=mode)


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The schema's columns, as ``read_csv`` gives them, and ``bad_record``:
    the whole line where a field does not parse or the fields are too few or
    too many, else null. Blank lines are skipped.

    Every line is parsed with the whole schema. The file reader would parse
    the columns that a query uses only, so that which lines are bad would
    follow from the query."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad_record"}
    return lines.select(F.from_csv("value", f"{ddl}, bad_record string", options).alias("r"), "value").select(
        *(F.col(f"r.{f.name}").alias(f.name) for f in schema.fields), F.col("r.bad_record").alias("bad_record"), F.col("value").alias("line"))


def ingest_events(raw: DataFrame) -> DataFrame:
    """raw events -> (patientid, eventid, etimestamp date, value)."""
    return raw.select(
        "patientid", "eventid",
        as_date(raw, "timestamp").alias("etimestamp"),
        "value",
    )


def ingest_mortality(raw: DataFrame) -> DataFrame:
    """raw mortality -> (patientid, mtimestamp date, label)."""
    return raw.select(
        "patientid",
        as_date(raw, "timestamp").alias("mtimestamp"),
        "label",
    )


def read_events(spark: SparkSession, path: str, mode: str = "PERMISSIVE") -> DataFrame:
    return ingest_events(read_csv(spark, path, EVENTS_CSV_SCHEMA, mode))


def read_mortality(spark: SparkSession, path: str, mode: str = "PERMISSIVE") -> DataFrame:
    return ingest_mortality(read_csv(spark, path, MORTALITY_CSV_SCHEMA, mode))


def _checked(raw: DataFrame, ingest, counts: Observation | None) -> DataFrame:
    """Ingested rows with ``bad_record``, which also has lines whose date is
    there but does not parse; ``counts`` observes ``report_columns``."""
    bad_date = (F.trim("timestamp") != "") & as_date(raw, "timestamp").isNull()
    bad = F.coalesce("bad_record", F.when(bad_date, F.col("line")))
    date = "etimestamp" if ingest is ingest_events else "mtimestamp"
    names = [c for c in raw.columns if c not in ("eventdesc", "timestamp", "bad_record", "line")]
    rows = raw.select(*names, as_date(raw, "timestamp").alias(date), bad.alias("bad_record"))
    rows = rows.select(*ingest(raw).columns, "bad_record")
    return rows.observe(counts, *report_columns(date)) if counts is not None else rows


def report_columns(date: str = "etimestamp") -> list[Column]:
    """What a file's report counts: lines, lines that do not fit, rows without
    a patient and rows without a date."""
    return [F.count(F.lit(1)).alias("n_lines"), F.count("bad_record").alias("n_bad_lines"),
            F.count(F.when(F.col("patientid").isNull(), 1)).alias("n_no_patient"), F.count(F.when(F.col(date).isNull(), 1)).alias("n_no_date")]


def read_events_checked(spark: SparkSession, path: str, counts: Observation | None = None) -> DataFrame:
    """``read_events`` with ``bad_record`` (null: the line fits). With
    ``counts`` the report is taken by the first action on the rows, in the same
    scan: ``counts.get`` after it."""
    return _checked(read_csv_checked(spark, path, EVENTS_CSV_SCHEMA), ingest_events, counts)


def read_mortality_checked(spark: SparkSession, path: str, counts: Observation | None = None) -> DataFrame:
    """``read_mortality`` with ``bad_record``; ``counts`` as for events."""
    return _checked(read_csv_checked(spark, path, MORTALITY_CSV_SCHEMA), ingest_mortality, counts)


def source_report(checked: DataFrame) -> DataFrame:
    """One row: the counts of a checked source (one aggregation)."""
    return checked.agg(*report_columns("etimestamp" if "etimestamp" in checked.columns else "mtimestamp"))


__all__ = [
    "EVENTS_CSV_SCHEMA", "MORTALITY_CSV_SCHEMA", "ingest_events", "ingest_mortality", "read_csv", "read_csv_checked", "read_events",
    "read_events_checked", "read_mortality", "read_mortality_checked", "report_columns", "source_report",
]
