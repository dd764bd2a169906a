"""Events stored co-located by patient: a bucketed table for most patients and
a plain one for the few with very many events.

Jobs over the bucketed part (index dates, window join, counts per patient and
code) need no exchange of event rows: every bucket is already the partition
that they would be sent to. A patient with a large share of all events would
make one bucket a long task, so such patients' rows, and rows without a
patient, are kept beside it and are split over tasks by the jobs that read
them.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators.joins import DEFAULT_HOT_ROWS, broadcast_if_small, hot_keys
from cohortlens.session import checkpoint_dir

# Events of one bucket, about: what a task of the co-located jobs takes.
BUCKET_ROWS = 2_000_000
COLUMNS = ["patientid", "eventid", "etimestamp", "value"]


@dataclass(frozen=True)
class EventTable:
    """``name``: the bucketed table in the session's catalog; ``hot_path``:
    the rows of hot patients and of none, as Parquet."""

    spark: SparkSession
    name: str
    hot_path: str

    @property
    def cold(self) -> DataFrame:
        return self.spark.table(self.name)

    @property
    def hot(self) -> DataFrame:
        return self.spark.read.parquet(self.hot_path)

    def drop(self) -> None:
        """Forget the table's name; its files in the folder stay."""
        self.spark.sql(f"drop table if exists {self.name}")


def write_event_table(events: DataFrame, folder: str, buckets: int | None = None,
                      hot_rows: int = DEFAULT_HOT_ROWS, name: str | None = None) -> EventTable:
    """Write ``events`` (patientid, eventid, etimestamp, value) to ``folder``
    in ``buckets`` buckets by patient (default: the session's shuffle
    partitions), or in more where these would have over ``BUCKET_ROWS`` events
    each, sorted by patient within. One shuffle of the rows, by the
    buckets themselves, so that each bucket is one file. Patients with more
    than ``hot_rows`` events go to the plain part."""
    spark = events.sparkSession
    checkpoint_dir(spark)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(buckets, -(-events.count() // BUCKET_ROWS))
    name = name or f"events_{uuid.uuid4().hex}"
    events = events.select(*COLUMNS)
    known = events.where(F.col("patientid").isNotNull())
    hot = broadcast_if_small(hot_keys(known, "patientid", hot_rows).select("patientid").checkpoint(eager=True))
    aside = events.where(F.col("patientid").isNull()).unionByName(known.join(hot, "patientid", "left_semi").select(*COLUMNS))
    aside.write.parquet(f"{folder}/hot")
    (known.join(hot, "patientid", "left_anti").select(*COLUMNS).repartition(buckets, "patientid").write.format("parquet")
     .bucketBy(buckets, "patientid").sortBy("patientid").option("path", f"{folder}/cold").saveAsTable(name))
    return EventTable(spark, name, f"{folder}/hot")
