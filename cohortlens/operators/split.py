"""Train/test split by a deterministic hash of the patient id.

The original tool used ``randomSplit([0.2, 0.8], seed=48)``, whose
membership changes with the input partitioning. Hashing the key gives the
same split on any partitioning, on re-execution after executor loss, and in
any engine with md5; no shuffle is involved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions import hash_fraction_below
from cohortlens.sources.folders import delete_folder, replace_folders, staging_folder

# Fixed values of the original split: test share and seed.
TEST_FRACTION = 0.2
SPLIT_SALT = "48"

TRAIN, TEST = "train", "test"


def in_test(key: str = "patientid", fraction: float = TEST_FRACTION, salt: str = SPLIT_SALT) -> Column:
    """Whether a row's key is on the test side (a null key is not)."""
    return F.coalesce(hash_fraction_below(F.col(key), fraction, salt), F.lit(False))


def hash_split(df: DataFrame, key: str = "patientid", fraction: float = TEST_FRACTION,
               salt: str = SPLIT_SALT) -> tuple[DataFrame, DataFrame]:
    """(test, train): test holds about ``fraction`` of the keys; the two
    sides are disjoint and together hold every row (a null key goes to
    train)."""
    chosen = in_test(key, fraction, salt)
    return df.where(chosen), df.where(~chosen)


def write_samples(samples: DataFrame, path: str, column: str = "save_feature") -> None:
    """Write one sample line per row as text; earlier output is replaced once
    the new one is complete."""
    staged = staging_folder(path)
    samples.select(column).write.text(staged)
    replace_folders(samples.sparkSession, {staged: path})


def train_test_split(samples: DataFrame, train_path: str, test_path: str,
                     fraction: float = TEST_FRACTION, salt: str = SPLIT_SALT,
                     column: str = "save_feature") -> dict[str, int]:
    """Split on patientid and write both sides as SVMLight text; returns the
    lines written to each side.

    One job: the samples are computed once, every task writes the lines of
    both sides (a write partitioned by side, into a folder beside
    ``train_path``), and the lines are counted on the way. Only when the job
    has succeeded do the two folders replace earlier output; a job that fails
    leaves both old sides as they were. Both paths are on one file system. A
    side without lines is an empty folder.
    """
    spark = samples.sparkSession
    staged, counts = staging_folder(train_path), Observation()
    side = F.when(in_test("patientid", fraction, salt), F.lit(TEST)).otherwise(F.lit(TRAIN))
    lines = samples.select(F.col(column).alias("value"), side.alias("side")).observe(
        counts, *(F.count(F.when(F.col("side") == s, 1)).alias(s) for s in (TRAIN, TEST)))
    try:
        lines.write.partitionBy("side").text(staged)
        replace_folders(spark, {f"{staged}/side={TRAIN}": train_path, f"{staged}/side={TEST}": test_path})
    finally:
        delete_folder(spark, staged)
    return {side: int(counts.get[side]) for side in (TRAIN, TEST)}


def read_split(spark: SparkSession, train_path: str, test_path: str) -> DataFrame:
    """(side, save_feature): the lines of both written sides."""
    sides = [spark.read.text(p).select(F.lit(s).alias("side"), F.col("value").alias("save_feature"))
             for s, p in ((TRAIN, train_path), (TEST, test_path))]
    return sides[0].unionByName(sides[1])
