"""Models as a versioned table.

``<path>/version=<n>`` holds one model: its weights, and one row of parameters
with the number of weights, in the same Parquet files of one write. A version
counts only if its parameter row is there and as many weights as it says; a
write that broke off is passed over by every reader, and the next write takes
a new number. Versions are never changed.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.session import checkpoint_dir

PARAMS = "eta double, mu double, n_feature int, rule string"
_COLUMNS = f"feature_index int, weight double, n_weights long, saved_by string, {PARAMS}"


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(f"{_COLUMNS}, version int").option("basePath", path).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":  # nothing saved yet
            return None
        raise


def save_model(weights: DataFrame, path: str, eta: float, mu: float, n_feature: int,
               rule: str = "textbook") -> int:
    """Append (feature_index, weight) and the parameters as a new version;
    returns its number. The weights are computed once (a reliable checkpoint)
    and written by one job."""
    spark = weights.sparkSession
    checkpoint_dir(spark)
    rows = weights.select(F.col("feature_index").cast("int").alias("feature_index"),
                          F.col("weight").cast("double").alias("weight")).checkpoint(eager=True)
    old = _table(spark, path)
    version = 1 + ((old.agg(F.max("version")).first()[0] or 0) if old is not None else 0)
    params = spark.createDataFrame([(rows.count(), uuid.uuid4().hex, float(eta), float(mu), int(n_feature), rule)],
                                   f"n_weights long, saved_by string, {PARAMS}")
    whole = rows.withColumn("saved_by", F.lit(params.first()["saved_by"])).unionByName(params, allowMissingColumns=True)
    whole.select(*(c.split()[0] for c in _COLUMNS.split(", "))).write.mode("append").parquet(f"{path}/version={version}")
    return version


def model_versions(spark: SparkSession, path: str) -> DataFrame:
    """(version, eta, mu, n_feature, rule, n_weights, saved_by) of the
    complete versions. Should two writers have taken one number, the version is
    the one whose ``saved_by`` sorts first."""
    table = _table(spark, path)
    if table is None:
        return spark.createDataFrame([], f"version int, {PARAMS}, n_weights long, saved_by string")
    found = table.groupBy("version", "saved_by").agg(
        F.count("feature_index").alias("there"), *(F.max(c).alias(c) for c in ("n_weights", "eta", "mu", "n_feature", "rule")))
    whole = found.where("there = n_weights")
    first = whole.groupBy("version").agg(F.min("saved_by").alias("saved_by"))
    return whole.join(first, ["version", "saved_by"]).select("version", "eta", "mu", "n_feature", "rule", "n_weights", "saved_by")


def load_model(spark: SparkSession, path: str, version: int | None = None) -> tuple[DataFrame, dict]:
    """(weights DataFrame, params dict) of a version; by default of the
    latest complete one. Only the versions tried have their weights counted."""
    table = _table(spark, path)
    if table is not None:
        heads = table.where(F.col("n_weights").isNotNull())
        heads = heads.where(F.col("version") == version) if version is not None else heads
        for row in heads.orderBy(F.col("version").desc(), "saved_by").toLocalIterator():
            mine = (F.col("version") == row["version"]) & (F.col("saved_by") == row["saved_by"])
            weights = table.where(mine & F.col("feature_index").isNotNull()).select("feature_index", "weight")
            if weights.count() == row["n_weights"]:
                return weights, {k: row[k] for k in ("version", "eta", "mu", "n_feature", "rule", "n_weights", "saved_by")}
    raise FileNotFoundError(f"no complete model{'' if version is None else f' of version {version}'} in {path}")
