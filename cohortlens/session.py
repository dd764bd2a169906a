"""Session helpers: a local session for tests / bench, and the reliable
checkpoint folder lookup used to cut lineage.

Library functions never create a session; they use ``df.sparkSession``.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "cohortlens", checkpoints: str | None = None) -> SparkSession:
    """Local session with AQE on, UI off and UTC session time;
    ``checkpoints`` becomes ``spark.checkpoint.dir``.

    Only for tests and the bench; on a cluster the caller's session is used
    as it is.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("COHORTLENS_DRIVER_MEM", "8g"))
    )
    if checkpoints:
        builder = builder.config("spark.checkpoint.dir", checkpoints)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when unset.

    Order: a folder already set on the context, then ``spark.checkpoint.dir``
    from the session conf (the shared folder a cluster names). Only where
    neither is set does a single-process master (``local``, ``local[n]``) get a
    fresh temporary folder, as in tests; a cluster without the setting is an
    error, because a machine-local folder does not survive executor loss. Old
    checkpoints go with their DataFrames when
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is true.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the folder
        if conf_dir:
            return conf_dir
        raise RuntimeError("spark.checkpoint.dir is not set on the Spark Connect server")
    current = sc.getCheckpointDir()
    if current:
        return current
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if sc.master == "local" or sc.master.startswith("local["):
        local_dir = tempfile.mkdtemp(prefix="cohortlens-ckpt-")
        sc.setCheckpointDir(local_dir)
        return local_dir
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at a shared folder "
        "(HDFS/S3/...) so checkpointed lineage survives executor loss")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers.

    Task functions of operators that run Python on executors refer to this
    package, so the package is zipped (``.py`` files only) once
    per application and added with ``SparkContext.addPyFile`` — what
    ``spark-submit --py-files`` does. A no-op when already shipped, and on
    Spark Connect (ship the package with the job there).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect
        return
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="cohortlens-pyfiles-"), "cohortlens.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)
