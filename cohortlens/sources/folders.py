"""Output folders: new ones in the shared folder, and replacing old ones only
once everything new is written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cohortlens.session import checkpoint_dir


def new_folder(spark: SparkSession, tag: str) -> str:
    """A path not used yet, in the folder that the cluster shares."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def write_once(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as Parquet to a new folder and read back: computed once
    however often it is used, in fewer bytes than a checkpoint."""
    path = new_folder(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staging_folder(beside: str) -> str:
    """A hidden path not used yet, in the folder of ``beside``."""
    parent, _, name = beside.rstrip("/").rpartition("/")
    return f"{parent or '.'}/.{name}-{uuid.uuid4().hex}"


def replace_folders(spark: SparkSession, staged: dict[str, str]) -> None:
    """Move every staged folder (key) to its target (value) on the same file
    system. Old targets are set aside first and deleted at the end; if a move
    fails they are put back, so that either all targets are new or all are
    old. A staged folder that was never written (no rows) gives an empty
    target."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    aside: list[tuple] = []
    placed: list[tuple] = []
    try:
        for source, target in staged.items():
            fs = path(target).getFileSystem(conf)
            if fs.exists(path(target)):
                old = path(staging_folder(target))
                if not fs.rename(path(target), old):
                    raise OSError(f"cannot set aside {target}")
                aside.append((fs, old, path(target)))
        for source, target in staged.items():
            fs = path(target).getFileSystem(conf)
            if not fs.exists(path(source)):
                fs.mkdirs(path(source))
            fs.mkdirs(path(target).getParent())
            if not fs.rename(path(source), path(target)):
                raise OSError(f"cannot move {source} to {target}")
            placed.append((fs, path(target)))
    except Exception:
        for fs, target in placed:
            fs.delete(target, True)
        for fs, old, target in aside:
            fs.rename(old, target)
        raise
    for fs, old, _ in aside:
        fs.delete(old, True)


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder and all in it, if it is there."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
