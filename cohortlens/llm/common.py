"""Shared helpers of the training-data operators: table reads, tables written
to the shared folder, and connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.session import checkpoint_dir, ship_package
from cohortlens.sources.folders import delete_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder and package for the Python workers."""
    checkpoint_dir(spark)
    ship_package(spark)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder (``spark.checkpoint.dir``)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex}"


def write_shared(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the
    lineage, survives lost executors, and is computed once."""
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.shared_folder = path
    return out


def drop_shared(df: DataFrame) -> None:
    """Delete the folder of a table that ``write_shared`` gave, once nothing
    reads it any more."""
    delete_folder(df.sparkSession, df.shared_folder)


def text_copies(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For rows (doc_id, mark, text): (doc_id, mark) of the smallest document
    of every text, and (doc_id, mark, copy = true) of the others that have it."""
    ids = write_shared(docs.select("doc_id", "mark", F.sha2("text", 256).alias("sha")), "texts")
    # only texts with copies, written: the join can then split a text that very many documents have
    heads = write_shared(ids.groupBy("sha").agg(F.min("doc_id").alias("head"), F.count("*").alias("n")).where("n > 1"), "heads")
    named = write_shared(ids.join(heads, "sha", "left").select("doc_id", "mark", F.coalesce("head", "doc_id").alias("head")).distinct(), "copies")
    drop_shared(ids)
    drop_shared(heads)
    return (named.where("doc_id = head").select("doc_id", "mark"),
            named.where("doc_id > head").select("doc_id", "mark", F.lit(True).alias("copy")))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of an undirected graph given as (a, b) long edges;
    component is the smallest node reachable. Nodes without edges are not
    returned.

    Alternating large-star and small-star rounds (each an aggregation of the
    neighbours of a node down to one minimum, never a list of them), every
    round written to the shared folder. Rounds grow with the logarithm of a
    component's length. Self loops, repeated and null edges are ignored.
    """
    cur = (edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
           .where("a is not null and b is not null and a <> b")
           .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    cur = write_shared(cur, "cc")
    seen = None
    for _ in range(max_rounds):
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = large.where("u <> v").distinct()
        # small star: every node and its smaller neighbours point at the smallest of them
        small_min = large.groupBy("u").agg(F.min("v").alias("m"))
        cur2 = (large.join(small_min, "u")
                .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                          F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                .select("e.u", "e.v").where("u <> v").distinct())
        last, cur = cur, write_shared(cur2, "cc")
        drop_shared(last)
        state = cur.agg(F.count("*").alias("n"), F.countDistinct("u").alias("d"),
                        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if seen == state:  # a round that changes nothing: every node points at its root
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
