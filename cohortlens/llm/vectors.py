"""Shared helpers of the vector operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import write_shared

SMALL = 4096  # vectors of one length that are compared in one task


def usable_vectors(frame: DataFrame) -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part: vec_id not null,
    vector neither null nor zero, its components all finite. One row for each
    vec_id: the first in the order of the values, should a vec_id repeat.
    Vectors of different lengths have no distance; see ``lengths``."""
    rows = frame.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where("vec_id is not null and v is not null").where(fine).where(F.exists("v", lambda x: x != 0.0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def usable_once(frame: DataFrame) -> DataFrame:
    """``usable_vectors``, where only rows of repeated vec_ids are brought
    together. Vectors of floats stay floats, and -0.0 becomes 0.0."""
    single = frame.schema["embedding"].dataType.simpleString() == "array<float>"
    rows = frame.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{'float' if single else 'double'}>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where("vec_id is not null and v is not null")
    twice = write_shared(rows.groupBy("vec_id").count().where("count > 1").select("vec_id"), "repeated")
    rows = rows.where(fine).where(F.exists("v", lambda x: x != 0.0))
    zero = F.lit(0.0).cast("float" if single else "double")
    rows = rows.withColumn("v", F.transform("v", lambda x: x + zero))
    again = rows.join(twice, "vec_id", "left_semi").groupBy("vec_id").agg(F.min("v").alias("v"))
    return rows.join(twice, "vec_id", "left_anti").unionByName(again)


def lengths(vectors: DataFrame, small: int = SMALL) -> tuple[list[int], DataFrame]:
    """(the most common length and all with more than ``small`` vectors, the
    vectors of the other lengths with ``length``): vectors of one length are a
    table of their own, compared within itself. The others fit a task each
    length. The driver sees one number a length."""
    sized = vectors.withColumn("length", F.size("v"))
    counts = sized.groupBy("length").count().orderBy(F.desc("count"), "length").collect()
    many = [r["length"] for i, r in enumerate(counts) if i == 0 or r["count"] > small]
    return many, sized.where(~F.col("length").isin(many)) if many else sized


def classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rep, copies, v) with one row per distinct vector, rep its smallest
    vec_id, and (vec_id, rep) for every vector. Vectors of one class have equal
    components (so 0.0 and -0.0 count as equal)."""
    plain = vectors.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    own = plain.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    return own.select("rep", "copies", "v"), plain.join(own.select("v", "rep"), "v").select("vec_id", "rep")


def classes_by_hash(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, v, asks, alone) with one row per distinct vector of (vec_id, v,
    asks), node its smallest vec_id, asks whether any of them asks; and
    (vec_id, node, asks) of the vectors that others may equal (not alone).
    Only vectors whose hash repeats are compared."""
    marked = vectors.select("vec_id", "v", "asks", F.xxhash64("v").alias("h"))
    again = write_shared(marked.groupBy("h").count().where("count > 1").select("h"), "repeated")
    alone = marked.join(again, "h", "left_anti").select(F.col("vec_id").alias("node"), "v", "asks", F.lit(True).alias("alone"))
    twice = marked.join(again, "h", "left_semi")
    by_hash = write_shared(twice.groupBy("h").agg(F.min("v").alias("v"), F.max("v").alias("last"), F.min("vec_id").alias("node"), F.max("asks").alias("asks")), "by-hash")
    mixed = twice.join(by_hash.where("v <> last").select("h"), "h", "left_semi")  # unlike vectors of one hash
    own = mixed.groupBy("v").agg(F.min("vec_id").alias("node"), F.max("asks").alias("asks"))
    reps = by_hash.where("v = last").select("node", "v", "asks").unionByName(own.select("node", "v", "asks"))
    of = twice.select("vec_id", "h", "asks").join(by_hash.where("v = last").select("h", "node"), "h").select("vec_id", "node", "asks")
    return (alone.unionByName(reps.withColumn("alone", F.lit(False))),
            of.unionByName(mixed.join(own.select("v", "node"), "v").select("vec_id", "node", "asks")))


def matrix(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of equally long lists as a matrix in double precision."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0))


def lists(rows: np.ndarray) -> pa.ListArray:
    n, d = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * d), pa.array(rows.ravel()))
