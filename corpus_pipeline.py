"""A training corpus from ``documents``: rank quality, drop near copies, remove
secrets, mix sources, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's result as Parquet to the shared folder and reads it back as the
next one's docs. All but the last return the columns of ``documents``.

Rows with a null doc_id or text pass the filters: they are scored like any
other text, are no near copies of anything, hold no secrets and have size 0 in
the mix, which takes them as often as its source's rate says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.llm.common import drop_shared, prepare, shared_path, table, write_shared
from cohortlens.llm.ngram_join import distinct_texts
from cohortlens.llm.quality_ranker import rank_quality
from cohortlens.llm.secret_scan import redacted_documents
from cohortlens.llm.sentencepiece_codec import encode
from cohortlens.llm.source_mixing import mixed_documents


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier predicts as 1."""
    good = (rank_quality(docs, table(spark, sf_dir, "labels")).where("predicted = 1")
            .select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).distinct())
    same = docs["doc_id"].cast("long").eqNullSafe(good["_id"]) & (F.xxhash64(docs["text"]) == good["_mark"])
    return docs.join(good, same, "left_semi")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that of its smallest doc_id.
    Rows that share a doc_id are judged each by its own text; of rows with the
    same doc_id and text the first by source and lang stays."""
    heads = distinct_texts(docs).withColumnRenamed("mark", "_mark")
    first = W.partitionBy("_id", "_mark").orderBy("row.source", "row.lang")
    rows = docs.where("doc_id is not null").select(docs["doc_id"].cast("long").alias("_id"), F.xxhash64("text").alias("_mark"),
                                                   F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    kept = rows.join(heads.withColumnRenamed("doc_id", "_id"), ["_id", "_mark"], "left_semi").withColumn("_nth", F.row_number().over(first))
    return kept.where("_nth = 1").select("row.*").unionByName(docs.where("doc_id is null"))


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret of a text replaced by its kind; n_chars follows the text."""
    clean = redacted_documents(docs, shared_path(spark, "ledger"))
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix by weights 3, 1, 2 takes them."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text: doc_id, ids, n_tokens, n_bytes, round_trip, parity."""
    return encode(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", remove_secrets),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", tokens),
]

# A learned classifier and a tokenizer are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    prepare(spark)
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = write_shared(stage(spark, docs, sf_dir), "stage")
        if last is not None:  # its rows are in the next one's folder
            drop_shared(last)
        last = docs
    return docs
