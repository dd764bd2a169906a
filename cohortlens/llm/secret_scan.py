"""Secret scans with an incremental blob ledger.

Every version of every document is content-addressed (SHA-256 of its text, as
in a version-control store). A ledger in a shared folder lists which blobs
have been scanned under which rule version, with their findings. A scan reads
only blobs that the ledger does not have under the present rules, once each
however many paths hold them, adds their findings to the ledger, and joins
the findings back to all paths. All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.common import prepare, shared_path, table

# The base rules as the contract words them, (kind, pattern, group whose length counts, least length).
RULES = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
)
RULE_VERSION = "base-1"
# A cheaper pattern that every text with a kept match of the kind has.
_HINT = {"assign": r"""(?i)(?:passw|secret|token|api_?key)[a-z]*["']?\x20*[:=]""", "access": r"AKIA[A-Z0-9]{12}",
         "hex": r"[0-9a-f]{32}"}
_NO_SPANS = "array<struct<start:int,rank:int,span:string>>"


def _spans(text: Column, rank: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """Spans of the leftmost non-overlapping matches that are long enough. The
    text between matches gives where they start."""
    re = F.lit(pattern)
    found = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, re, F.lit(0)).alias("hit"),
                         F.regexp_extract_all(text, re, F.lit(group)).alias("part"))

    def walk(state: Column, m: Column) -> Column:
        start = state["at"] + F.length(m["gap"])
        end = start + F.length(m["hit"])
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"),
                        F.concat_ws(":", F.lit(kind), start.cast("string"), end.cast("string")).alias("span"))
        keep = F.coalesce(F.length(m["part"]) >= least, F.lit(False))  # the last gap has no match after it
        return F.struct(F.coalesce(end, start).alias("at"),
                        F.when(keep, F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"))

    empty = F.array().cast(_NO_SPANS)
    walked = F.aggregate(found, F.struct(F.lit(0).alias("at"), empty.alias("out")), walk, lambda s: s["out"])
    return F.when(text.rlike(_HINT[kind]), walked).otherwise(empty)


def scan_texts(blobs: DataFrame) -> DataFrame:
    """(blob, n_assign, n_access, n_hex, spans) for blobs (blob, text)."""
    found = blobs.select("blob", *(_spans(F.col("text"), i, *rule).alias(rule[0]) for i, rule in enumerate(RULES)))
    kinds = [rule[0] for rule in RULES]
    ordered = F.array_sort(F.concat(*kinds))
    return found.select("blob", *(F.size(k).cast("long").alias(f"n_{k}") for k in kinds),
                        F.concat_ws(",", F.transform(ordered, lambda x: x["span"])).alias("spans"))


def _ledger(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":  # the first scan
            return None
        raise


def scan_secrets(docs: DataFrame, ledger: str, rule_version: str = RULE_VERSION) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored):
    doc_id, blob, n_assign, n_access, n_hex, spans (``kind:start:end`` in code
    points by start then kind, comma-joined). ``ledger`` is a Parquet path in
    a folder that all executors share; blobs that it has under
    ``rule_version`` are not scanned again. A blob can stand in the ledger
    more than once (scans at the same time, a job run again): its findings are
    the same each time and count once.

    A null text counts as empty and has no spans. Null, repeated and shared
    doc_ids are paths like any other.
    """
    spark = docs.sparkSession
    prepare(spark)
    paths = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    paths = paths.withColumn("blob", F.sha2("text", 256))
    heads = paths.groupBy("blob").agg(F.min("doc_id").alias("doc_id"))
    known = _ledger(spark, ledger)
    if known is not None:
        heads = heads.join(known.where(F.col("rule_version") == rule_version).select("blob"), "blob", "left_anti")
    unseen = paths.alias("p").join(heads.alias("h"), (F.col("p.blob") == F.col("h.blob"))
                                   & F.col("p.doc_id").eqNullSafe(F.col("h.doc_id")), "left_semi")
    fresh = scan_texts(unseen.select("blob", "text")).dropDuplicates(["blob"])  # equal rows: scanned once each, kept once
    fresh.withColumn("rule_version", F.lit(rule_version)).write.mode("append").parquet(ledger)
    findings = spark.read.parquet(ledger).where(F.col("rule_version") == rule_version).drop("rule_version").dropDuplicates(["blob"])
    return paths.select("doc_id", "blob").join(findings, "blob").select("doc_id", "blob", *findings.columns[1:])


def redacted_documents(docs: DataFrame, ledger: str) -> DataFrame:
    """``docs`` with every found span of its text replaced by ``[kind]``."""
    spark = docs.sparkSession
    found = scan_secrets(docs, ledger).where("spans <> ''").select(F.col("blob").alias("_blob"), "spans").distinct()
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    rows = rows.withColumn("_blob", F.sha2(F.coalesce("row.text", F.lit("")), 256)).join(found, "_blob", "left")
    spans = F.transform(F.split("spans", ","), lambda s: F.split(s, ":"))
    whole = F.col("row.text")

    def step(state: Column, s: Column) -> Column:
        start, end = s[1].cast("int"), s[2].cast("int")
        gap = F.substring(whole, state["at"] + 1, F.greatest(start - state["at"], F.lit(0)))
        mark = F.when(start >= state["at"], F.concat(F.lit("["), s[0], F.lit("]"))).otherwise(F.lit(""))  # inside the one before
        return F.struct(F.greatest(state["at"], end).alias("at"), F.concat(state["out"], gap, mark).alias("out"))

    clean = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                        lambda s: F.concat(s["out"], F.substring(whole, s["at"] + 1, F.length(whole))))
    text = F.when(F.col("spans").isNull(), whole).otherwise(clean)
    return rows.select(*(text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents, from an empty ledger."""
    prepare(spark)
    found = scan_secrets(table(spark, sf_dir, "documents"), shared_path(spark, "ledger"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("spans", 256).alias("base_sha256"), "spans")
