"""Feature operators: per-(patient, code) counts, dense code index,
max-normalisation, sparse SVMLight rows and labelled sample lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions import binary_label, svm_token
from cohortlens.operators.joins import DEFAULT_BROADCAST_BYTES, broadcast_if_small
from cohortlens.operators.ordering import dense_index
from cohortlens.session import checkpoint_dir

NORMALIZED_DECIMALS = 3
# Codes of one patient that a task gathers at once.
PIECE_CODES = 1 << 16


def aggregate_events(filtered: DataFrame) -> DataFrame:
    """(patientid, eventid, feature_value bigint): number of event rows per
    patient and code. ``count(eventid)``, so a null code counts 0 and is
    dropped later by the ``> 0`` filter."""
    return (filtered.groupBy("patientid", "eventid")
            .agg(F.count("eventid").alias("feature_value")))


def generate_feature_mapping(agg_events: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """(eventid, event_index bigint): distinct non-null codes numbered
    0..n-1 in ascending code order, without a single-partition sort."""
    return dense_index(agg_events, "eventid", "event_index", num_partitions)


def code_maxima(agg_events: DataFrame) -> DataFrame:
    """(eventid, max_value): largest count of each code (partial + final
    hash aggregation, so a very common code is combined map-side)."""
    return agg_events.groupBy("eventid").agg(F.max("feature_value").alias("max_value"))


def normalization(agg_events: DataFrame, maxima: DataFrame | None = None,
                  broadcast_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """(patientid, eventid, normalized_feature_value): count / max count of
    the code, rounded to 3 places (HALF_UP).

    ``maxima`` may be passed in (e.g. fitted on the training side only).
    The per-code table is checkpointed and broadcast when its size is within
    ``broadcast_bytes``, so the counts are not shuffled by code (a common code
    would be one partition); above it, or with None, the planner decides.
    """
    per_code = maxima if maxima is not None else code_maxima(agg_events)
    if broadcast_bytes is not None:
        checkpoint_dir(agg_events.sparkSession)
        if maxima is None:
            per_code = per_code.checkpoint(eager=True)
        per_code = broadcast_if_small(per_code, broadcast_bytes)
    joined = agg_events.join(per_code, "eventid", "left")
    return joined.select("patientid", "eventid", normalized_value().alias("normalized_feature_value"))


def normalized_value():
    """round(feature_value / max_value, 3); null (not an error) for 0 / 0."""
    ratio = F.try_divide(F.col("feature_value").cast("double"), F.col("max_value"))
    return F.round(ratio, NORMALIZED_DECIMALS)


def svmlight_convert(normalized: DataFrame, event_map: DataFrame,
                     broadcast_bytes: int | None = DEFAULT_BROADCAST_BYTES,
                     piece_codes: int = PIECE_CODES) -> DataFrame:
    """(patientid, sparse_feature array<string>) with ``"index:value"``
    tokens in ascending numeric index order.

    ``broadcast_bytes``: as in ``normalization``.

    Rows whose rounded value is not > 0 are dropped; codes missing from the
    map are dropped (inner join) rather than emitted as a bare value
    (``unmapped_codes`` counts them).
    Tokens are gathered in ranges of ``piece_codes`` indices (``sparse_rows``).
    """
    kept = normalized.where(F.col("normalized_feature_value") > 0)
    code_map = event_map.select("eventid", "event_index")
    if broadcast_bytes is not None:
        code_map = broadcast_if_small(code_map, broadcast_bytes)
    return sparse_rows(kept.join(code_map, "eventid", "inner"), highest_index(event_map), piece_codes)


def highest_index(event_map: DataFrame) -> int:
    """The number of indices up to the largest (one aggregation of the map)."""
    top = event_map.agg(F.max("event_index")).first()[0]
    return 0 if top is None else int(top) + 1


def unmapped_codes(normalized: DataFrame, event_map: DataFrame) -> DataFrame:
    """(eventid, n_rows): positive rows whose code (null included) is not in
    the map, i.e. what ``svmlight_convert`` leaves out."""
    counts = (normalized.where(F.col("normalized_feature_value") > 0)
              .groupBy("eventid").agg(F.count(F.lit(1)).alias("n_rows")))
    return counts.join(event_map.select("eventid"), "eventid", "left_anti")


def sparse_rows(indexed: DataFrame, n_codes: int | None = None, piece_codes: int = PIECE_CODES) -> DataFrame:
    """(patientid, sparse_feature) from rows (patientid, event_index,
    normalized_feature_value) whose value is already known to be > 0.

    A patient's tokens are gathered for ranges of ``piece_codes`` indices and
    the ranges put together in order, so no task gathers more than a range's
    pairs at once; a patient with millions of codes is built by many tasks, and
    only the finished pieces (the bytes of the row itself) meet in one. With at
    most ``piece_codes`` codes (``n_codes``) one range holds all of them, and a
    patient is gathered in one step.
    """
    pair = F.struct(F.col("event_index").alias("i"),
                    svm_token(F.col("event_index"),
                              F.col("normalized_feature_value")).alias("t"))
    # sort_array orders the structs by index first; taking field "t" of the
    # struct array needs no lambda, so the projection stays in codegen.
    tokens = F.sort_array(F.collect_list(pair)).getField("t")
    if n_codes is not None and n_codes <= piece_codes:
        return indexed.groupBy("patientid").agg(tokens.alias("sparse_feature"))
    piece = F.floor(F.col("event_index") / F.lit(piece_codes)).alias("_piece")
    pieces = indexed.groupBy("patientid", piece).agg(F.array_join(tokens, " ").alias("_tokens"))
    whole = F.sort_array(F.collect_list(F.struct("_piece", "_tokens"))).getField("_tokens")
    return pieces.groupBy("patientid").agg(F.split(F.array_join(whole, " "), " ").alias("sparse_feature"))


def code_stats(agg_events: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """(eventid, max_value, event_index): the per-code maximum and the dense
    code index in one small, checkpointed table (non-null codes only)."""
    return dense_index(code_maxima(agg_events), "eventid", "event_index", num_partitions,
                       carry=("max_value",), unique=True)


def svmlight_samples(svmlight: DataFrame, mortality: DataFrame) -> DataFrame:
    """(patientid, save_feature): ``"<label> i:v i:v ..."`` with label 1 iff
    the mortality label is 1, else 0. Built-in ``concat_ws`` on the array,
    no Python UDF. A patient with several mortality rows has as many lines."""
    labels = mortality.select("patientid", "label")
    joined = svmlight.join(labels, "patientid", "left")
    line = F.concat_ws(" ", binary_label(F.col("label")).cast("string"), F.col("sparse_feature"))
    return joined.select("patientid", line.alias("save_feature"))


def with_sample_id(samples: DataFrame, line: str = "save_feature", key: str | None = "patientid") -> DataFrame:
    """Add ``sample_id``, one per row and the same on every run: md5 of the
    key, the line and a number that tells equal rows apart. Numbers are dealt
    within a key's rows, so samples that are hash-partitioned by the key (as
    ``svmlight_samples`` leaves them) are not shuffled again."""
    own = [key, line] if key else [line]
    nth = F.row_number().over(Window.partitionBy(*own).orderBy(F.lit(0)))
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in own]
    return samples.withColumn("_nth", nth).withColumn(
        "sample_id", F.md5(F.concat_ws("|", *parts, F.col("_nth").cast("string")))).drop("_nth")
