"""Size-checked broadcast and skew-splitting for joins.

A side is broadcast only after its size in bytes has been checked against a
bound; beyond it the join is left to the planner (sort-merge with AQE)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Default bound on a broadcast side (per-code tables, model weights): raw
# bytes, before the few-fold growth of the hash table built from them.
DEFAULT_BROADCAST_BYTES = 32 << 20
# Rows of one patient that a task of the window join may hold.
DEFAULT_HOT_ROWS = 1_000_000


def size_in_bytes(df: DataFrame) -> int:
    """Bytes of ``df`` by one partial aggregation: 16 a row and column, and
    the length of its strings. Materialise ``df`` first if it is expensive."""
    text = [F.coalesce(F.sum(F.octet_length(F.col(f.name))), F.lit(0)) for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    total = F.count(F.lit(1)) * F.lit(16 * len(df.columns))
    for part in text:
        total = total + part
    return int(df.agg(total.alias("b")).first()["b"] or 0)


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``F.broadcast(df)`` when ``df`` has at most ``max_bytes``, else ``df``."""
    return F.broadcast(df) if size_in_bytes(df) <= max_bytes else df


def hot_keys(rows: DataFrame, key: str, per_task: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """(key, parts): keys with more than ``per_task`` rows, and into how many
    parts their rows are to be split. One map-side combined count over the key
    column; at most 1 / ``per_task`` of the rows come out."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > per_task)
    return counts.select(key, F.ceil(F.col("_n") / F.lit(per_task)).cast("int").alias("parts"))


def key_filter(rows: DataFrame, side: DataFrame, key: str, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``rows`` whose key may occur in ``side``: none that does is dropped,
    of the others about one in fifty stays.

    A blocked Bloom filter made of DataFrame expressions: every key sets two
    bits of one 64-bit word, some four keys a word. The words (16 bytes for
    four keys) are broadcast to the rows, before any shuffle of them. Where
    they would have more than ``max_bytes``, all rows stay: the join that
    follows is the exact test. Null keys are dropped. One count job over
    ``side``.
    """
    known = side.where(F.col(key).isNotNull())
    words = max(1, known.agg(F.approx_count_distinct(key)).first()[0] // 4)
    rows = rows.where(F.col(key).isNotNull())
    if 16 * words > max_bytes:
        return rows
    word = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(words))
    second = F.xxhash64(F.lit("bits"), F.col(key).cast("string"))
    one = F.lit(1).cast("long")

    def bit(at):
        return F.call_function("shiftleft", one, F.pmod(at, F.lit(64)).cast("int"))

    mask = bit(second).bitwiseOR(bit(F.shiftright(second, 6)))
    bits = known.select(word.alias("_word"), mask.alias("_mask")).groupBy("_word").agg(F.bit_or("_mask").alias("_bits"))
    tested = rows.withColumns({"_word": word, "_mask": mask}).join(F.broadcast(bits), "_word")
    return tested.where(F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask")).select(*rows.columns)


def salted_join(rows: DataFrame, side: DataFrame, key: str, per_task: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Inner equi-join of ``rows`` with ``side`` in which a hot key's rows go to
    several tasks: they get a part number by hash, and ``side`` is repeated
    once for each part of its key. Other keys are joined as they are. Null
    keys never join and are dropped before the shuffle. Without hot keys the
    join is dealt by the key alone, so that a count by the key and more columns
    needs no other exchange."""
    hot = hot_keys(rows.where(F.col(key).isNotNull()), key, per_task).checkpoint(eager=True)
    if not hot.take(1):
        return rows.where(F.col(key).isNotNull()).join(side, key)
    hot = broadcast_if_small(hot)
    values = [c for c in rows.columns if c != key]
    spread = F.pmod(F.xxhash64(*values) if values else F.lit(0), F.col("parts")).cast("int")
    left = (rows.where(F.col(key).isNotNull()).join(hot, key, "left")
            .withColumn("_part", F.coalesce(spread, F.lit(0))).drop("parts"))
    copies = F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1)
    right = side.join(hot, key, "left").withColumn("_part", F.explode(copies)).drop("parts")
    return left.join(right, [key, "_part"]).drop("_part")
