"""Order-dependent numbering without a single-partition window.

Both helpers range-partition the input (Spark samples the key to pick
balanced bounds, so a key range never lands whole on one task), freeze that
partitioning with a reliable checkpoint, and then add per-partition offsets
taken from a table with one row per partition. Only that table — bounded by
the partition count — is ever on one partition or broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.session import checkpoint_dir

_ROW_BITS = 33                    # monotonically_increasing_id: partition << 33 | row
_ROW_MASK = (1 << _ROW_BITS) - 1


def _range_partition(df: DataFrame, num_partitions: int | None, *order) -> DataFrame:
    """Range repartition. Without an explicit count the session's shuffle
    partition number is used and adaptive execution may coalesce adjacent
    ranges (a small code table then lands on a few tasks, not thousands);
    partition ids are read after that, so coalescing is harmless."""
    if num_partitions:
        return df.repartitionByRange(int(num_partitions), *order)
    return df.repartitionByRange(*order)


def _partition_offsets(part_totals: DataFrame, value_cols: list[str]) -> DataFrame:
    """(_part, _off_<v>..., _all_<v>...): sum of <v> over all earlier
    partitions, and over all partitions.

    ``part_totals`` has at most one row per range partition, so the
    unpartitioned windows here run over a table bounded by the partition
    count.
    """
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    return part_totals.select(
        "_part",
        *[F.coalesce(F.sum(F.col(f"_tot_{v}")).over(before), F.lit(0)).alias(f"_off_{v}")
          for v in value_cols],
        *[F.sum(F.col(f"_tot_{v}")).over(everything).alias(f"_all_{v}") for v in value_cols])


def dense_index(df: DataFrame, key: str, index_col: str = "index",
                num_partitions: int | None = None, carry: tuple[str, ...] = (),
                unique: bool = False) -> DataFrame:
    """Distinct non-null ``key`` values numbered 0..n-1 in ascending order.

    ``unique=True`` states that ``df`` already has one row per key (no
    distinct step); ``carry`` columns of such a table are kept.

    The zipWithIndex idea in DataFrame form: after a range repartition and a
    sort within partitions, ``monotonically_increasing_id`` carries the
    partition number and the row position; the checkpoint makes that
    assignment stable for both uses below.
    """
    checkpoint_dir(df.sparkSession)
    if carry and not unique:
        raise ValueError("carry columns need unique=True")
    values = df.select(key, *carry).where(F.col(key).isNotNull())
    if not unique:
        values = values.distinct()
    zipped = (_range_partition(values, num_partitions, key)
              .sortWithinPartitions(key)
              .select(key, *carry, F.monotonically_increasing_id().alias("_mid"))
              .checkpoint(eager=True)
              .select(key, *carry,
                      F.shiftright(F.col("_mid"), _ROW_BITS).alias("_part"),
                      F.col("_mid").bitwiseAND(F.lit(_ROW_MASK)).alias("_pos")))
    totals = zipped.groupBy("_part").agg(F.count(F.lit(1)).alias("_tot_n"))
    offsets = _partition_offsets(totals, ["n"])
    return (zipped.join(F.broadcast(offsets), "_part")
            .select(key, *carry,
                    (F.col("_off_n") + F.col("_pos")).cast("bigint").alias(index_col)))


def running_totals(df: DataFrame, order: Column, value_cols: list[str],
                   prefix: str = "cum_", num_partitions: int | None = None,
                   totals_prefix: str | None = None) -> DataFrame:
    """Add ``<prefix><v>`` = sum of ``v`` over every row up to and including
    this one in ``order``. Rows must be unique on the ordering key (callers
    group by it first), so ties never arise. With ``totals_prefix`` also add
    ``<totals_prefix><v>`` = sum of ``v`` over all rows."""
    checkpoint_dir(df.sparkSession)
    ranged = (_range_partition(df, num_partitions, order)
              .withColumn("_part", F.spark_partition_id())
              .checkpoint(eager=True))
    upto = (Window.partitionBy("_part").orderBy(order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.select("*", *[F.sum(v).over(upto).alias(f"_loc_{v}") for v in value_cols])
    totals = ranged.groupBy("_part").agg(*[F.sum(v).alias(f"_tot_{v}") for v in value_cols])
    offsets = _partition_offsets(totals, value_cols)
    out = local.join(F.broadcast(offsets), "_part")
    keep = [c for c in df.columns]
    extra = ([F.col(f"_all_{v}").alias(totals_prefix + v) for v in value_cols]
             if totals_prefix else [])
    return out.select(*keep, *[(F.col(f"_off_{v}") + F.col(f"_loc_{v}")).alias(prefix + v)
                               for v in value_cols], *extra)
