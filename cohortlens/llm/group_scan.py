"""Running values inside groups of any size, without a group in one task.

Rows are range-partitioned by group and order, so a hot group spreads over many
partitions; each partition numbers and sums its own rows in one pass over the
sorted stream, and the partitions' totals (one row each) give the offsets of
the groups that go on from one partition into the next.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.llm.common import write_shared
from cohortlens.llm.kernels import column


def _running(x: np.ndarray, head: np.ndarray, before: int, op: np.ufunc, undo: np.ufunc) -> np.ndarray:
    """op over each group's rows so far; ``head``: where groups begin,
    ``before``: what the first rows' group had."""
    total = op.accumulate(x)
    first = np.flatnonzero(head)
    start = np.maximum.accumulate(np.where(head, np.arange(len(x)), 0)) if len(first) else np.zeros(len(x), np.int64)
    base = np.where(start > 0, total[np.maximum(start, 1) - 1], 0)
    out = undo(total, base)
    until = first[0] if len(first) else len(x)
    out[:until] = op(out[:until], np.int64(before))
    return out


def scan_groups(df: DataFrame, group: str, order: list[str], sums: tuple[str, ...] = (), xors: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with ``nth`` (from 1: the row's number in its ``group`` by
    ``order``, nulls first) and ``so_far_<x>``: the sum, or exclusive or, of the
    group's rows up to this one, for long columns ``x`` without nulls. The group
    is a long without nulls; rows that tie come in any order."""
    names = ["nth", *(f"so_far_{x}" for x in (*sums, *xors))]
    ops = [(np.add, np.subtract)] * (1 + len(sums)) + [(np.bitwise_xor, np.bitwise_xor)] * len(xors)

    def local(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, own, state = TaskContext.get().partitionId(), None, [0] * len(names)
        for batch in batches:
            if not batch.num_rows:
                continue
            key = column(batch, group)
            head = np.append(key[0] != own if own is not None else True, key[1:] != key[:-1])
            values = [np.ones(len(key), np.int64), *(column(batch, x) for x in (*sums, *xors))]
            found = [_running(x, head, before, *op) for x, before, op in zip(values, state, ops)]
            own, state = key[-1], [x[-1] for x in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(key), part, np.int64)), *(pa.array(x) for x in found)],
                                             names=[*batch.schema.names, "part", *names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    sorted_rows = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    rows = write_shared(sorted_rows.mapInArrow(local, f"{fields}, part long, " + ", ".join(f"{x} long" for x in names)), "scan")
    # one row a partition: the group that it ends with and that group's totals, here and in the partitions before
    ends = rows.groupBy("part").agg(F.min(group).alias("first"), F.max(F.struct(F.col(group).alias("group"), *names)).alias("last"))
    until = W.partitionBy("last.group").orderBy("part")
    totals = [(F.bit_xor if x.removeprefix("so_far_") in xors else F.sum)(f"last.{x}").over(until).alias(f"_{x}") for x in names]
    before = W.orderBy("part")
    ends = ends.select("part", "first", F.col("last.group").alias("group"), *totals)
    ends = ends.select("part", "first", F.lag("group").over(before).alias("group"), *(F.lag(f"_{x}").over(before).alias(f"_{x}") for x in names))
    ends = ends.where("group = first").select("part", F.col("first").alias("_group"), *(f"_{x}" for x in names))

    def whole(x: str):
        own, more = F.col(x), F.coalesce(F.col(f"_{x}"), F.lit(0).cast("long"))
        return (own.bitwiseXOR(more) if x.removeprefix("so_far_") in xors else own + more).alias(x)

    joined = rows.join(F.broadcast(ends), (rows["part"] == ends["part"]) & (rows[group] == ends["_group"]), "left")
    return joined.select(*(rows[c] for c in df.columns), *(whole(x) for x in names))
