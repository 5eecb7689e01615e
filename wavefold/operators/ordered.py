"""Numbering and running totals over range partitions.

``row_number().over(partitionBy(g).orderBy(k))`` sends every row of a group to
one task, and a window without groups sends the whole table to one.  Here rows
are dealt out by ranges of (group, order), so a large group is many
partitions like any other stretch of the order:

1. ``repartitionByRange`` and a sort inside each partition; one pass over the
   sorted rows numbers (or adds up) each group from where it begins in the
   partition.  The rows are written once, in columns, so that what follows
   reads the same partitions again, also after a lost executor;
2. per partition, its first and its last group and what the last one came to:
   one row each;
3. prefix sums of these rows by group say what a partition's first group has
   in earlier partitions; this is added to the rows of that group.

There is no threshold and no count beforehand; groups may be of any number
and size.  What is broadcast has a row for each partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package, staged

# Columns that the rows carry between the steps.
_HASH1, _HASH2, _VALUE = "_group1", "_group2", "_value"
_PART, _ROW, _BEFORE, _FIRST = "_part", "_row", "_before", "_in_first"


def _group_hashes(group: Sequence[str]) -> list[Column]:
    """128 bits that name a group; a null part differs from an empty or a missing one."""
    parts = [p for name in group for p in (F.col(name).isNull(), F.col(name))]
    return [F.xxhash64(F.lit(seed), *parts) for seed in (0, 1)]


def _run_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to each row its place in the partition, the total of its group before it there, and if the group is the partition's first."""
    last, total, rows, first = None, 0, 0, True
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        h1, h2, value = (batch.column(c).to_numpy(zero_copy_only=False) for c in (_HASH1, _HASH2, _VALUE))
        begins = np.empty(n, bool)
        begins[0] = last is not None and last != (h1[0], h2[0])
        begins[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        sums = np.cumsum(value) - value
        run = np.cumsum(begins)  # 0 while the group goes on that the batch before ended with
        starts = np.flatnonzero(begins)
        base = np.concatenate([[-total], sums[starts]])
        before = sums - base[run]
        in_first = first & (run == 0)
        last, total = (h1[-1], h2[-1]), int(before[-1] + value[-1])
        first = bool(in_first[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.arange(rows, rows + n)), pa.array(before), pa.array(in_first)],
                                         names=[*batch.schema.names, _ROW, _BEFORE, _FIRST])
        rows += n


def _totals_before(df: DataFrame, group: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """Add ``name``: the total of ``value`` over the rows of the same group that come earlier in the order (nulls last)."""
    ship_package(df.sparkSession)
    h1, h2 = _group_hashes(group)
    keyed = df.withColumns({_HASH1: h1, _HASH2: h2, _VALUE: value.cast("long")})
    keys = [F.col(_HASH1), F.col(_HASH2), *[F.col(c).asc_nulls_last() for c in order]]
    dealt = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(_PART, F.spark_partition_id())
    added = [T.StructField(_ROW, T.LongType()), T.StructField(_BEFORE, T.LongType()), T.StructField(_FIRST, T.BooleanType())]
    rows = staged(dealt.mapInArrow(_run_sums, T.StructType([*dealt.schema.fields, *added])), "running-totals")

    here = F.struct(_HASH1, _HASH2)
    ends = rows.groupBy(_PART).agg(F.min_by(here, _ROW).alias("first"), F.max_by(here, _ROW).alias("last"),
                                   F.max_by(F.col(_BEFORE) + F.col(_VALUE), _ROW).alias("total"))
    # A partition asks (0) what its first group has in those before it, which tell (1) what their last one came to.
    asks = ends.select(_PART, F.lit(0).alias("tells"), F.col("first").alias("group"), F.lit(0).cast("long").alias("total"))
    tells = ends.select(_PART, F.lit(1).alias("tells"), F.col("last").alias("group"), "total")
    earlier = Window.partitionBy("group").orderBy(_PART, "tells").rowsBetween(Window.unboundedPreceding, -1)
    carried = asks.unionByName(tells).withColumn("_carried", F.sum("total").over(earlier)).filter("tells = 0").select(_PART, "_carried")
    carry = F.when(F.col(_FIRST), F.coalesce("_carried", F.lit(0))).otherwise(F.lit(0))
    return rows.join(F.broadcast(carried), _PART).select(*df.columns, (F.col(_BEFORE) + carry).alias(name))


def rank_within(df: DataFrame, group: Sequence[str], order: Sequence[str], rank_col: str = "rank") -> DataFrame:
    """Add ``rank_col``: 1-based position within ``group`` by ``order`` (ascending, nulls last), as ``row_number`` counts."""
    counted = _totals_before(df, list(group), list(order), F.lit(1), rank_col)
    return counted.withColumn(rank_col, (F.col(rank_col) + 1).cast("int"))


def running_total(df: DataFrame, order: Sequence[str], value: Column, name: str) -> DataFrame:
    """Add ``name``: the total of ``value`` over all rows that come earlier by ``order`` (nulls last)."""
    return _totals_before(df, [], list(order), value, name)
