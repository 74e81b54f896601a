"""Cumulative frequencies over range-sorted tables.

A running sum per group by one window needs all rows of a group in one task.
Here rows are range-partitioned on (group, order), so a hot group spans many
partitions. Each partition is sorted and summed up where it lies, before it is
written. Only groups that go on from one partition to the next need an offset,
and of those a partition has two at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelight.runtime import Workspace


def _changes(columns: list[pa.Array], n: int) -> np.ndarray:
    """Where a row's group differs from the row before it; nulls and NaN equal themselves."""
    out = np.zeros(n, bool)
    for c in columns:
        if n < 2:
            break
        a, b = c.slice(0, n - 1), c.slice(1)
        differ = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False).copy()
        if pa.types.is_floating(c.type):
            nan = np.asarray(pc.fill_null(pc.is_nan(c), False).to_numpy(zero_copy_only=False))
            differ &= ~(nan[:-1] & nan[1:])
        null = np.asarray(pc.is_null(c).to_numpy(zero_copy_only=False))
        out[1:] |= differ | (null[:-1] != null[1:])
    return out


def _summed(group: list[str], weight: str):
    """Adds _part, _run (sum up to the row within its group in this partition) and _sum (of the group in this partition) to sorted rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []  # the group that isn't over: at most a partition's rows

        def finished(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
            n = len(table)
            w = table.column(weight).to_numpy()
            ends = np.append(starts[1:], n)
            cum = np.cumsum(w, dtype=w.dtype if w.dtype.kind == "f" else "int64")
            base = np.where(starts > 0, cum[starts - 1], 0)
            size = ends - starts
            out = table.append_column("_part", pa.array(np.full(n, part, "int32"))).append_column("_run", pa.array(cum - np.repeat(base, size))).append_column("_sum", pa.array(np.repeat(cum[ends - 1] - base, size)))
            yield from out.to_batches()

        for b in batches:
            if not len(b):
                continue
            held.append(b)
            last = b.slice(len(b) - 1)
            if sum(map(len, held)) < 20_000 or all(held[0].column(g).slice(0, 1).equals(last.column(g)) for g in group):
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            starts = np.append(0, np.flatnonzero(_changes([table.column(g).combine_chunks() for g in group], len(table))))
            if starts[-1] > 0:
                yield from finished(table.slice(0, starts[-1]).combine_chunks(), starts[:-1])
            held = table.slice(starts[-1]).combine_chunks().to_batches()
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            starts = np.append(0, np.flatnonzero(_changes([table.column(g).combine_chunks() for g in group], len(table))))
            yield from finished(table, starts)

    return run


def running_sums(ws: Workspace, df: DataFrame, group: list[str], order: list[str | Column], weight: str, name: str) -> DataFrame:
    """df with `running` (sum of weight up to and with the row, in the order of
    `order` within `group`) and `total` (of the group).

    A null group is a group; null order values come first, unless an order is
    descending. Without group columns all rows are one group. Rows that tie on
    all of `order` follow each other in no defined order, so callers make
    `order` unique within a group. A null weight counts as 0,
    decimals are summed as doubles.
    """
    keys = [*group, *order]
    kind = "long" if df.schema[weight].dataType.typeName() in ("byte", "short", "integer", "long", "boolean") else "double"
    rows = df.withColumn("_weight", F.coalesce(F.col(weight).cast(kind), F.lit(0).cast(kind))).repartitionByRange(*keys).sortWithinPartitions(*keys)
    sums = T.DoubleType() if kind == "double" else T.LongType()
    schema = T.StructType([*rows.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_run", sums), T.StructField("_sum", sums)])
    rows = ws.write(rows.mapInArrow(_summed(group, "_weight"), schema).drop("_weight"), name)
    # The first and last group of a partition are the only ones that others may hold too.
    edges = rows.groupBy("_part", *group).agg(F.max("_sum").alias("_sum"))
    parts = edges.withColumn("_in", F.count("*").over(Window.partitionBy(*group))).filter("_in > 1") if group else edges
    over = Window.partitionBy(*group)
    offsets = parts.select(*[F.col(g).alias(f"_of_{g}") for g in group], F.col("_part").alias("_of_part"), F.coalesce(F.sum("_sum").over(over.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast(kind)).alias("_offset"), F.sum("_sum").over(over).alias("_total"))
    # At most two rows per partition of the sort, so their size is that of its number of partitions.
    met = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in group), F.col("_part") == F.col("_of_part"))
    joined = rows.join(F.broadcast(offsets), met, "left")
    running, total = F.col("_run") + F.coalesce("_offset", F.lit(0).cast(kind)), F.coalesce("_total", "_sum")
    return joined.select(*df.columns, running.alias("running"), total.alias("total"))
