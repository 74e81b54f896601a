"""Containers of fixed capacity, filled by bounded-space online best fit."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelight.runtime import Workspace

CAPACITY = 2048
#: Containers that one packing stream keeps open, and the containers' worth of items that it gets.
OPEN, STREAM = 512, 16_384


class Packer:
    """A stream of containers. Free space of the open ones is a bitset, so the best fit is the lowest bit not below the size."""

    def __init__(self, capacity: int, most_open: int = OPEN):
        self.capacity, self.most_open = capacity, most_open
        self.bits, self.by_free, self.open, self.next = 0, {}, 0, 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            del self.by_free[free]
            self.bits &= ~(1 << free)
        self.open -= 1
        return number

    def put(self, size: int) -> int:
        """The container for an item of `size`, from 1 to the capacity."""
        fitting = self.bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if size < self.capacity and self.open >= self.most_open:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            free, number = self.capacity, self.next
            self.next += 1
        if free > size:
            self.by_free.setdefault(free - size, []).append(number)
            self.bits |= 1 << (free - size)
            self.open += 1
        return number


def _fill(capacity: int, most_open: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stream, packer = None, None
        for b in batches:
            numbers = []
            for s, size in zip(b["stream"].tolist(), b["size"].tolist()):
                if s != stream:
                    stream, packer = s, Packer(capacity, most_open)
                numbers.append((s << 32) + packer.put(size))
            yield b[["key", "piece_no", "first", "size"]].assign(container_id=pd.Series(numbers, dtype="int64", index=b.index))

    return run


def pack(ws: Workspace, sizes: DataFrame, key: str, capacity: int = CAPACITY, most_open: int = OPEN) -> DataFrame:
    """(key, piece_no, first, size, container_id): each item's place.

    `sizes` is (key, n). An item above the capacity is cut into full pieces,
    each a container of its own, and a rest that is packed like an item; no
    other is split. `first` is where the piece starts in the item. An item of
    size 0 or null takes no room: it has one row without a container.

    Items are dealt by hash to streams of about STREAM containers, whatever
    keys are frequent; each stream is packed online in a fixed order with at
    most `most_open` open containers, so memory doesn't grow with the data.
    """
    sizes = ws.write(sizes.select(F.col(key).alias("key"), F.coalesce(F.col("n").cast("long"), F.lit(0)).alias("n")), "sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    streams = max(1, math.ceil(total / (capacity * STREAM)))
    starts = F.when(F.col("n") > capacity, F.sequence(F.lit(0), F.floor((F.col("n") - 1) / capacity))).otherwise(F.array(F.lit(0).cast("long")))
    pieces = sizes.select("key", "n", F.explode(starts).alias("piece_no")).select("key", F.col("piece_no").cast("int").alias("piece_no"), (F.col("piece_no") * capacity).alias("first"), F.least(F.lit(capacity).cast("long"), F.col("n") - F.col("piece_no") * capacity).alias("size"))
    mixed = F.xxhash64("key", "piece_no", "size")
    dealt = pieces.filter("size > 0").withColumns({"stream": F.pmod(mixed, F.lit(streams)), "order": F.xxhash64(mixed)})
    ordered = dealt.repartition(streams, "stream").sortWithinPartitions("stream", "order", "key", "piece_no")
    schema = T.StructType([f for f in pieces.schema.fields] + [T.StructField("container_id", T.LongType())])
    packed = ordered.drop("order").mapInPandas(_fill(capacity, most_open), schema)
    empty = pieces.filter("size = 0").withColumn("container_id", F.lit(None).cast("long"))
    return packed.unionByName(empty).withColumnRenamed("key", key)
