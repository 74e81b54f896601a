"""Percentiles per group from day summaries that can be combined."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.operators.rangesort import running_sums
from parcelight.runtime import Workspace

#: Steps of rank that a day summary keeps; its rank error is at most 1/KNOTS of the day's values.
KNOTS = 200
TARGETS = {"p50": 0.5, "p90": 0.9, "p99": 0.99}


def measured(df: DataFrame, value: str = "area_m2", group: str = "tile_id", key: str = "detection_id", at: str = "detected_at", loaded: str = "ingested_at") -> DataFrame:
    """(group, day, value): each key's positive, finite value once.

    Rows whose value is null, NaN, infinite, zero or negative don't count. Of
    several deliveries of a key the first loaded one counts (ties: the least
    group, day and value). A null group and a null time form a group and a day
    of their own. A null key has no identity: such rows count as they are
    unless all their columns agree.
    """
    v = F.col(value)
    valid = df.filter(v.isNotNull() & ~F.isnan(v) & (v > 0) & (v < float("inf")))
    rows = valid.select(F.col(key).alias("key"), F.col(loaded).alias("at"), F.col(group).alias("g"), F.to_date(at).alias("day"), v.cast("double").alias("value"))
    known = rows.filter("key is not null").groupBy("key").agg(F.min(F.struct("at", "g", "day", "value")).alias("r")).select("r.g", "r.day", "r.value")
    unknown = rows.filter("key is null").distinct().select("g", "day", "value")
    return known.unionAll(unknown).withColumnRenamed("g", group)


def day_summaries(ws: Workspace, values: DataFrame, group: str, knots: int = KNOTS) -> DataFrame:
    """(group, day, value, n): cumulative frequencies of each group's day, at most `knots` + 1 rows.

    Values are reduced to counts, range-sorted and summed up. Of the values
    that end in the same step of rank (a day's values are cut into `knots` equal
    steps) only the last is kept, with the count of all of them. So the
    frequency up to any value is off by less than 1/knots of the day, and
    summaries of days combine by adding counts: the error of the whole stays
    below 1/knots of all values.
    """
    counts = values.groupBy(group, "day", "value").agg(F.count("*").alias("n"))
    summed = running_sums(ws, counts, [group, "day"], ["value"], "n", "day_counts")
    step = F.floor((F.col("running") - 1) * knots / F.col("total")).cast("int")
    return summed.groupBy(group, "day", step.alias("step")).agg(F.max("value").alias("value"), F.sum("n").alias("n")).drop("step")


def combine(ws: Workspace, summaries: DataFrame, group: str, targets: dict[str, float] = TARGETS) -> DataFrame:
    """(group, n, one column per target): the values at the target ranks, from any number of summaries.

    The value at fraction q of n is the first whose cumulative frequency
    reaches ceil(q n). A group without values has no row.
    """
    counts = summaries.groupBy(group, "value").agg(F.sum("n").alias("n"))
    summed = running_sums(ws, counts, [group], ["value"], "n", "counts")
    reached = {name: F.min(F.when(F.col("running") >= F.ceil(F.col("total") * F.lit(q)), F.col("value"))).alias(name) for name, q in targets.items()}
    return summed.groupBy(group).agg(F.sum("n").alias("n"), *reached.values())


def percentiles(ws: Workspace, df: DataFrame, group: str = "tile_id", knots: int = KNOTS) -> DataFrame:
    """Median, 90th and 99th percentile per group, with a rank error below 1/knots.

    Day summaries are written, so a later day needs no second reading of the
    earlier ones. An empty table gives no rows.
    """
    summaries = ws.write(day_summaries(ws, measured(df, group=group), group, knots), "day_summaries")
    ws.drop("day_counts")
    return combine(ws, summaries, group)


