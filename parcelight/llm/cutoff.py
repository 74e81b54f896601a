"""Score cutoffs that keep a target fraction of each source, by cutting planes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelight.runtime import Workspace


def source_key(text: Column) -> Column:
    """A prompt without case, outer and repeated blanks and final full stop."""
    plain = F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))
    return F.rtrim(F.regexp_replace(plain, r"\.$", ""))


def scored(df: DataFrame, key: str = "detection_id", source: str = "prompt", score: str = "score", loaded: str = "ingested_at") -> DataFrame:
    """(id, source, score): each key once, with a score from 0 to 1 and a source.

    Null and NaN scores and others outside 0 to 1, null sources and null keys
    don't count. Of several deliveries of a key the first loaded one counts
    (ties: the least source and score).
    """
    s = F.col(score).cast("double")
    rows = df.select(F.col(key).alias("id"), F.col(loaded).alias("at"), source_key(F.col(source)).alias("source"), (s + F.lit(0.0)).alias("score"))
    rows = rows.filter("id is not null and source is not null and score between 0 and 1")
    return rows.groupBy("id").agg(F.min(F.struct("at", "source", "score")).alias("r")).select("id", "r.source", "r.score")


#: Rounds after which the counts outside all brackets are dropped.
NARROW = 4


def _step(state: DataFrame, counts: DataFrame) -> DataFrame:
    """One round: both trial cutoffs of each open source are judged over the counts in its bracket and what is known of those above."""
    open_ = state.filter("low < high")
    middle = F.col("low") / 2 + F.col("high") / 2
    slope = F.col("slope_l") - F.col("slope_h")
    crossing = F.try_divide(F.col("loss_h") - F.col("loss_l") + F.col("slope_l") * F.col("at_l") - F.col("slope_h") * F.col("at_h"), slope)
    inside = lambda t: F.coalesce(F.when((t >= F.col("low")) & (t < F.col("high")), t), F.col("low"))
    trial = open_.withColumns({"t1": inside(crossing), "t2": inside(middle)})
    seen = counts.join(trial.select("source", "permille", "low", "high", "t1", "t2"), "source").filter("score between low and high")
    x, k = F.col("score"), F.col("count")
    aggs = []
    for t in ("t1", "t2"):
        above = x > F.col(t)
        aggs += [
            F.sum(F.when(above, k).otherwise(0)).alias(f"in_{t}"),
            F.sum(F.when(above, x * k).otherwise(0.0)).alias(f"sum_{t}"),
            F.min(F.when(above, x)).alias(f"next_{t}"),
            F.max(F.when(~above, x)).alias(f"last_{t}"),
        ]
    judged = trial.join(seen.groupBy("source", "permille").agg(*aggs), ["source", "permille"])
    for t in ("t1", "t2"):
        # All that lies above t: in the bracket, and beyond the bracket as it was at the beginning of the round.
        judged = judged.withColumns({f"over_{t}": F.col("beyond") + F.col(f"in_{t}"), f"sum_{t}": F.col("beyond_sum") + F.col(f"sum_{t}")})
    for t in ("t1", "t2"):
        judged = judged.withColumn(f"excess_{t}", F.col(f"sum_{t}") - F.col(f"over_{t}") * F.col(t))
    for t in ("t1", "t2"):
        loss = (F.col("rank") - 0.5) * F.col(t) + F.col(f"excess_{t}")
        slope_t = F.col("rank") - 0.5 - F.col(f"over_{t}")
        up = F.col(f"over_{t}") >= F.col("rank")  # the cutoff lies above t
        better_l, better_h = up & (F.col(f"next_{t}") > F.col("low")), ~up & (F.col(f"last_{t}") < F.col("high"))
        judged = judged.withColumns(
            {
                "at_l": F.when(better_l, F.col(t)).otherwise(F.col("at_l")),
                "loss_l": F.when(better_l, loss).otherwise(F.col("loss_l")),
                "slope_l": F.when(better_l, slope_t).otherwise(F.col("slope_l")),
                "low": F.when(better_l, F.col(f"next_{t}")).otherwise(F.col("low")),
                "at_h": F.when(better_h, F.col(t)).otherwise(F.col("at_h")),
                "loss_h": F.when(better_h, loss).otherwise(F.col("loss_h")),
                "slope_h": F.when(better_h, slope_t).otherwise(F.col("slope_h")),
                "high": F.when(better_h, F.col(f"last_{t}")).otherwise(F.col("high")),
                "beyond": F.when(better_h, F.col(f"over_{t}")).otherwise(F.col("beyond")),
                "beyond_sum": F.when(better_h, F.col(f"sum_{t}")).otherwise(F.col("beyond_sum")),
            }
        )
    return judged.select(state.columns).unionAll(state.filter("not coalesce(low < high, false)"))


def cutoffs(ws: Workspace, data: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, permille, n, cutoff, kept): the highest score that at least permille/1000 of the source's n records reach.

    `data` is (id, source, score), `targets` is (source, permille). With k =
    max(1, ceil(n permille / 1000)) the cutoff is the k-th largest score, the
    minimiser of the convex pinball loss (k - 1/2) t + sum(max(score - t, 0)).
    Records are reduced to counts per source and score first. A round takes the
    point where the tangents at both ends of each source's bracket meet (and
    the bracket's middle, which bounds the rounds), sums up losses and
    subgradients of the counts in the bracket in partial aggregates, adds what
    is known of those above, and moves an end to the neighbouring score that
    exists; counts outside all brackets are dropped on the way. When both ends
    are the same score, it is the cutoff, exactly, whatever ties there are.
    Sources never meet in one task; the state is one row per target.

    A source without records has n 0 and no cutoff; so has a target that is
    null or outside 0 to 1000, with n as it is.
    """
    counts = all_ = ws.write(data.groupBy("source", "score").agg(F.count("*").alias("count")), "counts-0")
    whole = counts.groupBy("source").agg(F.sum("count").alias("n"), F.min("score").alias("low"), F.max("score").alias("high"), F.sum(F.col("score") * F.col("count")).alias("sum"))
    asked = targets.select("source", F.col("permille").cast("int")).distinct().join(whole, "source", "left")
    usable = F.col("n").isNotNull() & F.col("permille").between(0, 1000)
    rank = F.when(usable, F.greatest(F.lit(1), F.floor((F.col("n") * F.col("permille") + 999) / 1000))).cast("long")
    k = F.col("rank") - 0.5
    state = asked.withColumn("rank", rank).select(
        "source",
        "permille",
        F.coalesce("n", F.lit(0)).alias("n"),
        "rank",
        F.when(usable, F.col("low")).alias("low"),
        F.when(usable, F.col("high")).alias("high"),
        F.col("low").alias("at_l"),
        (k * F.col("low") + F.col("sum") - F.col("n") * F.col("low")).alias("loss_l"),
        (k - F.col("n")).alias("slope_l"),
        F.col("high").alias("at_h"),
        (k * F.col("high")).alias("loss_h"),
        k.alias("slope_h"),
        F.lit(0).cast("long").alias("beyond"),
        F.lit(0.0).alias("beyond_sum"),
    )
    turn = 0
    state, open_ = ws.write_counting(state, "state-0", "low < high")
    while open_:
        turn += 1
        state, open_ = ws.write_counting(_step(state, counts), f"state-{turn}", "low < high")
        ws.drop(f"state-{turn - 1}")
        if open_ and turn % NARROW == 0:
            brackets = state.filter("low < high").select(F.col("source").alias("_of"), "low", "high")
            inside = (F.col("source") == F.col("_of")) & F.col("score").between(F.col("low"), F.col("high"))
            counts = ws.write(counts.join(brackets, inside, "left_semi"), f"counts-{turn}")
            if turn > NARROW:
                ws.drop(f"counts-{turn - NARROW}")
    found = state.select("source", "permille", "n", F.col("low").alias("cutoff"))
    reached = all_.join(found.select("source", "permille", "cutoff"), "source").filter("score >= cutoff").groupBy("source", "permille").agg(F.sum("count").alias("kept"))
    return found.join(reached, ["source", "permille"], "left").select("source", "permille", "n", "cutoff", F.coalesce("kept", F.lit(0)).alias("kept"))


def kept(data: DataFrame, found: DataFrame) -> DataFrame:
    """Ids of the records that reach the (lowest) cutoff of their source."""
    lowest = found.filter("cutoff is not null").groupBy("source").agg(F.min("cutoff").alias("cutoff"))
    return data.join(lowest, "source").filter("score >= cutoff").select("id")
