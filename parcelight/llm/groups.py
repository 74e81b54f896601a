"""Groups of records that pairwise matches link, directly or over others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.operators.components import HOT_PARTS, HOT_ROWS, both_ways, contract, label, spread_join, stars
from parcelight.runtime import Workspace

#: Rounds of the breadth-first search; what it has not reached by then is labelled like the rest.
BFS_ROUNDS = 12


def clean_edges(matches: DataFrame, known: DataFrame | None, a: str, b: str, key: str) -> DataFrame:
    """(u, v), u < v, each once: pairs of two different ids that `known` has.

    A pair with a null side and one of an id with itself link nothing.
    """
    edges = matches.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).filter(f"{a} is not null and {b} is not null and {a} <> {b}").distinct()
    if known is not None:
        ids = known.select(F.col(key).alias("k"))
        edges = edges.join(ids, F.col("u") == F.col("k"), "left_semi").join(ids, F.col("v") == F.col("k"), "left_semi")
    return edges


def _peel(ws: Workspace, edges: DataFrame, n: int) -> tuple[DataFrame, DataFrame, int]:
    """The component of the vertex of highest degree as (id, parent), the edges that are left and their number.

    Frontiers are joined with the edges until one is empty. The first one is a
    single vertex, whose edges are taken by a filter and are left out from then
    on; edges of other vertices of high degree are dealt to many tasks. If
    BFS_ROUNDS end before, what was reached becomes one vertex of the edges
    that are left.
    """
    degrees = both_ways(edges).groupBy("u").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "u").limit(2 * HOT_PARTS + 1).collect()
    hub = degrees[0].u
    hot = [r.u for r in degrees if n >= HOT_ROWS and r.n > n / HOT_PARTS]  # all of them, as the degrees add up to 2 n
    beside = edges.filter(F.col("u") == hub).select(F.col("v").alias("id")).unionAll(edges.filter(F.col("v") == hub).select(F.col("u").alias("id")))
    start = ws.spark.createDataFrame([(hub,)], "id long")
    frontier, found = ws.write_counting(beside, "reached-1", "true")
    reached = start.unionAll(frontier)
    others = edges.filter((F.col("u") != hub) & (F.col("v") != hub))
    done = not found
    for turn in range(2, BFS_ROUNDS + 1):
        if done:
            break
        forward = spread_join(others, frontier.withColumnRenamed("id", "u"), "u", hot, "left_semi").select(F.col("v").alias("id"))
        back = spread_join(others, frontier.withColumnRenamed("id", "v"), "v", hot, "left_semi").select(F.col("u").alias("id"))
        frontier, found = ws.write_counting(forward.unionAll(back).distinct().join(reached, "id", "left_anti"), f"reached-{turn}", "true")
        done = not found
        reached = reached.unionAll(frontier)
    least = reached.agg(F.min("id")).first()[0]
    peeled = ws.write(reached.select("id", F.lit(least).alias("parent")), "peeled")
    if done:
        rest = spread_join(others, peeled.select(F.col("id").alias("u")), "u", hot, "left_anti")
    else:
        rest = contract(edges, peeled, n)
    return peeled, *ws.write_counting(stars(rest), "rest-0", "true")


def groups(ws: Workspace, edges: DataFrame) -> DataFrame:
    """(id, group_id): each vertex of `edges` (u, v; u < v) with the least id of its component.

    The component of the vertex of highest degree, the giant one where there is
    one, is peeled off by frontier joins. In the rest each vertex takes over
    the least label along least neighbours; groups found that way become one
    vertex each, and so on till no edges are left. Every round at least halves
    the vertices of a component, so long chains take a logarithmic number of
    rounds; nothing is gathered per group. No edges: no rows.
    """
    edges, n = ws.write_counting(edges, "edges", "true")
    if not n:
        return edges.select(F.col("u").alias("id"), F.col("v").alias("group_id"))
    peeled, rest, n = _peel(ws, edges, n)
    return label(ws, rest, n, peeled)
