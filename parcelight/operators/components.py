"""Connected components: union-find where edges lie, then minimum propagation over contracted graphs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.runtime import Workspace

#: A key of a join is hot if it has more than one in HOT_PARTS of a table's rows; hot keys are spread over SALTS tasks. A table of fewer than HOT_ROWS rows has none.
HOT_PARTS, SALTS, HOT_ROWS = 256, 64, 1_000_000
#: Edges that the union-find of a task takes at once.
LOCAL_EDGES = 4_000_000


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def hot_keys(df: DataFrame, key: str, n: int) -> list[int]:
    """Keys with more than one in HOT_PARTS of the n rows; there are fewer than HOT_PARTS."""
    if n < HOT_ROWS:
        return []
    return [r[0] for r in df.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > n / HOT_PARTS).collect()]


def spread_join(left: DataFrame, right: DataFrame, key: str, hot: list[int], how: str = "inner") -> DataFrame:
    """left.join(right, key, how) for a right side with each key once: rows of hot keys are dealt to SALTS tasks, each with a copy of the right row."""
    if not hot:
        return left.join(right, key, how)
    is_hot = F.col(key).isin(hot)
    dealt = left.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)).cast("int")).otherwise(0))
    copies = right.withColumn("_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    return dealt.join(copies, [key, "_salt"], how).drop("_salt")


def roots(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vertices of a graph in memory, and the least vertex of each one's component."""
    ids, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[: len(u)], place[len(u) :]
    parent = np.arange(len(ids))
    while len(a):
        high, low = np.maximum(parent[a], parent[b]), np.minimum(parent[a], parent[b])
        open_ = high != low
        a, b = a[open_], b[open_]
        np.minimum.at(parent, high[open_], low[open_])
        while True:
            above = parent[parent]
            if (above == parent).all():
                break
            parent = above
    return ids, ids[parent]


def stars(edges: DataFrame) -> DataFrame:
    """Edges (u, v), u < v, with the same components: in each partition the edges of a spanning star per component. No shuffle, no more edges than before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us, vs, n = [], [], 0

        def star() -> pa.RecordBatch:
            ids, root = roots(np.concatenate(us), np.concatenate(vs))
            away = ids != root
            return pa.RecordBatch.from_arrays([pa.array(root[away]), pa.array(ids[away])], ["u", "v"])

        for b in batches:
            us.append(b.column(0).to_numpy())
            vs.append(b.column(1).to_numpy())
            n += len(b)
            if n >= LOCAL_EDGES:
                yield star()
                us, vs, n = [], [], 0
        if n:
            yield star()

    return edges.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")).mapInArrow(run, "u long, v long")


def contract(edges: DataFrame, parents: DataFrame, n: int) -> DataFrame:
    """The n edges between the vertices' parents; a vertex without one stays."""
    at_u = parents.select(F.col("id").alias("u"), F.col("parent").alias("pu"))
    at_v = parents.select(F.col("id").alias("v"), F.col("parent").alias("pv"))
    moved = spread_join(edges, at_u, "u", hot_keys(edges, "u", n), "left")
    moved = spread_join(moved, at_v, "v", hot_keys(edges, "v", n), "left").select(F.coalesce("pu", "u").alias("a"), F.coalesce("pv", "v").alias("b"))
    return moved.filter("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()


def propagate(ws: Workspace, edges: DataFrame, turn: int, n: int) -> DataFrame:
    """(id, parent): the least vertex that each vertex reaches by always going on to its least neighbour.

    Minima propagate along these paths with doubled steps until nothing moves:
    a chain of n takes log2(n) joins instead of n rounds.
    """
    low = both_ways(edges).groupBy("u").agg(F.min("v").alias("m"))
    parents = ws.write(low.select(F.col("u").alias("id"), F.least("u", "m").alias("parent")), f"parents-{turn}-0")
    jump = 0
    while True:
        above = parents.select(F.col("id").alias("parent"), F.col("parent").alias("top"))
        jump += 1
        met = spread_join(parents, above, "parent", hot_keys(parents, "parent", n))
        further = met.select("id", F.col("top").alias("parent"), (F.col("top") < F.col("parent")).alias("moved"))
        parents, moved = ws.write_counting(further, f"parents-{turn}-{jump}", "moved")
        ws.drop(f"parents-{turn}-{jump - 1}")
        if not moved:
            return parents.select("id", "parent")


def label(ws: Workspace, rest: DataFrame, n: int, first: DataFrame | None = None) -> DataFrame:
    """(id, group_id): the vertices of `rest` (u, v; u < v; n rows) with the least id of their component.

    Each vertex takes over the least label along least neighbours; groups found
    that way become one vertex each, and so on till no edges are left. Every
    round at least halves the vertices of a component, so long chains take a
    logarithmic number of rounds. Rows of a frequent parent are dealt to many
    tasks. `first` holds (id, parent) of vertices that were merged before.
    """
    steps, turn = [], 0
    while n:
        turn += 1
        parents = propagate(ws, rest, turn, n)
        steps.append((parents, n))
        rest, n = ws.write_counting(contract(rest, parents, n), f"rest-{turn}", "true")
        ws.drop(f"rest-{turn - 1}")
    labels = rest.select(F.col("u").cast("long").alias("id"), F.col("v").cast("long").alias("group_id"))
    for i, (parents, size) in enumerate(reversed(steps)):  # a later step's vertices are all among an earlier one's
        labels = labels_of(parents, labels, size) if i else parents.select("id", F.col("parent").alias("group_id"))
    if first is None:
        return labels
    labels = ws.write(labels, "labels")
    return labels_of(first, labels, HOT_ROWS if steps else 0).unionAll(labels.join(first, "id", "left_anti"))


def labels_of(parents: DataFrame, labels: DataFrame, n: int) -> DataFrame:
    """(id, group_id): the label of each vertex's parent, or the parent if it has none."""
    top = labels.select(F.col("id").alias("parent"), "group_id")
    return spread_join(parents, top, "parent", hot_keys(parents, "parent", n), "left").select("id", F.coalesce("group_id", "parent").alias("group_id"))


def components(ws: Workspace, edges: DataFrame, name: str = "") -> DataFrame:
    """(id, group_id) of each vertex of `edges` (u, v; any order, repeats and loops allowed; a null side links nothing).

    Edges that lie in one partition are joined there before anything is shuffled.
    """
    clean = edges.filter("u is not null and v is not null").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).filter("u < v")
    ws = ws.part(name) if name else ws
    return label(ws, *ws.write_counting(stars(clean), "rest-0", "true"))
