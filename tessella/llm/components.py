"""Connected components by alternating large-star and small-star steps, all of them joins and grouped minima.

A step links each node to the least neighbour it knows; the two kinds of step alternate until the edges are stars around each
component's least node. The number of rounds grows with the logarithm of the nodes; every round ends in a table of the shared
folder, and the table of the round before is deleted. A node with very many neighbours is summed up by partial minima, and its rows
are spread over many tasks where they meet the minimum, so no group is ever gathered; of few edges (``FEW``) the minima are broadcast, which spares
the driver half of the tasks of a round, and they are written as a few files (``FILES``), however many partitions a shuffle has. Rows: null ends and loops count for nothing;
repeated edges count once; no edges give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import PART, cut, forget, joined_apart

#: Up to so many edges the least neighbours go to every task, and the edges stay where they lie.
FEW = 100_000
#: Files of a table of few edges. On a local disk Hadoop starts two processes for each file that it creates.
FILES = 8


def _with_least(edges: DataFrame, n: int, rows: DataFrame | None = None) -> DataFrame:
    """(u, v, m) of ``rows`` (or of all edges): m is the least neighbour of u among all edges, ``n`` in number."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("rows"))
    if n <= FEW:
        return (edges if rows is None else rows).join(F.broadcast(least.select("u", "m")), "u")
    hot = least.where(F.col("rows") * PART > n).select(F.col("u").alias("busy_key"))
    return joined_apart(edges if rows is None else rows, least.select("u", "m"), ["u"], hot, F.col("v"))


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    moved = _with_least(both, 2 * n, both.where("v > u")).select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    return moved.where("u <> v").distinct()


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    # the edge to the least neighbour stays; every other neighbour hangs on the least one
    return _with_least(down, n).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (u, v); a component is named by its least node."""
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    edges, state = cut(edges, "edges"), None
    while True:
        before, state = state, edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        moved = _small_star(_large_star(edges, state[0]), state[0])
        old, edges = edges, cut(moved.coalesce(FILES) if state[0] <= FEW else moved, "edges")
        forget(old)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
