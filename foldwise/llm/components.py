"""Connected components of an edge table, wholly in Spark.

First, blocks of at most about ``BLOCK`` edges are contracted inside tasks: what
remains of a block is a star per component of its own edges. Then large-star and
small-star steps alternate across the blocks: each step replaces the edges of a
node by edges to its least neighbour, which keeps the components and ends with
one star per component after a number of rounds that is logarithmic in practice. Least neighbours come from a map-side combined ``groupBy``; a hub
with a third of all edges costs its partial minima and one join whose skewed
key adaptive execution may split. Edges never reach the driver, only their
count and checksum.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.work import Workspace

MAX_ROUNDS = 60
BLOCK = 200_000


def _large_star(e: DataFrame) -> DataFrame:
    s = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    m = s.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return s.join(m, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    s = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    m = s.groupBy("u").agg(F.min("v").alias("m"))
    near = s.join(m, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return near.unionAll(m.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()


def _contract(batches):
    """Stars (node, least node) of the components of a block's edges."""
    a, b = [], []
    for batch in batches:
        a.append(batch.column(0).to_numpy(zero_copy_only=False))
        b.append(batch.column(1).to_numpy(zero_copy_only=False))
    if not a:
        return
    nodes, ends = np.unique(np.concatenate([*a, *b]), return_inverse=True)
    n = len(ends) // 2
    low = np.arange(len(nodes))
    u, v = ends[:n], ends[n:]
    while True:  # hook the larger root to the smaller one, then halve the paths
        x, y = low[u], low[v]
        if (x == y).all():
            break
        np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = low[low]
            if (up == low).all():
                break
            low = up
    leaf = low != np.arange(len(nodes))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[leaf]), pa.array(nodes[low[leaf]])], names=["a", "b"])


def _settled(e: DataFrame) -> bool:
    """Is every edge that of a leaf to its only, least node?"""
    several = e.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").limit(1)
    chained = e.select(F.col("a").alias("x")).join(e.select(F.col("b").alias("x")).distinct(), "x", "left_semi").limit(1)
    return several.select(F.lit(1)).unionAll(chained.select(F.lit(1))).isEmpty()


def components(edges: DataFrame, ws: Workspace) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)`` (longs);
    ``component`` is the least node reachable. Loops and repeated edges are
    ignored; a node without an edge to another node has no row."""
    e = edges.select("a", "b").where("a <> b")
    e = ws.keep(e.repartition(max(1, -(-e.count() // BLOCK))).mapInArrow(_contract, "a long, b long"))
    for _ in range(MAX_ROUNDS):
        if _settled(e):
            break
        e = ws.keep(_small_star(_large_star(e)))
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = e.select("b").distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        roots.select(F.col("b").alias("node"), F.col("b").alias("component"))
    )
