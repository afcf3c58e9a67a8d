"""Connected components of an edge table by contraction with union-find.

Each round every task reduces its own edges with union-find to a forest
(node -> smallest node it can reach in that task).  A node that is then tied
to several roots ties these roots together: those ties are the edges of the
next, much smaller round.  A star of any size (one hub with a third of all
nodes) contracts in one round.  Roots are mapped back from the last round to
the first; the joins read written tables, so AQE can split hot roots.  No task
holds more than its own share of the edges, nothing is collected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualis.llm.session import cut


def union(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, smallest node of their component) of the edges a[i] - b[i]."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(nodes)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(flat[:len(a)].tolist(), flat[len(a):].tolist(), strict=True):
        x, y = find(x), find(y)
        if x != y:  # nodes are sorted: the smaller index is the smaller node
            parent[max(x, y)] = min(x, y)
    return nodes, nodes[np.array([find(i) for i in range(len(nodes))], dtype=np.int64)]


def _forest(batches):
    parts = [(b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False))
             for b in batches]
    if parts:
        node, root = union(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["node", "root"])


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long, no nulls) -> cut table (node, component): the
    smallest node reachable, for every node with an edge. No edges: no rows."""
    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
    levels = []
    while True:
        forest = cut(edges.mapInArrow(_forest, "node long, root long").distinct())
        best = cut(forest.groupBy("node").agg(F.min("root").alias("top"), F.max("root").alias("high")))
        levels.append(best)
        many = best.where("top <> high").select("node", "top")
        ties = cut(forest.join(many, "node").where("root <> top")
                   .select(F.col("root").alias("a"), F.col("top").alias("b")).distinct())
        if ties.isEmpty():
            break
        edges = ties
    found = levels.pop().select("node", F.col("top").alias("component"))
    while levels:
        below = levels.pop().select("node", F.col("top").alias("root"))
        found = cut(below.join(found.withColumnRenamed("node", "root"), "root", "left")
                    .select("node", F.coalesce("component", "root").alias("component")))
    return cut(found)
